"""CSV that keeps its rows: odd fields, split files, headers in any order, bad records."""

from __future__ import annotations

import csv
import io
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright import sources
from tabwright.sources.records import inside_after, read_records

ODD = ["a\nb", "", " pad ", 'q"x', None, "a\r\nb", "back\\slash", '\\"', "\r", "tab\t", '"', '""', "a,b", "'", "\n", " ", "#c", "\\N", "x\n\n\"y\",\n", "ü "]


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def odd_frame(spark, n=300, seed=3):
    rng = random.Random(seed)
    data = [(i, rng.choice(ODD), rng.choice(ODD), rng.choice([None, 1.5, -2.0])) for i in range(n)] + [(None, None, None, None)]
    return spark.createDataFrame(data, "k int, v string, w string, x double")


def test_odd_fields_survive(spark, tmp_path):
    df = odd_frame(spark)
    sources.export_csv(df, str(tmp_path / "x"))
    back = sources.read_csv(spark, str(tmp_path / "x"), df.schema, corrupt="bad")
    assert rows(back.drop("bad")) == rows(df) and back.where("bad IS NOT NULL").isEmpty()


def test_records_over_the_ends_of_splits(spark, tmp_path, small_splits):
    df = odd_frame(spark).union(spark.createDataFrame([(7, "long\n" * 200, None, None)], "k int, v string, w string, x double")).coalesce(2)
    sources.export_csv(df, str(tmp_path / "x"))
    assert spark.read.text(str(tmp_path / "x")).rdd.getNumPartitions() > 20
    assert rows(sources.read_csv(spark, str(tmp_path / "x"), df.schema)) == rows(df)


def test_columns_are_found_by_name(spark, tmp_path):
    folder = tmp_path / "x"
    folder.mkdir()
    (folder / "a.csv").write_text("v,k\none,1\n")
    (folder / "b.csv").write_bytes(b'"k","more","v"\r\n2,x,"t\r\nwo"\r\n\r\n3,y,three')
    schema = T.StructType.fromDDL("k int, v string")
    assert rows(sources.read_csv(spark, str(folder), schema)) == [(1, "one"), (2, "t\r\nwo"), (3, "three")]
    (folder / "c.csv").write_text("k,w\n1,2\n")
    with pytest.raises(ValueError):
        sources.read_csv(spark, str(folder), schema)


def test_bad_records_are_told(spark, tmp_path):
    (tmp_path / "x.csv").write_text('k,v\n1,a\n2\n3,b,c\nfour,d\n5,5" pipe\n,\n6,"open\n7,e\n')
    got = sources.read_csv(spark, str(tmp_path / "x.csv"), T.StructType.fromDDL("k int, v string"), corrupt="bad")
    assert rows(got.where("bad IS NULL").drop("bad")) == sorted([(1, "a"), (5, '5" pipe'), (None, None)], key=repr)
    assert {r.bad for r in got.where("bad IS NOT NULL").collect()} == {"2", "3,b,c", "four,d", '6,"open\n7,e'}
    assert {(r.k, r.v) for r in got.where("bad LIKE '%,%'").collect()} >= {(3, "b"), (None, "d")}


def test_without_header_and_with_other_separators(spark, tmp_path):
    (tmp_path / "x.csv").write_text('1;"a;\nb"\n2;c\n')
    schema = T.StructType.fromDDL("k int, v string")
    assert rows(sources.read_csv(spark, str(tmp_path / "x.csv"), schema, sep=";", header=False)) == [(1, "a;\nb"), (2, "c")]


def test_single_column(spark, tmp_path):
    df = spark.createDataFrame([("a",), ("",), ("\n",)], "v string")
    sources.export_csv(df, str(tmp_path / "x"))
    assert rows(sources.read_csv(spark, str(tmp_path / "x"), df.schema)) == rows(df)
    with pytest.raises(ValueError):
        sources.export_csv(df.withColumn("v", F.lit(None).cast("string")), str(tmp_path / "y"))


def test_empty_tables_and_files(spark, tmp_path):
    df = spark.createDataFrame([], "k int, v string")
    sources.export_csv(df, str(tmp_path / "x"))
    assert sources.read_csv(spark, str(tmp_path / "x"), df.schema).collect() == []
    (tmp_path / "y.csv").write_text("")
    assert sources.read_csv(spark, str(tmp_path / "y.csv"), df.schema).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_records_equal_a_sequential_reader(spark, tmp_path, small_splits, seed):
    rng = random.Random(seed)
    text = "".join(rng.choice(['"', '""', ",", "\n", "a", "b c", '"x\ny"', ',"', '",', "\n1,"]) for _ in range(900))
    (tmp_path / "x.csv").write_text(text)
    wanted, held, inside = [], [], False
    for line in text.split("\n")[:None if not text.endswith("\n") else -1]:
        held.append(line)
        inside = inside_after(line, inside, ",")
        if not inside:
            wanted.append("\n".join(held))
            held = []
    if held:
        wanted.append("\n".join(held))
    got, _ = read_records(spark, str(tmp_path / "x.csv"), header=False)
    assert sorted(r.record for r in got.collect()) == sorted(w for w in wanted if w)


def test_well_formed_lines_equal_the_csv_module():
    rng = random.Random(9)
    for _ in range(300):
        fields = [rng.choice([v for v in ODD if v is not None and "\r" not in v]) for _ in range(4)]
        out = io.StringIO()
        csv.writer(out, lineterminator="\n").writerow(fields)
        inside, states = False, []
        for line in out.getvalue()[:-1].split("\n"):
            inside = inside_after(line, inside, ",")
            states.append(inside)
        assert states == [True] * (len(states) - 1) + [False]
