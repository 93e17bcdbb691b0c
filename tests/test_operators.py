"""Hand rows for each operator: missing values, bounds, ties, empty and constant columns."""

from __future__ import annotations

import math
import random

import pytest
from pyspark.sql import functions as F

from tabwright import functions as fn
from tabwright import operators as op
from tabwright.operators import split as split_module


def values(df, *cols):
    return [tuple(r) for r in df.select(*(cols or df.columns)).collect()]


def one(spark, expression, **row):
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"{k} {t}" for k, t in zip(row, _types(row))))
    return df.select(expression).first()[0]


def _types(row):
    return [{str: "string", float: "double", int: "int", list: "array<string>"}[type(v)] for v in row.values()]


# --- functions --------------------------------------------------------------------------------

def test_hash01_value(spark):
    assert one(spark, fn.hash01(42, "k"), k=7) == 0.32816208130680025


@pytest.mark.parametrize("text, number", [
    ("", None), (" ", None), ("NaN", None), ("x", None), ("1.50", 1.5), (" 2 ", 2.0), ("-3e1", -30.0),
])
def test_to_double(spark, text, number):
    assert one(spark, fn.to_double(F.col("t")), t=text) == number


def test_blank_to_null(spark):
    assert one(spark, fn.blank_to_null(F.col("t")), t="  ") is None
    assert one(spark, fn.blank_to_null(F.col("t")), t="a") == "a"


@pytest.mark.parametrize("lo, hi", [(-4, None), (1, 3), (None, 2), (0, 0), (-2, -1), (5, 9), (2, 1), (-9, 2)])
@pytest.mark.parametrize("n", [0, 1, 3, 6])
def test_list_slice_is_python_slicing(spark, lo, hi, n):
    items = [str(i) for i in range(n)]
    df = spark.createDataFrame([(items,)], "a array<string>")
    assert df.select(fn.list_slice(F.col("a"), lo, hi)).first()[0] == items[lo:hi]


def test_text_slice(spark):
    assert one(spark, fn.text_slice(F.col("t"), 2, 5), t="abcdefg") == "cde"
    assert one(spark, fn.text_slice(F.col("t"), 2, 4, "+"), t="ab65") == "65+"


@pytest.mark.parametrize("text, number", [("12.5%", 12.5), ("about 7 of", 7.0), (".5", 0.5), ("none", None)])
def test_number_in(spark, text, number):
    assert one(spark, fn.number_in(F.col("t")), t=text) == number


@pytest.mark.parametrize("age, key", [(80.0, 75), (75.0, 75), (40.9, 40), (0.0, 0)])
def test_clamp(spark, age, key):
    assert one(spark, fn.clamp(F.col("a"), 75), a=age) == key


def test_clamp_keeps_null(spark):
    assert spark.sql("select cast(null as double) a").select(fn.clamp(F.col("a"), 75)).first()[0] is None


# --- projection and repair --------------------------------------------------------------------

def test_require_sees_all_ways_of_missing(spark):
    df = spark.createDataFrame([("a", 1.0), ("", 1.0), (" ", 1.0), (None, 1.0), ("b", float("nan")), ("c", None)], "s string, x double")
    assert values(op.require(df, "s", "x")) == [("a", 1.0)]


def test_select_at_and_odd_names(spark):
    df = spark.createDataFrame([("1", "2", "3")], "a string, `ekgday(day` string, c string")
    assert op.select_at(df, [2, 1], ["z", "y"]).first().asDict() == {"z": "3", "y": "2"}
    assert op.rename(df, {"ekgday(day": "ekgday"}).columns == ["a", "ekgday", "c"]
    assert op.drop_columns(df, ["c"]).columns == ["a", "ekgday(day"]
    assert values(op.cast_numeric(df)) == [(1.0, 2.0, 3.0)]
    with pytest.raises(ValueError):
        op.select_at(df, [0, 1], ["only"])


def test_invalidate_bounds_are_kept(spark):
    df = spark.createDataFrame([(float(x),) for x in (-1, 0, 4, 5)] + [(None,)], "x double")
    assert values(op.invalidate(df, {"x": (0, 4)})) == [(None,), (0.0,), (4.0,), (None,), (None,)]
    with pytest.raises(ValueError):
        op.invalidate(df, {"x": (None, None)})


def test_add_null(spark):
    df = op.add_null(spark.range(1), "smoke")
    assert df.first()["smoke"] is None and df.schema["smoke"].dataType.simpleString() == "int"


def gappy(spark):
    """a: exactly 10 % missing, b: 5 %, c: 20 %, d: none, e: 5 % text."""
    return spark.range(20).select(
        F.when(F.col("id") >= 2, F.col("id").cast("double")).alias("a"),
        F.when(F.col("id") >= 1, F.col("id").cast("double")).alias("b"),
        F.when(F.col("id") >= 4, 1.0).alias("c"), F.lit(1.0).alias("d"),
        F.when(F.col("id") == 0, "").otherwise("t").alias("e"),
    )


def test_missing_share_boundary(spark):
    df = gappy(spark)
    assert op.DropSparse(0.1).fit(df).dropped == ["c"]
    model = op.Impute({"a": "mean", "b": "mean", "c": "mean", "d": "mean", "e": "mode"}, fill_under=0.1, drop_over=0.1).fit(df)
    assert model.dropped == ["c"] and model.fills == {"b": 10.0, "e": "t"}
    out = model.transform(df)
    assert out.columns == ["a", "b", "d", "e"]
    assert out.filter("a is null").count() == 2 and out.filter("b is null or e = ''").count() == 0
    profile = {r["col_name"]: r for r in op.missing_profile(df).collect()}
    assert profile["a"]["pct_missing"] == 0.1 and profile["e"]["n_missing"] == 1 and profile["d"]["n_rows"] == 20


def test_impute_values(spark):
    df = spark.createDataFrame([(x,) for x in (1.0, 1.0, 3.0, 3.0, float("nan"), None)], "x double")
    assert op.Impute({"x": "mode"}).fit(df).fills == {"x": 1.0}
    assert op.Impute({"x": "mean"}).fit(df).fills == {"x": 2.0}
    assert op.Impute({"x": "median"}).fit(df).fills["x"] in (1.0, 3.0)
    out = op.Impute({"x": "mean"}, prefix="imp_").fit(df).transform(df)
    assert [r["imp_x"] for r in out.collect()] == [1, 1, 3, 3, 2, 2]
    with pytest.raises(ValueError):
        op.Impute({"x": "guess"})


def test_impute_agrees_with_spark_ml(spark):
    from pyspark.ml.feature import Imputer
    df = spark.range(200).selectExpr("case when id % 7 > 0 then cast(id % 13 as double) end as x")
    for how in ("mean", "mode"):
        theirs = Imputer(strategy=how, inputCols=["x"], outputCols=["y"]).fit(df).surrogateDF.first()["x"]
        assert op.Impute({"x": how}).fit(df).fills["x"] == pytest.approx(theirs, rel=1e-12)


def test_impute_keeps_types_and_empty_columns(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, None, "")], "i int, n double, s string")
    out = op.Impute({"i": "mode", "n": "mean", "s": "mode"}).fit(df).transform(df)
    assert out.schema["i"].dataType.simpleString() == "int"
    assert values(out) == [(1, None, "a"), (1, None, "a")]


def test_modes_of_several_types(spark):
    rows = [(2, "b", 0.5, True), (10, "b", 0.5, None), (2, "a", -1.5, None), (10, "a", -1.5, None)]
    df = spark.createDataFrame(rows, "i int, s string, d double, z boolean")
    assert op.column_modes(df, ["i", "s", "d"]) == {"i": 2, "s": "a", "d": -1.5}


# --- profiles ---------------------------------------------------------------------------------

def test_skewness(spark):
    df = spark.createDataFrame([(x, 1.0) for x in (1.0, 2.0, 2.0, 3.0, 10.0, 11.5)], "x double, y double")
    got = {r["col_name"]: r for r in op.skew_profile(df, ["x", "y"]).collect()}
    assert got["x"]["skewness"] == pytest.approx(0.9322271821) and got["x"]["is_skewed"]
    assert not got["y"]["is_skewed"]
    assert op.skew_profile(df.limit(2), ["x"]).first()["skewness"] is None


def test_profiles_of_an_empty_frame(spark):
    df = spark.createDataFrame([], "x double, s string")
    assert [tuple(r) for r in op.missing_profile(df).collect()] == [("x", 0, 0, None), ("s", 0, 0, None)]
    assert tuple(op.numeric_profile(df, ["x"]).first()) == ("x", 0, None, None)
    assert op.row_count(df).first()["n_rows"] == 0
    assert op.DropSparse().fit(df).dropped == []


def test_cardinality_counts_missing(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "a"), (None, ""), (float("nan"), "a")], "x double, s string")
    got = {r["col_name"]: (r["n_values"], r["n_categories"]) for r in op.cardinality_profile(df, ["x", "s"]).collect()}
    assert got == {"x": (2, 3), "s": (1, 2)}


# --- trimming, encoding, transforms -----------------------------------------------------------

def test_sigma_trim_in_order(spark):
    rows = [(float(x), float(y)) for x, y in [(1, 1), (2, 2), (3, 3), (2, 2), (100, 3), (2, 50)]] + [(None, 1.0)]
    df = spark.createDataFrame(rows, "x double, y double")
    model = op.SigmaTrim(["x", "gone", "y"], 1.5).fit(df)
    assert list(model.bounds) == ["x", "y"]
    assert sorted(values(model.transform(df))) == [(1.0, 1.0), (2.0, 2.0), (2.0, 2.0), (3.0, 3.0)]
    other = op.SigmaTrim(["y", "x"], 1.5).fit(df)
    assert other.bounds["x"] != model.bounds["x"]


def test_sigma_trim_constant_and_single(spark):
    same = spark.createDataFrame([(0.1,)] * 7, "x double")
    assert op.SigmaTrim(["x"]).fit(same).transform(same).count() == 7
    lone = same.limit(1)
    assert op.SigmaTrim(["x"]).fit(lone).transform(lone).count() == 0


def test_target_encode_missing_category(spark):
    df = spark.createDataFrame([(1.0, 0), (None, 1), (1.0, 1), (None, 0), (2.0, 1)], "k double, y int")
    out = op.TargetEncode(["k", "gone"], "y").fit(df).transform(df)
    assert out.columns == ["y", "k_target"]
    assert values(out, "k_target") == [(0.5,), (None,), (0.5,), (None,), (1.0,)]
    two = df.filter("k is null or k = 1")
    assert op.TargetEncode(["k"], "y").fit(two).transform(two).columns == ["k", "y"]
    new = spark.createDataFrame([(9.0, 1)], "k double, y int")
    assert values(op.TargetEncode(["k"], "y").fit(df).transform(new)) == [(1, None)]


@pytest.mark.parametrize("literal_rows, small_rows, literal, joined", [
    (1000, 1000, ["a", "b"], {}), (10, 1000, ["b"], {"a": True}), (2, 10, [], {"a": False, "b": True}),
    (10, 10, ["b"], {"a": False}),
])
def test_target_encode_by_size(spark, literal_rows, small_rows, literal, joined):
    df = spark.range(400).selectExpr(
        "cast(id % 97 as double) as a", "nullif(cast(id % 4 as string), '2') as b", "cast(id % 3 = 0 as int) as y", "id")
    model = op.TargetEncode(["a", "b"], "y", 3, literal_rows, small_rows).fit(df)
    assert list(model.literal) == literal and {c: small for c, (_, small) in model.joined.items()} == joined
    from pyspark.sql import Window
    means = [F.avg("y").over(Window.partitionBy(c)) for c in ("a", "b")]
    want = df.select("y", "id", means[0], F.when(F.col("b").isNotNull(), means[1]))
    assert sorted(values(model.transform(df))) == [
        tuple(pytest.approx(x) if isinstance(x, float) else x for x in r) for r in sorted(map(tuple, want.collect()))]


def test_zscore_of_a_constant_is_missing(spark):
    df = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0)], "c double, d double")
    out = op.ZScoreLog(["c", "d"], drop_source=False).fit(df).transform(df)
    assert values(out, "c_z", "c_z_log") == [(None, None)] * 2
    root = math.sqrt(0.5)
    assert values(out, "d_z", "d_z_log") == [(pytest.approx(-root), pytest.approx(math.log1p(root))),
                                            (pytest.approx(root), pytest.approx(math.log1p(root)))]
    assert op.ZScoreLog(["c"]).fit(df).transform(df).columns == ["d", "c_z_log"]


def test_logs(spark):
    df = spark.createDataFrame([(-1.0, 3.0)], "a double, b double")
    assert op.log_abs_columns(df, ["a"]).columns == ["log_a", "b"]
    assert op.log_abs_columns(df, ["a"]).first()["log_a"] == pytest.approx(math.log(2))
    assert op.log1p_columns(df, ["b"]).first()["b"] == pytest.approx(math.log(4))


def test_feature_matrix_and_missing(spark):
    df = spark.createDataFrame([(1, 2.0, 0), (2, None, 1)], "k int, x double, y int")
    assert op.feature_matrix(df, "y", ["k"], "skip").count() == 1
    assert op.feature_matrix(df, "y", ["k"], "keep").count() == 2
    with pytest.raises(Exception):
        op.feature_matrix(df, "y", ["k"]).collect()


# --- lookups ----------------------------------------------------------------------------------

RATES = [(0, 75, 10.0), (1, 75, 100.0), (0, 40, 0.0)]


def random_bands(rng, n):
    edges = sorted({round(rng.uniform(-50, 50), 1) for _ in range(2 * n)})
    bands = [(a, b, f"b{i}", i / 2) for i, (a, b) in enumerate(zip(edges, edges[1:])) if rng.random() < 0.7]
    if rng.random() < 0.5:
        bands = [(-math.inf, edges[0], "low", None), *bands]
    return [*bands, (7.0, 7.0, "empty", 0.0), (None, 3.0, "no start", 0.0)] + ([(60.0, None, "open", 1.0)] if rng.random() < 0.7 else [])


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("small_rows", [1000, 1])
def test_bands_equal_a_plain_search(spark, small_rows, seed):
    rng = random.Random(seed)
    bands = random_bands(rng, rng.choice([1, 5, 40]))
    starts = [b[0] for b in bands if b[0] is not None and abs(b[0]) < math.inf]
    xs = [None, math.nan, math.inf, -math.inf] + [rng.choice([rng.uniform(-70, 70), rng.choice(starts), 3.25]) for _ in range(400)]
    df = spark.createDataFrame(list(enumerate(xs)), "k int, x double").repartition(5)
    got = {r.k: (r.name, r.rate) for r in op.band_lookup(df, spark.createDataFrame(bands, "lo double, hi double, name string, rate double"), "x", small_rows).collect()}
    assert len(got) == len(xs)
    for k, x in enumerate(xs):
        want = [(n, r) for lo, hi, n, r in bands if x is not None and not math.isnan(x) and lo is not None and lo <= x and (hi is None or x < hi)]
        assert got[k] == (want[0] if want else (None, None)), x


def test_band_lookup_has_no_nested_loop(spark):
    df = spark.range(1000).selectExpr("double(id) AS x")
    bands = spark.range(50).selectExpr("id * 3 AS lo", "id * 3 + 2 AS hi", "id AS b")
    for small_rows in (1000, 1):
        plan = op.band_lookup(df, bands, "x", small_rows)._jdf.queryExecution().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_common_value_of_many_bands_is_spread(spark):
    df = spark.range(30_000).selectExpr("IF(id % 3 = 0, 10.5, id / 7) AS x", "id")
    bands = spark.range(2000).selectExpr("id * 2 AS lo", "id * 2 + 1 AS hi", "id AS b")
    out = op.band_lookup(df, bands, "x", 10)
    assert out.where("x = 10.5").agg(F.min("b"), F.max("b"), F.count("b")).first() == (5, 5, 10_000)
    assert out.where("x = 11.0 AND b IS NOT NULL").isEmpty() and out.count() == 30_000


@pytest.mark.parametrize("small_rows", [100, 1])
def test_lookup(spark, small_rows):
    people = spark.createDataFrame([(1, 0, 80.0), (2, 1, 75.5), (3, 0, 41.0), (4, None, 75.0)], "id int, sex int, age double")
    rates = spark.createDataFrame(RATES, "sex int, age int, rate double")
    on = {"sex": F.col("sex"), "age": fn.clamp(F.col("age"), 75)}
    out = op.lookup(people, rates, on, small_rows)
    assert out.columns == ["id", "sex", "age", "rate"]
    assert sorted(values(out, "id", "rate")) == [(1, 10.0), (2, 100.0), (3, None), (4, None)]
    with pytest.raises(ValueError):
        op.lookup(people, rates.union(rates), on, small_rows)


def test_prob_impute_extremes(spark):
    df = spark.range(300).selectExpr("id", "cast(id % 4 as int) as g")
    rates = spark.createDataFrame([(0, 0.0), (1, 100.0), (2, 30.0)], "g int, smoke_rate double")
    out = op.prob_impute(df, rates, {"g": F.col("g")}, ["id"])
    means = {r["g"]: r["m"] for r in out.groupBy("g").agg(F.avg("smoke").alias("m")).collect()}
    assert means[0] == 0 and means[1] == 1 and 0.1 < means[2] < 0.5 and means[3] is None


@pytest.mark.parametrize("small_rows", [10, 2])
def test_band_lookup(spark, small_rows):
    bands = spark.createDataFrame([(18, 24, 1), (25, 34, 2), (34, 60, 3), (75, None, 4)], "lo int, hi int, b int")
    xs = [17.9, 18.0, 23.9, 24.0, 25.0, 33.0, 34.0, 59.0, 60.0, 75.0, 1e6, None, float("nan")]
    out = op.band_lookup(spark.createDataFrame([(x,) for x in xs], "x double"), bands, "x", small_rows)
    got = values(out, "x", "b")
    assert len(got) == len(xs) and out.columns == ["x", "b"]
    want = [None, 1, 1, None, 2, 2, 3, 3, None, 4, 4, None]
    assert sorted((x, b or 0) for x, b in got if x is not None and not math.isnan(x)) == sorted(
        (x, b or 0) for x, b in zip(xs[:11], want))
    assert [b for x, b in got if x is None] == [None]


@pytest.mark.parametrize("small_rows", [10_000, 10])
def test_many_bands(spark, small_rows):
    bands = spark.range(3000).selectExpr("id * 2 as lo", "id * 2 + 1 as hi", "id as b")
    df = spark.range(7000).selectExpr("cast(id as double) as x")
    out = op.band_lookup(df, bands, "x", small_rows)
    assert out.count() == 7000
    assert out.filter("b = x / 2").count() == 3000 and out.filter("b is not null").count() == 3000


# --- splits -----------------------------------------------------------------------------------

@pytest.mark.parametrize("n", [0, 1, 4, 5, 333, 5000])
def test_exact_split(spark, n):
    df = spark.range(n)
    train, test = op.exact_split(df, ["id"])
    assert test.count() == math.ceil(0.2 * n) and train.count() == n - math.ceil(0.2 * n)
    assert train.intersect(test).count() == 0


def test_exact_split_needs_unique_keys(spark):
    df = spark.range(100).selectExpr("0 as k")
    with pytest.raises(op.DuplicateKeys):
        op.exact_split(df, ["k"])


def test_exact_split_finds_cuts_in_deep_prefixes(spark, monkeypatch):
    monkeypatch.setattr(split_module, "STEP", 1)
    df = spark.range(3000)
    assert op.exact_split(df, ["id"])[1].count() == 600


@pytest.mark.parametrize("n, k", [(3, 5), (101, 4), (1000, 5)])
def test_stratified_folds(spark, n, k):
    df = spark.range(n).selectExpr("id", "case when id % 3 = 0 then 'a' when id % 7 > 0 then 'b' end as y")
    out = op.stratified_folds(df, "y", ["id"], k)
    sizes = {(r["y"], r["fold"]): r["count"] for r in out.groupBy("y", "fold").count().collect()}
    assert sum(sizes.values()) == n and {f for _, f in sizes} <= set(range(k))
    for y in {y for y, _ in sizes}:
        counts = [sizes.get((y, f), 0) for f in range(k)]
        assert max(counts) - min(counts) <= 1 and counts == sorted(counts, reverse=True)


def test_hash_split_and_folds(spark):
    df = spark.range(5000)
    train, test = op.hash_split(df, ["id"])
    assert train.count() + test.count() == 5000 and 900 < test.count() < 1100
    folds = op.hash_folds(df, ["id"], 5, seed=43).groupBy("fold").count().collect()
    assert len(folds) == 5 and all(850 < r["count"] < 1150 for r in folds)


# --- scores -----------------------------------------------------------------------------------

def judged(spark):
    return spark.range(3000).select(
        (F.col("id") % 3 == 0).cast("double").alias("label"),
        ((F.col("id") * 7) % 5 < 2).cast("double").alias("prediction"),
        F.round(fn.hash01(1, "id") + (F.col("id") % 3 == 0).cast("double") / 4, 2).alias("score"),
    )


def test_metrics_equal_spark_ml(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
    df = judged(spark)
    ours = op.weighted_metrics(df, "label", "prediction").first()
    for name, metric in (("precision", "weightedPrecision"), ("recall", "weightedRecall"), ("f1_score", "f1")):
        assert ours[name] == pytest.approx(MulticlassClassificationEvaluator(labelCol="label", metricName=metric).evaluate(df))
    binary = op.binary_metrics(df, "label", "prediction").first()
    for name in ("precision", "recall"):
        evaluator = MulticlassClassificationEvaluator(labelCol="label", metricName=name + "ByLabel", metricLabel=1.0)
        assert binary[name] == pytest.approx(evaluator.evaluate(df))
    auc = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0).evaluate(df)
    assert op.roc_auc(df, "label", "score").first()["auc"] == pytest.approx(auc)


def test_auc_over_many_ranges(spark):
    expected = op.roc_auc(judged(spark), "label", "score").first()["auc"]
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    try:
        assert op.roc_auc(judged(spark), "label", "score").first()["auc"] == pytest.approx(expected, rel=1e-12)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_auc_of_infinite_scores(spark):
    df = spark.createDataFrame([(1, math.inf), (1, 0.5), (0, -math.inf), (0, 0.5), (1, -0.0), (0, 0.0), (0, math.nan), (None, 1.0)], "`a.b` int, score double")
    scores = [(1, math.inf), (1, 0.5), (0, -math.inf), (0, 0.5), (1, 0.0), (0, 0.0)]
    pairs = [(p > n) + (p == n) / 2 for y, p in scores if y for z, n in scores if not z]
    assert op.roc_auc(df, "a.b", "score").first()["auc"] == pytest.approx(sum(pairs) / len(pairs))


def test_names_with_dots(spark):
    df = spark.createDataFrame([(1.0,), (50.0,), (2.0,), (None,)], "`a.b` double")
    out = op.invalidate(df, {"a.b": (None, 10.0)})
    assert sorted(str(r[0]) for r in out.collect()) == ["1.0", "2.0", "None", "None"]
    assert op.SigmaTrim(["a.b"], 1.0).fit(df).transform(df).count() == 2


def test_auc_extremes(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.8), (0, 0.1), (0, 0.2)], "label int, score double")
    assert op.roc_auc(df, "label", "score").first()["auc"] == 1.0
    assert op.roc_auc(df.withColumn("score", F.lit(0.5)), "label", "score").first()["auc"] == 0.5
    assert op.roc_auc(df.filter("label = 1"), "label", "score").first()["auc"] is None


def test_metrics_without_positives(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "label int, prediction int")
    assert tuple(op.binary_metrics(df, "label", "prediction").first()) == (0.0, 0.0, 0.0)


def test_mean_fold_accuracy_counts_folds_alike(spark):
    df = spark.createDataFrame([(1, 1, 0), (1, 0, 1), (1, 0, 1), (1, 1, 1)], "y int, p int, fold int")
    each = {r["fold"]: (r["n"], r["accuracy"]) for r in op.fold_accuracy(df, "y", "p", "fold").collect()}
    assert each == {0: (1, 1.0), 1: (3, pytest.approx(1 / 3))}
    assert op.mean_fold_accuracy(df, "y", "p", "fold").first()[0] == pytest.approx(2 / 3)


def test_compare_models_equals_one_by_one(spark):
    df = judged(spark).withColumn("never", F.lit(0))
    got = {(r["model"], r["metric"]): r["value"] for r in op.compare_models(
        df, "label", {"x_sklearn": "prediction", "y_spark": "never"}).collect()}
    for model, column in (("x_sklearn", "prediction"), ("y_spark", "never")):
        for metric, value in op.binary_metrics(df, "label", column).first().asDict().items():
            assert got[model, metric] == value


def test_best_model_ties_and_routes(spark):
    rows = [("b_spark", "spark", "f1_score", 0.5), ("a_sklearn", "sklearn", "f1_score", 0.5),
            ("c_scrape", "scrape", "f1_score", 0.4), ("c_scrape", "scrape", "recall", 0.9)]
    df = spark.createDataFrame(rows, "model string, branch string, metric string, value double")
    assert tuple(op.best_model(df, ["b_spark", "a_sklearn", "c_scrape"]).first()) == ("b_spark", "spark", 0.5)
    assert op.best_model(df, ["a_sklearn", "b_spark", "c_scrape"]).first()["model"] == "a_sklearn"
    assert op.best_model(df, ["c_scrape"]).first()["branch"] == "scrape"


def test_kernel_features_approximate_the_kernel(spark):
    import numpy as np
    df = spark.range(40).select(*[fn.hash01(s, "id").alias(f"x{s}") for s in range(3)], F.lit(0).alias("y"))
    vectors = op.feature_matrix(df, "y")
    model = op.FourierFeatures(4096).fit(vectors)
    rows = model.transform(vectors).select("features", "kernel_features").collect()
    x = np.array([r[0].toArray() for r in rows])
    z = np.array([r[1].toArray() for r in rows])
    gamma = 1 / (x.shape[1] * x.var())
    exact = np.exp(-gamma * ((x[:, None] - x[None]) ** 2).sum(-1))
    assert np.abs(z @ z.T - exact).max() < 0.1


def test_param_grid():
    from pyspark.ml.classification import LogisticRegression
    estimator = LogisticRegression()
    assert len(op.param_grid(estimator, op.LOGISTIC_GRID)) == 3
    assert op.param_grid(estimator, None) == [{}]
