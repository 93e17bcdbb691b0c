"""Missing values, exact values, compound keys, overlapping bands, many labels and odd pages."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tabwright import operators as op
from tabwright.functions import keyed_md5
from tabwright.operators import split
from tabwright.operators.profile import cardinality_profile, column_modes

NAN = float("nan")


def test_sigma_trim_trims_nan(spark):
    df = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 2, 1, 2)] + [(NAN,), (None,)], "x double")
    assert sorted(r.x for r in op.SigmaTrim(["x"]).fit(df).transform(df).collect()) == [1, 1, 2, 2, 2, 3]


def test_zscore_skips_nan(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (NAN,), (None,)], "x double")
    got = op.ZScoreLog(["x"], drop_source=False).fit(df).transform(df).collect()
    assert [r.x_z is None for r in got] == [False, False, True, True] and got[0].x_z == -got[1].x_z


def test_target_encode_skips_nan_labels(spark):
    df = spark.createDataFrame([(k % 3, NAN if k < 3 else float(k % 2)) for k in range(30)], "c int, y double")
    got = op.TargetEncode(["c"], "y").fit(df).transform(df).collect()
    assert all(0 <= r.c_target <= 1 for r in got)


@pytest.mark.parametrize("n", [2, 200])
def test_nan_is_in_no_band_and_overlaps_are_refused(spark, n):
    bands = spark.createDataFrame([(float(k), float(k + 1) if k < n - 1 else None, k) for k in range(n)], "lo double, hi double, b int")
    df = spark.createDataFrame([(0.5,), (1e9,), (NAN,), (None,), (-1.0,)], "x double")
    found = {str(r.x): r.b for r in op.band_lookup(df, bands, "x").collect()}
    assert found == {"0.5": 0, "1000000000.0": n - 1, "nan": None, "None": None, "-1.0": None}
    with pytest.raises(ValueError, match="overlap"):
        op.band_lookup(df, bands.union(spark.createDataFrame([(0.5, 0.7, 9)], bands.schema)), "x")


def test_decimals_stay_exact(spark):
    values = [Decimal("12345678901234567890.12"), Decimal("12345678901234567890.13"), Decimal("12345678901234567890.13"), None]
    df = spark.createDataFrame([(v,) for v in values], "d decimal(38,2)")
    assert cardinality_profile(df, ["d"]).first()[1:] == (2, 3)
    assert column_modes(df, ["d"]) == {"d": values[1]}


def test_compound_keys_are_one_to_one(spark):
    df = spark.createDataFrame([("a:b", "c"), ("a", "b:c"), (None, "x"), ("", "x"), ("-", "x")], "k string, l string")
    assert df.select(keyed_md5(1, "k", "l")).distinct().count() == 5
    train, test = op.exact_split(df, ["k", "l"], test=0.4)
    assert (train.count(), test.count()) == (3, 2)


def test_rate_grid_needs_one_ratio(spark):
    bands = spark.createDataFrame([(0, 100, 1.0, 1.0)], "lo int, hi int, rate1 double, rate2 double")
    grid = spark.createDataFrame([(1, 5)], "sex int, age int")
    for rows in ([], [(1.0,), (2.0,)], [(None,)]):
        with pytest.raises(ValueError, match="one ratio"):
            op.rate_grid(grid, bands, spark.createDataFrame(rows, "ratio double"))


@pytest.mark.parametrize("labels", [50, 1000])
def test_folds_for_many_labels(spark, labels, monkeypatch):
    monkeypatch.setattr(split, "STEP", 1)
    monkeypatch.setattr(split, "RANKED_ROWS", 500)
    df = spark.range(20_000).select("id", F.pmod(F.xxhash64("id"), F.lit(labels)).alias("y"))
    got = op.stratified_folds(df, "y", ["id"], k=3)
    want = df.withColumn("h", keyed_md5(42, "id")).selectExpr("id", "ntile(3) OVER (PARTITION BY y ORDER BY h) - 1 AS fold")
    assert got.join(want, ["id", "fold"]).count() == 20_000


ODD_PAGES = [
    "<ul><li>a</ul></li><ul><li>b</li></ul>", "<table><tr><th>h</th><td>v</tr></td></table>", '<p title="<li>q</li>">z</p><li>b</li>',
    '<div data-x="a class=ad">t</div>', '<div title="a > b" class="ad">t</div>', '<div class="ad&#32;x">t</div>',
    "<ul><div></ul><li>a</li></div>", "<div class=ad class=b>t</div>", "<div CLASS = 'x ad'>t</div>", '<p title="<!--">a</p><li>b</li><p title="-->">',
]


def odd_page(rng):
    parts = ["<ul>", "</ul>", "<li>", "</li>", "<table>", "</table>", "<tr>", "</tr>", "<th>", "</th>", "<td>", "</td>", '<div class="ad">', "</div>",
             "<div data-x='class=ad'>", "<b>", "</b>", "x", "y &amp; z", "<br>", '<a title="</li>">', "</a>", "<!-- <li>c</li> -->"]
    return "".join(rng.choice(parts) for _ in range(rng.randrange(3, 25)))


@pytest.mark.parametrize("find", [
    lambda p, **o: op.table_rows(p, 0, **o), lambda p, **o: op.list_items(p, 0, **o), lambda p, **o: op.list_items(p, **o),
    lambda p, **o: op.class_items(p, "div", "ad", **o),
])
def test_native_and_tree_agree_on_odd_pages(spark, find):
    rng = random.Random(7)
    whole = ["<ul><li>a</li><li>b <b>c</b></li></ul>", "<table><tr><th>h</th><td>v</td></tr></table>", '<div class="ad">t</div>']
    pages = ODD_PAGES + whole + [odd_page(rng) for _ in range(400)] + [rng.choice(whole) + odd_page(rng) for _ in range(100)]
    df = spark.createDataFrame(list(enumerate(pages)), "page_id long, html string")
    native, tree = (sorted(map(tuple, find(df, tree_only=t).collect()), key=str) for t in (False, True))
    assert native == tree and native
