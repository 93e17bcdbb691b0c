"""Page extraction: the native way, the element-tree helper, and where each applies."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from patients import SCHOOL_PAGE
from tabwright import operators as op
from tabwright.operators import extract
from tabwright.plans.queries import QUERIES
from tabwright.plans.rates import school_rates
from tabwright.sources import read_parquet_table


def pages(spark, *htmls):
    return spark.createDataFrame(list(enumerate(htmls)), "page_id int, html string")


def texts(df, *cols):
    return [tuple(r) for r in df.orderBy("page_id", "idx").select(*cols).collect()]


@pytest.mark.parametrize("tree_only", [False, True])
def test_table_rows(spark, tree_only):
    html = """<table><tr><th>Age</th></tr><tr><th scope="row">18-24</th><td>7.3</td><td>9</td></tr>
    <tr><th>75+</th><td title="a>b">3.4 &lt; <b>5</b></td></tr><tr><td>bare</td></tr></table><table></table>"""
    got = op.table_rows(pages(spark, html), 0, tree_only=tree_only)
    assert texts(got, "idx", "key", "value") == [(0, "18-24", "7.3"), (1, "75+", "3.4 < 5"), (2, None, "bare")]
    assert op.table_rows(pages(spark, html), 1, tree_only=tree_only).count() == 0
    assert op.table_rows(pages(spark, html), 5, tree_only=tree_only).count() == 0


@pytest.mark.parametrize("tree_only", [False, True])
def test_lists_by_index(spark, tree_only):
    html = "<ul><li>a</li></ul><UL><li class='x'>b <b>bold</b></li><LI>c&amp;d</LI></UL><!-- <ul> --><ul></ul>"
    df = pages(spark, html, "<p>no list</p>", "")
    assert texts(op.list_items(df, 1, tree_only=tree_only), "page_id", "item") == [(0, "b bold"), (0, "c&d")]
    assert texts(op.list_items(df, tree_only=tree_only), "item") == [("a",), ("b bold",), ("c&d",)]


@pytest.mark.parametrize("html, items", [
    ("<ul><li>a<ul><li>b</li></ul></li><li>c</li></ul>", ["ab", "b", "c"]),  # nested in itself
    ("<ul><li>a<li>b</ul>", ["ab", "b"]),  # closing tags left out: one opens inside the other
    ("<ul><li>&eacute;&#233;</li></ul>", ["éé"]),  # references the native way does not know
    ("<ul><li>a<script>var x = '<li>no</li>';</script></li></ul>", ["a"]),
    ("<ul><li>a</li><!-- <li>no</li> --></ul>", ["a"]),
    ("<ul><li-x>no</li-x><li>yes</li></ul>", ["yes"]),
    ("<ul><li data-t='a>b' class=\"q\">x<br>y</li></ul>", ["xy"]),
    ("</li><ul><li>a</li></ul>", ["a"]),
    ("<ul><li>open", ["open"]),
])
def test_odd_lists_equal_the_tree(spark, html, items):
    df = pages(spark, html)
    assert [t for t, in texts(op.list_items(df), "item")] == items
    assert [t for t, in texts(op.list_items(df, tree_only=True), "item")] == items


def test_by_class(spark):
    df = pages(
        spark, '<div class="ad big">one</div><div class="add">no</div><div id="ad">no</div>'
        '<div class="ad"></div><div class=\'x ad\'>two</div><div data-class="ad">no</div>',
        '<div class="ad">out<div class="ad">in</div></div>',
    )
    want = [(0, "one"), (0, "two"), (1, "outin"), (1, "in")]
    assert texts(op.class_items(df, "div", "ad"), "page_id", "txt") == want
    assert texts(op.class_items(df, "div", "ad", tree_only=True), "page_id", "txt") == want


def test_nested_estimates(spark):
    df = pages(spark, SCHOOL_PAGE)
    got = op.class_items(df, "span", "ds-data-point ds-2017", inner="dp-data-estimate", within="ds-data-table-container")
    assert [t for t, in texts(got, "txt")] == ["8.8", "9.8", "7.6", "5.4", "7.5", "9.8", "13.4"]
    assert [t for t, in texts(school_rates(df), "value")] == ["5.4", "7.5", "9.8", "13.4"]


@pytest.mark.parametrize("run", [
    lambda p, **o: op.list_items(p, **o), lambda p, **o: op.list_items(p, 0, **o),
    lambda p, **o: op.class_items(p, "div", "ad", **o),
])
def test_both_ways_agree_on_whole_pages(spark, small, run):
    df = read_parquet_table(spark, small, "pages").select("page_id", "html")
    assert sorted(run(df).collect()) == sorted(run(df, tree_only=True).collect())


def odd_pages(n, seed=8):
    rng = random.Random(seed)
    some = ['<div class="box">', '<div class="row a">', '<div class="cell">', "<div class='cell x'>", "<div>", "</div>", "</div>", "</div>",
            "<b>", "</b>", "<p class=box>", "</p>", "<br>", '<div class="cell"/>', "</br>", "text", " one ", "&amp;", "a&lt;b", "<!-- <div> -->",
            '<span class="row">', "</span>", '<img class="cell" src=x>', "<script>var x='<div>'</script>", "<DIV CLASS=cell>", "</Div >"]
    rare = ["&eacute;", '<div class="a" class="cell">', "<div title='</div>'>", "<title>a<b>c</title>", "<a href=x/>", "<", "<!-- open", "&#65;", '<div class="r&amp;w">']
    return ["".join(rng.choice(rare if rng.random() < 0.02 else some) for _ in range(rng.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("options", [
    {"cls": "row", "inner": "cell"}, {"cls": "cell", "within": "box"}, {"cls": "row a", "inner": "cell", "within": "box"}, {"cls": "box", "inner": "box"},
])
def test_nested_classes_equal_the_tree_on_odd_pages(spark, options):
    df = pages(spark, *odd_pages(400)).repartition(4)
    native = op.class_items(df, "div", **options).collect()
    assert sorted(native) == sorted(op.class_items(df, "div", tree_only=True, **options).collect()) and len(native) > 10


def test_most_odd_pages_need_no_parser(spark):
    df = pages(spark, *odd_pages(400), "<title>t &copy;</title><div class=box><div class=cell>x</div></div> &copy; " + "<i>" * 3000)
    told = extract._nested_native(df, "div", "cell", None, "box").select("page_id", "flat").collect()
    assert sum(r.flat for r in told) > 200 and {r.page_id: r.flat for r in told}[400]


@pytest.mark.parametrize("name", ["html_nested_class", "html_table_rows"])
def test_pages_written_from_a_table_of_one_split_are_read_by_all_tasks(spark, small, name):
    assert read_parquet_table(spark, small, "part").rdd.getNumPartitions() == 1
    assert QUERIES[name](spark, small).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_missing_page_gives_no_rows(spark):
    df = spark.createDataFrame([(1, None)], "page_id int, html string")
    assert op.list_items(df).count() == 0 and op.table_rows(df).count() == 0


def test_slice_of_lists(spark):
    lists = op.page_lists(pages(spark, "<ul><li>a</li><li>b</li><li>c</li></ul>", "<ul><li>z</li></ul>"))
    assert [r["items"] for r in op.list_tail(lists, -2, None).orderBy("page_id").collect()] == [["b", "c"], ["z"]]
    assert lists.select(F.size("items")).count() == 2
