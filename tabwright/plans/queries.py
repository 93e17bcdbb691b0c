"""One query per operator over the generated tables; ``oracles.py`` has the SQL for each.

The tables hold no missing values, so rules on their own columns make some.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright import operators as op
from tabwright.functions import average_rates, clamp, hash01, list_slice, number_in, to_double
from tabwright.plans import clean
from tabwright.plans.rates import BANDS_AS_CODED, bands_frame, sliced_items, with_rates
from tabwright.sources import (
    FolderTables, export_csv, pin_small, read_best, read_csv, read_metrics, read_parquet_table, run_step, scratch_folder,
    write_best, write_metrics,
)

MEASURES = ["l_quantity", "l_extendedprice", "l_discount"]


def _read(spark: SparkSession, folder: str, name: str, *cols: str | Column) -> DataFrame:
    df = read_parquet_table(spark, folder, name)
    return df.select(*cols) if cols else df


def _spread(df: DataFrame) -> DataFrame:
    """The rows dealt to all tasks: a table of few bytes is few splits, however much work its rows are."""
    spark = df.sparkSession
    return df.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism))


def _rounded(df: DataFrame, digits: int, *cols: str) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


# --- sources and steps ------------------------------------------------------------------------

def table_scan(spark, folder):
    return _read(spark, folder, "nation")


def multi_table_step(spark, folder):
    def step(orders, customers):
        # per customer first, so that a customer with very many orders crosses the join as three rows
        spent = orders.groupBy("o_custkey", "o_orderstatus").agg(
            F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("price"))
        joined = spent.join(customers, spent.o_custkey == customers.c_custkey)
        ordering = customers.join(orders.select(F.col("o_custkey").alias("c_custkey")).distinct(), "c_custkey", "left_semi")
        return {"customer": ordering, "spent": joined.groupBy("c_mktsegment", "o_orderstatus").agg(
            F.sum("n").alias("n_orders"), F.round(F.sum("price") / F.sum("n"), 4).alias("mean_price"))}
    store = FolderTables(spark, scratch_folder(spark))
    store.write({t: _read(spark, folder, t) for t in ("orders", "customer")})
    store.write({"spent": store.read("customer")})  # an output of an earlier run, dropped first
    run_step(store, ["orders", "customer"], step, drop_first=["spent"])
    left = store.read("customer").groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("n_customers"))
    return store.read("spent").join(left, "c_mktsegment")


def csv_round_trip(spark, folder):
    documents = _read(spark, folder, "documents")  # texts with line feeds, quotes and outer blanks
    path = scratch_folder(spark)
    export_csv(documents, path)
    return read_csv(spark, path, documents.schema)


def csv_bad_records(spark, folder):
    """Customers whose lines were damaged: every 11th lacks a field, every 13th has a word for a number, every 17th a comma too many."""
    key, name = F.col("c_custkey").cast("string"), F.col("c_name")
    line = F.when(F.col("c_custkey") % 11 == 0, F.concat_ws(",", key, name)) \
        .when(F.col("c_custkey") % 13 == 0, F.concat_ws(",", key, name, F.lit("many"))) \
        .when(F.col("c_custkey") % 17 == 0, F.concat_ws(",", key, name, F.col("c_nationkey"), F.lit(""))) \
        .otherwise(F.concat_ws(",", key, name, F.col("c_nationkey")))
    path = scratch_folder(spark)
    _read(spark, folder, "customer").select(line).write.text(path)
    schema = T.StructType.fromDDL("c_custkey bigint, c_name string, c_nationkey bigint")
    rows = read_csv(spark, path, schema, header=False, corrupt="bad")
    kind = F.when(F.col("bad").isNull(), "whole").when(F.col("c_custkey") % 11 == 0, "short").when(F.col("c_custkey") % 13 == 0, "no number") \
        .otherwise("long")
    return rows.groupBy(kind.alias("kind")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("c_custkey").alias("sum_keys"), F.sum("c_nationkey").alias("sum_nations"))


# --- projection, filter, cleaning -------------------------------------------------------------

def project_rename(spark, folder):
    df = op.select_at(_read(spark, folder, "lineitem"), [0, 3, 4, 8, 9], ["orderkey", "line", "qty", "flag", "status"])
    return op.drop_columns(op.rename(df, {"qty": "quantity"}), ["status"])


def add_null(spark, folder):
    """Customers with an empty column for a rate that is looked up later."""
    customers = _read(spark, folder, "customer", "c_custkey", "c_name")
    return op.add_null(op.add_null(customers, "smoke"), "rate", "double")


def _gappy_lineitem(spark, folder) -> DataFrame:
    """Quantities below 5 and discounts of 0 taken as missing."""
    df = _read(spark, folder, "lineitem", "l_orderkey", "l_linenumber", *MEASURES, "l_returnflag")
    return op.invalidate(df, {"l_quantity": (5, None), "l_discount": (0.005, None)})


def require_not_null(spark, folder):
    return op.require(_gappy_lineitem(spark, folder), "l_quantity", "l_discount")


def cast_numeric(spark, folder):
    digits = F.regexp_extract("props", "([0-9]+)", 1)
    raw = _read(spark, folder, "events", "event_id", F.when(F.length(digits) > 1, digits).otherwise("").alias("k"),
                F.when(F.col("event_type") == "error", "NaN").otherwise(F.col("value").cast("string")).alias("value"))
    return op.cast_numeric(raw, ["k", "value"])


def invalidate_range(spark, folder):
    df = _read(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    return op.invalidate(df, {"l_quantity": (5, 45), "l_discount": (None, 0.08), "l_tax": (0.01, None)})


def drop_sparse_columns(spark, folder):
    df = _gappy_lineitem(spark, folder)
    df = op.invalidate(df, {"l_extendedprice": (2000, None), "l_quantity": (20, None)})
    return op.DropSparse(0.1).fit(df).transform(df)


def sigma_trim(spark, folder):
    df = _read(spark, folder, "lineitem", "l_orderkey", "l_linenumber", *MEASURES)
    return op.SigmaTrim(MEASURES, 1.5).fit(df).transform(df)


# --- profiles ---------------------------------------------------------------------------------

def missing_profile(spark, folder):
    return _rounded(op.missing_profile(_gappy_lineitem(spark, folder)), 6, "pct_missing")


def numeric_profile(spark, folder):
    return _rounded(op.numeric_profile(_gappy_lineitem(spark, folder), MEASURES), 4, "mean", "sd")


def skew_profile(spark, folder):
    df = _read(spark, folder, "events", "value", to_double(number_in(F.col("props"))).alias("k"))
    return _rounded(op.skew_profile(df, ["value", "k"]), 6, "skewness")


def cardinality_profile(spark, folder):
    df = _gappy_lineitem(spark, folder).withColumn("l_returnflag", F.nullif("l_returnflag", F.lit("A")))
    return op.cardinality_profile(df, ["l_quantity", "l_discount", "l_linenumber", "l_returnflag"])


def cardinality_sketch(spark, folder):
    """Distinct values from sketches stored by ship year, the last year added later, and whether they keep their bound."""
    cols = ["l_orderkey", "l_partkey", "l_extendedprice", "l_discount"]
    lines = _gappy_lineitem(spark, folder).join(_read(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", F.year("l_shipdate").alias("year")),
                                                ["l_orderkey", "l_linenumber"])
    path = scratch_folder(spark)
    op.store_sketches(op.distinct_sketches(lines.where("year < 1998"), F.col("year"), cols), path)
    op.store_sketches(op.distinct_sketches(lines.where("year >= 1998"), F.col("year"), cols), path)
    estimate = op.merged_distinct(spark.read.parquet(path))
    exact = op.cardinality_profile(lines, cols)
    apart = F.abs(F.col("n_distinct") - F.col("n_values")) / F.col("n_values")
    return estimate.join(exact, "col_name").select("col_name", "n", "n_values", (apart <= op.error_bound()).alias("within_bound"))


# --- imputation -------------------------------------------------------------------------------

def impute_mean(spark, folder):
    df = _gappy_lineitem(spark, folder)
    filled = op.Impute({"l_quantity": "mean", "l_discount": "mean"}, fill_under=0.09).fit(df).transform(df)
    return _rounded(filled, 6, "l_quantity", "l_discount")


def impute_mode(spark, folder):
    df = op.invalidate(_read(spark, folder, "part", "p_partkey", "p_size", "p_type", "p_brand"), {"p_size": (None, 45)})
    df = df.withColumn("p_brand", F.nullif("p_brand", F.lit("Brand#7")))
    return op.Impute({"p_size": "mode", "p_brand": "mode"}, prefix="imp_").fit(df).transform(df)


def invalidate_impute(spark, folder):
    df = _read(spark, folder, "lineitem", "l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax")
    df = op.invalidate(df, {"l_quantity": (5, 45), "l_discount": (None, 0.08), "l_tax": (0.01, None)})
    fit = op.Impute({"l_quantity": "mean", "l_discount": "mode", "l_tax": "mode"}, prefix="imp_").fit(df)
    return _rounded(fit.transform(df), 6, "imp_l_quantity")


# --- transforms -------------------------------------------------------------------------------

def log_abs_query(spark, folder):
    df = op.log_abs_columns(_read(spark, folder, "customer", "c_custkey", "c_acctbal"), ["c_acctbal"])
    return _rounded(df, 6, "log_c_acctbal")


def zscore_log(spark, folder):
    df = _read(spark, folder, "orders", "o_orderkey", "o_totalprice")
    out = op.ZScoreLog(["o_totalprice"], drop_source=False).fit(df).transform(df)
    return _rounded(out, 6, "o_totalprice_z", "o_totalprice_z_log")


def log1p_columns(spark, folder):
    df = op.log1p_columns(_read(spark, folder, "orders", "o_orderkey", "o_totalprice"), ["o_totalprice"])
    return _rounded(df, 6, "o_totalprice")


def target_encode(spark, folder):
    df = _gappy_lineitem(spark, folder).select(
        "l_orderkey", "l_linenumber", "l_quantity", F.nullif("l_returnflag", F.lit("N")).alias("flag"),
        _flag(F.col("l_extendedprice") > 40000).alias("label"),
        _flag(F.col("l_discount") > 0.05).alias("cheap"),
    ).withColumn("line", F.col("l_linenumber"))
    out = op.TargetEncode(["line", "l_quantity", "flag", "cheap"], "label").fit(df).transform(df)
    return _rounded(out, 6, "line_target", "l_quantity_target", "flag_target")


def feature_matrix(spark, folder):
    df = _read(spark, folder, "lineitem", "l_orderkey", "l_linenumber", *MEASURES,
               _flag(F.col("l_returnflag") == "R").alias("label"))
    v = vector_to_array("features")
    return op.feature_matrix(df, "label", ["l_orderkey", "l_linenumber"]).select(
        "l_orderkey", "l_linenumber", "label", *[F.round(v[i], 4).alias(f"f{i}") for i in range(3)],
    )


def _gappy_orders(spark, folder) -> DataFrame:
    """Orders with their customer: three columns with few gaps, one with many, one without."""
    orders = _read(
        spark, folder, "orders", "o_orderkey", "o_custkey", F.nullif("o_orderpriority", F.lit("?")).alias("priority"),
        F.when(F.col("o_totalprice") <= 480000, F.col("o_totalprice")).alias("price"),
        ((F.year("o_orderdate") - 1992) * 12 + F.month("o_orderdate")).cast("double").alias("months"),
        _flag(F.col("o_orderstatus") == "F").alias("target"),
    )
    customers = _read(
        spark, folder, "customer", "c_custkey", F.nullif("c_nationkey", F.lit(7)).alias("nation"),
        F.when(F.col("c_acctbal") >= -500, F.col("c_acctbal")).alias("balance"),
        F.when(~F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), F.col("c_mktsegment")).alias("segment"),
    )
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey", "c_custkey")


def clean_table(spark, folder):
    roles = clean.Roles("target", "o_orderkey", ["price", "balance", "months"], ["priority", "nation", "segment"])
    df = _gappy_orders(spark, folder)
    _, out = clean.fit_clean(df, roles, k=1.6)
    return _rounded(out, 6, "price", "balance", "nation_target", "priority_target")


def split_features(spark, folder):
    df = _read(spark, folder, "orders", "o_orderkey", "o_totalprice", F.col("o_totalprice").alias("price"))
    parts = clean.split_and_transform(df, ["o_orderkey"], ["price"], ["o_totalprice"], drop_source=False)
    return _rounded(clean.reunited(*parts), 6, "log_price", "o_totalprice_z", "o_totalprice_z_log")


# --- lookups and rates ------------------------------------------------------------------------

def _priority_rates(spark, folder) -> DataFrame:
    """Percent of finished orders per priority, without the lowest one: its orders find no match."""
    df = _read(spark, folder, "orders", "o_orderpriority", "o_orderstatus").filter("o_orderpriority <> '5-LOW'")
    return df.groupBy("o_orderpriority").agg(
        F.round(F.avg(_flag(F.col("o_orderstatus") == "F")) * 100, 6).alias("smoke_rate")
    )


def _aged_lines(spark, folder) -> DataFrame:
    """Lines with an age (months since the first year, clamped at 75) and a sex (line status)."""
    month = (F.year("l_shipdate") - 1995) * 12 + F.month("l_shipdate") - 1
    return _read(spark, folder, "lineitem", "l_orderkey", "l_linenumber", month.alias("months"),
                 _flag(F.col("l_linestatus") == "F").alias("sex"), "l_returnflag", "l_discount", "l_quantity")


def _age_rates(spark, folder) -> DataFrame:
    """Percent of returned lines per (sex, age) up to 75."""
    df = _aged_lines(spark, folder).filter("months <= 75")
    return df.groupBy("sex", F.col("months").alias("age")).agg(
        F.round(F.avg(_flag(F.col("l_returnflag") == "R")) * 100, 6).alias("smoke_rate")
    )


def lookup_join(spark, folder):
    lines = _aged_lines(spark, folder).select("l_orderkey", "l_linenumber", "months", "sex")
    on = {"sex": F.col("sex"), "age": clamp(F.col("months"), 75)}
    rates = _age_rates(spark, folder)
    return op.lookup(lines, rates, on)


def lookup_skewed(spark, folder):
    """Parts of lines, a third of which name the same part, in a table beyond the broadcast limit."""
    part = F.when(F.col("l_orderkey") % 3 == 0, F.lit(1)).when(F.col("l_linenumber") == 7, F.lit(None)).otherwise(F.col("l_partkey"))
    lines = _read(spark, folder, "lineitem", "l_orderkey", "l_linenumber", part.cast("bigint").alias("part"))
    names = _read(spark, folder, "part", F.col("p_partkey").alias("key"), "p_name", "p_size").where("p_size <> 13")
    return op.lookup(lines, names, {"key": F.col("part")}, small_rows=100)


def prob_impute(spark, folder):
    orders = _read(spark, folder, "orders", "o_orderkey", "o_orderpriority")
    on = {"o_orderpriority": F.col("o_orderpriority")}
    return op.prob_impute(orders, _priority_rates(spark, folder), on, ["o_orderkey"])


def _measured_bands(spark, folder) -> DataFrame:
    """The adult bands with rates measured on the lines: returned by band 1, discounted by band 2."""
    bands = bands_frame(spark, BANDS_AS_CODED)
    placed = op.band_lookup(_aged_lines(spark, folder).filter("months >= 18"), bands, "months")
    cells, _ = pin_small(placed.groupBy("first", "second").agg(  # one row per band, used twice
        F.count(F.lit(1)).alias("n"), F.sum(_flag(F.col("l_returnflag") == "R")).alias("returned"),
        F.sum(_flag(F.col("l_discount") > 0.05)).alias("discounted"),
    ))

    def measured(index: str, hits: str) -> DataFrame:
        percent = F.round(F.sum(hits) * 100.0 / F.sum("n"), 6)
        return cells.groupBy(F.col(index).alias("idx")).agg(percent.cast("string").alias("value"))

    return with_rates(bands, measured("first", "returned"), measured("second", "discounted"))


def band_lookup(spark, folder):
    lines = _aged_lines(spark, folder).select("l_orderkey", "l_linenumber", "months")
    placed = op.band_lookup(lines, _measured_bands(spark, folder), "months")
    mean = average_rates(F.col("rate1"), F.col("rate2"))
    return placed.withColumn("mean_rate", F.round(mean, 6))


def rate_grid(spark, folder):
    lines = _aged_lines(spark, folder)
    by_sex = [F.avg(F.when(F.col("sex") == s, F.col("l_quantity"))) for s in (1, 0)]
    ratio = lines.agg((by_sex[0] / by_sex[1]).alias("ratio"))
    grid = op.rate_grid(op.key_grid(spark), _measured_bands(spark, folder), ratio)
    return _rounded(grid, 6, "smoke_rate")


# --- pages ------------------------------------------------------------------------------------

def html_items(spark, folder):
    return op.list_items(_read(spark, folder, "pages", "page_id", "html"))


def html_first_list(spark, folder):
    return op.list_items(_read(spark, folder, "pages", "page_id", "html"), 0)


def text_slice_query(spark, folder):
    """Every page's first list, its items cut at offsets that depend on their position."""
    slices = [(0, 3, "", 3, 6), (1, 4, "", 0, 2), (0, 2, "+", 2, 9)]
    return sliced_items(_read(spark, folder, "pages", "page_id", "html"), 0, slices)


def html_by_class(spark, folder):
    return op.class_items(_read(spark, folder, "pages", "page_id", "html"), "div", "ad")


def html_nested_class(spark, folder):
    """Names of parts from nested cards, some of whose closing tags are left out or stand alone."""
    name, kind = F.col("p_name"), F.col("p_type")
    card = F.concat(F.lit('<div class="card hot"><div class="name first"><b>'), name, F.lit("</b></div><div class=kind>"), kind, F.lit("</div></div>"))
    odd = F.concat(F.lit('<div class="card"></i><p><div class="name">'), name, F.lit('</p></div></div><br><div class="note">'), kind, F.lit("</div>"))
    page = F.concat(
        F.lit('<!doctype html><title>parts &copy;</title><div class="card"><div class="name">outside</div></div><div class="shelf">'),
        F.when(F.col("p_partkey") % 7 == 0, odd).otherwise(card), F.lit('</div><div class="card"><div class="name">after</div></div>'))
    pages = _spread(_read(spark, folder, "part", "p_partkey", "p_name", "p_type")).select(F.col("p_partkey").alias("page_id"), page.alias("html"))
    return op.class_items(pages, "div", "card", inner="name", within="shelf")


def html_list_tail(spark, folder):
    lists = op.page_lists(_read(spark, folder, "pages", "page_id", "html"))
    return lists.select("page_id", *[
        F.concat_ws("|", list_slice(F.col("items"), lo, hi)).alias(name)
        for name, lo, hi in (("tail", -4, None), ("middle", 1, 3), ("none", 900, 905))
    ])


def html_table_rows(spark, folder):
    """Every part written out as a page with a table, and read back from it."""
    def row(head: str, *cells: str | Column) -> Column:
        tags = [F.concat(F.lit("<td>"), F.lit(c) if isinstance(c, str) else c, F.lit("</td>")) for c in cells]
        return F.concat(F.lit(f'<tr class="r">\n<th scope="row">{head}</th>'), *tags, F.lit("</tr>"))
    html = F.concat(
        F.lit("<p>Part</p><table><tr><th>other</th><td>no</td></tr></table><!-- <table> -->"),
        F.lit('<TABLE id="t>1"><tr><th>Field</th><th>Value</th></tr>'),
        row("name", F.col("p_name"), "x"), row("R&amp;D <b>brand</b>", F.col("p_brand")),
        row("size", F.col("p_size").cast("string"), "mm"), F.lit("</TABLE>"),
    )
    pages = _spread(_read(spark, folder, "part", "p_partkey", "p_name", "p_brand", "p_size")).select(F.col("p_partkey").alias("page_id"), html.alias("html"))
    return op.table_rows(pages, 1)


# --- splits -----------------------------------------------------------------------------------

def exact_split(spark, folder):
    orders = _read(spark, folder, "orders", "o_orderkey", "o_totalprice")
    return orders.withColumn("is_test", _flag(op.exact_test_flag(orders, ["o_orderkey"])))


def hash_split(spark, folder):
    train, test = op.hash_split(_read(spark, folder, "orders", "o_orderkey"), ["o_orderkey"])
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


def stratified_folds(spark, folder):
    orders = _read(spark, folder, "orders", "o_orderkey", "o_orderstatus")
    return op.stratified_folds(orders, "o_orderstatus", ["o_orderkey"])


# --- scores and choice ------------------------------------------------------------------------

def _judged_lines(spark, folder) -> DataFrame:
    """Returned lines as label, three rules as predictions, and a score."""
    return _read(
        spark, folder, "lineitem", _flag(F.col("l_returnflag") == "R").alias("label"),
        _flag(F.col("l_discount") > 0.05).alias("by_discount"), _flag(F.col("l_quantity") < 25).alias("by_quantity"),
        _flag(F.col("l_extendedprice") > 1e9).alias("never"), F.col("l_extendedprice").alias("score"),
    )


def binary_metrics(spark, folder):
    out = op.binary_metrics(_judged_lines(spark, folder), "label", "by_discount")
    return _rounded(out, 6, *out.columns)


def weighted_metrics(spark, folder):
    out = op.weighted_metrics(_judged_lines(spark, folder), "label", "by_discount")
    return _rounded(out, 6, *out.columns)


def roc_auc(spark, folder):
    return _rounded(op.roc_auc(_judged_lines(spark, folder), "label", "score"), 6, "auc")


def fold_accuracy(spark, folder):
    orders = _read(
        spark, folder, "orders", "o_orderkey", _flag(F.col("o_orderstatus") == "F").alias("label"),
        _flag(F.col("o_totalprice") > 200000).alias("guess"),
    )
    each = op.fold_accuracy(op.hash_folds(orders, ["o_orderkey"]), "label", "guess", "fold")
    mean = F.avg("accuracy").over(Window.partitionBy(F.lit(0)))  # over one row per fold
    return _rounded(each.withColumn("mean_accuracy", mean), 6, "accuracy", "mean_accuracy")


RULES = {"rule_sklearn": "by_discount", "rule_scrape": "by_quantity", "rule_spark": "never"}


def metrics_long(spark, folder):
    return _rounded(op.compare_models(_judged_lines(spark, folder), "label", RULES), 6, "value")


def best_model(spark, folder):
    return op.best_model(metrics_long(spark, folder), list(RULES))


def metrics_store(spark, folder):
    """Scores written per model, one model written again, read by list; the best of them stored and read back."""
    path = scratch_folder(spark)
    scores = metrics_long(spark, folder)
    for _ in range(2):
        write_metrics(scores, path)
        scores = scores.filter("model = 'rule_scrape'").withColumn("value", F.lit(0.0))
    known = read_metrics(spark, path, ["rule_sklearn", "rule_scrape"])
    write_best(op.best_model(known, list(RULES)), f"{path}-best")
    return known.withColumn("best", F.lit(read_best(spark, f"{path}-best")))


# --- training ---------------------------------------------------------------------------------

FEATURES = ["o_totalprice", "c_acctbal", "months", "priority"]


def _labelled_orders(spark, folder) -> DataFrame:
    """Orders with their customer: a label that leans on price, priority and balance."""
    orders = _read(
        spark, folder, "orders", "o_orderkey", "o_custkey", "o_totalprice",
        ((F.year("o_orderdate") - 1992) * 12 + F.month("o_orderdate")).cast("double").alias("months"),
        F.substring("o_orderpriority", 1, 1).cast("double").alias("priority"),
    )
    customers = _read(spark, folder, "customer", "c_custkey", "c_acctbal")
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    lean = F.col("o_totalprice") / 500000 + F.col("priority") / 10 + F.col("c_acctbal") / 40000
    return joined.select(
        "o_orderkey", *FEATURES, (lean + hash01(7, "o_orderkey") > 1.35).cast("double").alias("target"),
    )


def _trained(spark, folder, name):
    _, metrics = op.train_and_evaluate(_labelled_orders(spark, folder), op.RECIPES[name], "target", ["o_orderkey"])
    return metrics


def train_lr(spark, folder):
    return _trained(spark, folder, "Logistic_sklearn")


def train_lr_grid(spark, folder):
    return _trained(spark, folder, "lr_spark")


def train_rf(spark, folder):
    return _trained(spark, folder, "RF_sklearn")


def train_svm(spark, folder):
    return _trained(spark, folder, "SVM_sklearn")


def final_test(spark, folder):
    train, test = op.exact_split(_labelled_orders(spark, folder), ["o_orderkey"])
    return op.final_test(train, test, op.RECIPES["Logistic_sklearn"], "target", ["o_orderkey"])


def _discrete_orders(spark, folder, label: Column) -> DataFrame:
    """Orders with a flag for each priority and for open ones, and a label that these decide."""
    digit = F.substring("o_orderpriority", 1, 1).cast("int")
    flags = [_flag(digit == k).cast("double").alias(f"p{k}") for k in range(1, 6)]
    open_ = _flag(F.col("o_orderstatus") == "O").cast("double").alias("open")
    orders = _read(spark, folder, "orders", "o_orderkey", *flags, open_, (F.col("o_totalprice") / 1e6).alias("price"))
    return orders.withColumn("label", label)


def predict_ovr(spark, folder):
    """Three labels that priorities decide, one against the rest, on the held-out fifth."""
    label = F.when(F.col("p1") == 1, "now").when((F.col("p2") == 1) | (F.col("p3") == 1), "soon").otherwise("late")
    return op.held_out_predictions(
        _discrete_orders(spark, folder, label), lambda rows: op.OneAgainstRest("label", c=100.0), "label", ["o_orderkey"])


def predict_lr(spark, folder):
    label = ((F.col("p1") == 1) | (F.col("p2") == 1)).cast("double")
    return op.held_out_predictions(
        _discrete_orders(spark, folder, label), lambda rows: op.logistic("label", rows, 100.0), "label", ["o_orderkey"])


def predict_rf(spark, folder):
    label = (((F.col("p1") == 1) | (F.col("p2") == 1)) & (F.col("open") == 1)).cast("double")
    return op.held_out_predictions(
        _discrete_orders(spark, folder, label), lambda rows: op.forest("label", rows, trees=30, depth=8), "label", ["o_orderkey"])


def predict_svm(spark, folder):
    """A label that no line separates: urgent or open, but not both."""
    label = (((F.col("p1") == 1) | (F.col("p2") == 1)) != (F.col("open") == 1)).cast("double")
    return op.held_out_predictions(
        _discrete_orders(spark, folder, label).drop("price"), lambda rows: op.svm("label", rows, 10.0), "label", ["o_orderkey"])


def predict_lr_grid(spark, folder):
    """The grid's best setting over keyed folds, on the rows that the keyed split holds back."""
    label = ((F.col("p1") == 1) | (F.col("p2") == 1)).cast("double")
    rows = op.prepare(_discrete_orders(spark, folder, label), op.RECIPES["lr_spark"], "label", ["o_orderkey"])
    model, _ = op.fit_prepared(rows, op.RECIPES["lr_spark"])
    return op.predict(model, rows.held, ["o_orderkey"])


def predict_final(spark, folder):
    """The last test: a recipe fitted on all training rows predicts the test rows."""
    label = ((F.col("p1") == 1) | (F.col("p2") == 1)).cast("double")
    train, test = op.exact_split(_discrete_orders(spark, folder, label), ["o_orderkey"])
    return op.final_predictions(train, test, op.RECIPES["Logistic_sklearn"], "label", ["o_orderkey"]).drop("label")


QUERIES = {
    "table_scan": table_scan, "multi_table_step": multi_table_step, "csv_round_trip": csv_round_trip,
    "csv_bad_records": csv_bad_records, "predict_ovr": predict_ovr, "predict_lr": predict_lr, "predict_rf": predict_rf,
    "predict_svm": predict_svm, "predict_lr_grid": predict_lr_grid, "predict_final": predict_final,
    "project_rename": project_rename, "add_null": add_null, "require_not_null": require_not_null, "cast_numeric": cast_numeric,
    "invalidate_range": invalidate_range, "drop_sparse_columns": drop_sparse_columns, "sigma_trim": sigma_trim,
    "missing_profile": missing_profile, "numeric_profile": numeric_profile, "skew_profile": skew_profile,
    "cardinality_profile": cardinality_profile, "cardinality_sketch": cardinality_sketch,
    "impute_mean": impute_mean, "impute_mode": impute_mode, "invalidate_impute": invalidate_impute,
    "log_abs": log_abs_query, "zscore_log": zscore_log, "log1p_columns": log1p_columns,
    "target_encode": target_encode, "text_slice": text_slice_query, "feature_matrix": feature_matrix,
    "clean_table": clean_table, "split_features": split_features,
    "lookup_join": lookup_join, "lookup_skewed": lookup_skewed, "prob_impute": prob_impute, "band_lookup": band_lookup, "rate_grid": rate_grid,
    "html_items": html_items, "html_first_list": html_first_list, "html_by_class": html_by_class,
    "html_nested_class": html_nested_class,
    "html_list_tail": html_list_tail, "html_table_rows": html_table_rows,
    "exact_split": exact_split, "hash_split": hash_split, "stratified_folds": stratified_folds,
    "binary_metrics": binary_metrics, "weighted_metrics": weighted_metrics, "roc_auc": roc_auc,
    "fold_accuracy": fold_accuracy, "metrics_long": metrics_long, "best_model": best_model,
    "metrics_store": metrics_store,
    "train_lr": train_lr, "train_lr_grid": train_lr_grid, "train_rf": train_rf, "train_svm": train_svm,
    "final_test": final_test,
}
