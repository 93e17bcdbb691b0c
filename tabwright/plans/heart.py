"""The patient table from raw text to a tested model: three branches over shared operators.

Every function takes and returns DataFrames and can be used alone; ``run`` writes each result to its
named table and reads it back for the next step, so lineage stays short and a lost executor re-reads
a table.
"""

from __future__ import annotations

from dataclasses import replace
from itertools import groupby

from pyspark.ml import Model, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright import operators as op
from tabwright.functions import clamp, to_double
from tabwright.operators.train import RECIPES, Recipe
from tabwright.plans import clean
from tabwright.plans.rates import smoking_rates
from tabwright.sources import (
    Tables, materialise, read_best, read_metrics, run_step, write_best, write_metrics,
)
from tabwright.sources.schema import RAW_HEADER

LABEL = "target"
KEY = "patient_key"

# The roles of the patient columns.
NUMERIC = "age trestbps chol thaldur thalach thalrest tpeakbps tpeakbpd dummy trestbpd oldpeak".split()
CATEGORICAL = "sex cp htn restecg ekgmo ekgday ekgyr dig prop nitr pro diuretic exang xhypo cmo cday cyr".split()
ROLES = clean.Roles(LABEL, KEY, NUMERIC, CATEGORICAL)

# The columns of the second branch, what is impossible in them, and how each is filled.
SELECTED = (
    "age sex painloc painexer cp trestbps smoke fbs prop nitr pro diuretic thaldur thalach exang oldpeak slope target"
).split()
IMPOSSIBLE = {
    "trestbps": (100, None), "oldpeak": (0, 4), "fbs": (None, 1), "prop": (None, 1), "nitr": (None, 1),
    "pro": (None, 1), "diuretic": (None, 1),
}
FILLED = {
    "painloc": "mode", "painexer": "mode", "trestbps": "mean", "oldpeak": "mean", "thaldur": "mean",
    "thalach": "mean", "fbs": "mode", "prop": "mode", "nitr": "mode", "pro": "mode", "diuretic": "mode",
    "exang": "mode", "slope": "mode",
}
LOGGED = ["imp_trestbps", "imp_thaldur", "imp_thalach"]

# Table names.
RAW, RATES = "heart", "smoke_data_rates"
CLEAN, TRAIN, TEST = "heart_clean_sklearn", "heart_fe_sklearn", "heart_test_sklearn"
MERGED, MERGED_TEST = "heart_merged_data", "test_merged_data"
SPARK_CLEAN, SPARK_TRAIN, SPARK_TEST = "heart_clean_spark", "heart_fe_spark", "heart_test_spark"

COPIES_PER_TASK = 100_000


def with_row_key(df: DataFrame, out: str = KEY) -> DataFrame:
    """Add a key made of a row's content and, for identical rows, the number of the copy.

    The same rows get the same keys in any file layout. Rows are grouped by content, so that many
    copies of one row shrink to a count before they travel, and are written out again in runs of
    ``COPIES_PER_TASK`` spread over the tasks. Costs a shuffle of the table: name a key column that the
    source has instead wherever there is one.
    """
    counted = materialise(df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("__n")))
    runs = counted.withColumn("__run", F.explode(F.expr(f"sequence(0L, (__n - 1) div {COPIES_PER_TASK})")))
    if counted.filter(F.col("__n") > COPIES_PER_TASK).take(1):
        runs = runs.repartition("__run", *[F.col(f"`{c}`") for c in df.columns])
    first = F.col("__run") * COPIES_PER_TASK
    last = F.least(first + COPIES_PER_TASK, F.col("__n")) - 1
    copies = runs.withColumn("__copy", F.explode(F.sequence(first, last)))
    content = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0000")) for c in df.columns]
    key = F.concat_ws(":", F.md5(F.concat_ws("\u0001", *content)), F.col("__copy").cast("string"))
    return copies.select(*[F.col(f"`{c}`") for c in df.columns], key.alias(out))


def ingest(raw: DataFrame, key: str | None = None) -> DataFrame:
    """Patients with a label, under their proper column names and with a row key; still text."""
    df = op.rename(raw, {v: k for k, v in RAW_HEADER.items()})
    df = df.filter(to_double(F.col(LABEL)).isNotNull())
    if key is None:
        return with_row_key(df)
    return df.withColumn(KEY, F.col(key).cast("string")).drop(*([key] if key != KEY else []))


def numbers(patients: DataFrame) -> DataFrame:
    return op.cast_numeric(patients, [c for c in patients.columns if c != KEY])


def fit_clean(patients: DataFrame) -> tuple[PipelineModel, DataFrame]:
    """(what was learned, first branch's clean table)."""
    return clean.fit_clean(numbers(patients), ROLES)


def clean_tabular(patients: DataFrame, model: PipelineModel | None = None) -> DataFrame:
    """First branch's clean table; a ``model`` learned on other rows avoids looking at these labels."""
    return fit_clean(patients)[1] if model is None else model.transform(numbers(patients))


def split_and_transform(
    table: DataFrame, drop_source: bool = True, refit_test: bool = False, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, test) features of the first and third branch; see ``clean.split_and_transform``."""
    return clean.split_and_transform(table, [KEY], ["oldpeak"], ["chol"], drop_source, refit_test, seed)


def clean_selected(patients: DataFrame) -> DataFrame:
    """Second branch's clean table: 18 columns with impossible values removed, and 13 filled copies."""
    positions = [patients.columns.index(c) for c in SELECTED]
    df = op.select_at(patients, [*positions, patients.columns.index(KEY)], [*SELECTED, KEY])
    df = op.invalidate(op.require(numbers(df), "sex"), IMPOSSIBLE)
    return op.Impute(FILLED, prefix="imp_").fit(df).transform(df)


def split_selected(table: DataFrame, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """(train, test) of the second branch, both with the logged columns."""
    train, test = op.hash_split(table, [KEY], 0.8, seed)
    return op.log1p_columns(train, LOGGED), op.log1p_columns(test, LOGGED)


def merge_smoking(table: DataFrame, rates: DataFrame, seed: int = 7) -> DataFrame:
    """The clean table with a ``smoke`` column drawn from the rate for a patient's sex and age; above 75 counts as 75."""
    on = {"sex": F.col("sex").cast("int"), "age": clamp(F.col("age"), 75)}
    return op.prob_impute(table.drop("smoke"), rates, on, [KEY], seed)


def trainable(recipe: Recipe, df: DataFrame) -> tuple[Model, list[str]]:
    """What fills a recipe's gaps, learned on the frame, and the columns that the recipe must not learn from.

    Every row is trained on and scored: what the clean tables left missing is filled by the mean of a
    numeric column or of an encoded one, and by the mode of others. In the second branch the unfilled originals of the filled
    columns are not used, and nowhere a column without any value.
    """
    drop = [*FILLED] if recipe.branch == "spark" else []
    inputs = [c for c in df.columns if c not in (LABEL, KEY, *drop)]
    empty = [r["col_name"] for r in op.missing_profile(df, inputs).collect() if r["n_missing"] == r["n_rows"]]
    modes = {*CATEGORICAL, *(c for c, how in FILLED.items() if how == "mode"), "smoke"}
    return op.Impute({c: "mode" if c in modes else "mean" for c in inputs if c not in empty}).fit(df), [*drop, *empty]


def evaluate(recipe: Recipe, df: DataFrame) -> DataFrame:
    fills, drop = trainable(recipe, df)
    return op.train_and_evaluate(fills.transform(df), recipe, LABEL, [KEY], drop=drop)[1]


def evaluate_branch(recipes: list[Recipe], df: DataFrame) -> list[DataFrame]:
    """Metrics of several recipes of one branch, which share one stored copy of its rows as far as they split them alike."""
    fills, drop = trainable(recipes[0], df)
    filled, out = fills.transform(df), []
    for _, alike in groupby(recipes, key=lambda r: (r.score, r.folds, r.seed)):
        alike = list(alike)
        rows = op.prepare(filled, alike[0], LABEL, [KEY], drop=drop)
        out += [op.evaluate_prepared(rows, recipe)[1] for recipe in alike]
        rows.drop()
    return out


def test_chosen(recipe: Recipe, train: DataFrame, test: DataFrame) -> DataFrame:
    fills, drop = trainable(recipe, train)
    return op.final_test(fills.transform(train), fills.transform(test), recipe, LABEL, [KEY], drop=drop)


TRAIN_TABLES = {"sklearn": (TRAIN, TEST), "scrape": (MERGED, MERGED_TEST), "spark": (SPARK_TRAIN, SPARK_TEST)}


def run(
    tables: Tables, raw: DataFrame, pages: tuple[DataFrame, DataFrame, DataFrame | None], metrics_path: str,
    best_path: str, key: str | None = None, models: list[str] | None = None,
    settings: dict[str, dict] | None = None, documented: bool = True,
) -> DataFrame:
    """All steps from the raw table to the chosen model's scores on the held-out rows.

    ``pages`` are the three source pages of the rates. ``settings`` replaces fields of a recipe by model
    name, such as a smaller grid.
    """
    names = models or list(RECIPES)
    recipes = {n: replace(RECIPES[n], **(settings or {}).get(n, {})) for n in names}

    tables.write({RAW: ingest(raw, key), RATES: smoking_rates(*pages, documented=documented)})
    run_step(tables, RAW, lambda df: {CLEAN: clean_tabular(df), SPARK_CLEAN: clean_selected(df)})

    def first_branch(table: DataFrame) -> dict[str, DataFrame]:
        train, test = split_and_transform(table)
        return {TRAIN: train, TEST: test}

    def third_branch(table: DataFrame, rates: DataFrame) -> dict[str, DataFrame]:
        train, test = split_and_transform(materialise(merge_smoking(table, rates)))
        return {MERGED: train, MERGED_TEST: test}

    def second_branch(table: DataFrame) -> dict[str, DataFrame]:
        train, test = split_selected(table)
        return {SPARK_TRAIN: train, SPARK_TEST: test}

    run_step(tables, CLEAN, first_branch)
    run_step(tables, [CLEAN, RATES], third_branch)
    run_step(tables, SPARK_CLEAN, second_branch)

    for branch in dict.fromkeys(r.branch for r in recipes.values()):
        own = [r for r in recipes.values() if r.branch == branch]
        for metrics in evaluate_branch(own, tables.read(TRAIN_TABLES[branch][0])):
            write_metrics(metrics, metrics_path)

    spark = tables.spark
    write_best(op.best_model(read_metrics(spark, metrics_path, names), names), best_path)
    chosen = recipes[read_best(spark, best_path)]
    train, test = (tables.read(t) for t in TRAIN_TABLES[chosen.branch])
    return test_chosen(chosen, train, test)
