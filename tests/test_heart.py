"""The patient plan against plain pandas on the same rows, and end to end."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from patients import BANDS_PAGE, LISTS_PAGE, SCHOOL_PAGE, page, patients
from tabwright import operators as op
from tabwright.plans import heart, rates
from tabwright.sources import Tables, export_csv, read_csv, read_metrics
from tabwright.sources.schema import PATIENT_SCHEMA


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("csv") / "patients")
    export_csv(patients(spark), path)
    return read_csv(spark, path, PATIENT_SCHEMA)


@pytest.fixture(scope="module")
def ingested(raw, spark):
    from tabwright.sources import materialise
    return materialise(heart.ingest(raw))


@pytest.fixture(scope="module")
def frame(ingested):
    pdf = ingested.toPandas().set_index(heart.KEY)
    return pdf.apply(pd.to_numeric, errors="coerce").astype(float)


def test_ingest_drops_junk_and_keys_are_unique(ingested):
    assert ingested.count() == 1000
    assert ingested.select(heart.KEY).distinct().count() == 1000
    assert "ekgday" in ingested.columns


def test_row_keys_of_copies(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", None), ("a", 1)], "x string, y int")
    keyed = heart.with_row_key(df)
    again = heart.with_row_key(df.repartition(3))
    keys = sorted(r[heart.KEY] for r in keyed.collect())
    assert len(set(keys)) == 4 and keys == sorted(r[heart.KEY] for r in again.collect())
    assert sorted(keyed.drop(heart.KEY).collect(), key=str) == sorted(df.collect(), key=str)


def test_row_keys_in_runs(spark, monkeypatch):
    monkeypatch.setattr(heart, "COPIES_PER_TASK", 7)
    df = spark.range(50).selectExpr("case when id < 40 then 1 else id end as x")
    keyed = heart.with_row_key(df)
    assert keyed.select(heart.KEY).distinct().count() == 50
    assert keyed.filter("x = 1").count() == 40


def pandas_clean(frame: pd.DataFrame) -> pd.DataFrame:
    out = frame.copy()
    share = out.isna().mean()
    for c in frame.columns.drop("target"):
        if share[c] > 0.1:
            del out[c]
        elif 0 < share[c] < 0.1:
            fill = frame[c].mean() if c in heart.NUMERIC else frame[c].mode().iloc[0]
            out[c] = out[c].fillna(fill)
    for c in (c for c in heart.NUMERIC if c in out):
        mean, sd = out[c].mean(), out[c].std()
        out = out[(out[c] - mean).abs() <= 2 * sd]
    for c in (c for c in heart.CATEGORICAL if c in out):
        if out[c].nunique(dropna=False) > 2:
            out[c + "_target"] = out[c].map(out.groupby(c)["target"].mean())
            del out[c]
    return out


def test_clean_tabular_equals_pandas(ingested, frame):
    ours = heart.clean_tabular(ingested).toPandas().set_index(heart.KEY).sort_index()
    theirs = pandas_clean(frame).sort_index()
    assert set(ours.columns) == set(theirs.columns)
    assert "ca" not in ours and "cp_target" in ours and "xhypo_target" in ours
    assert 0 < len(ours) < 1000
    pd.testing.assert_frame_equal(ours[theirs.columns], theirs, check_names=False, rtol=1e-9)


def test_clean_can_learn_on_train_rows_only(ingested):
    train, test = op.hash_split(ingested, [heart.KEY])
    model, table = heart.fit_clean(train)
    cleaned = heart.clean_tabular(test, model)
    assert 0 < cleaned.count() < test.count()
    again = heart.clean_tabular(train, model)
    assert cleaned.columns == table.columns == again.columns
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, table.collect()))


def test_features(ingested):
    clean = heart.clean_tabular(ingested)
    train, test = heart.split_and_transform(clean)
    assert {"log_oldpeak", "chol_z_log"} <= set(train.columns)
    assert not {"oldpeak", "chol", "chol_z"} & set(train.columns)
    n = clean.count()
    assert test.count() == int(np.ceil(0.2 * n)) and train.count() == n - test.count()
    kept, _ = heart.split_and_transform(clean, drop_source=False)
    z = kept.select("chol_z").toPandas()["chol_z"]
    assert abs(z.mean()) < 1e-9 and abs(z.std() - 1) < 1e-9
    _, own = heart.split_and_transform(clean, drop_source=False, refit_test=True)
    assert abs(own.select("chol_z").toPandas()["chol_z"].mean()) < 1e-9


def test_clean_selected_equals_pandas(ingested, frame):
    ours = heart.clean_selected(ingested).toPandas().set_index(heart.KEY).sort_index()
    assert len(ours.columns) == 31
    df = frame[heart.SELECTED].dropna(subset=["sex"]).sort_index()
    df.loc[df.trestbps < 100, "trestbps"] = np.nan
    df.loc[(df.oldpeak < 0) | (df.oldpeak > 4), "oldpeak"] = np.nan
    for c in ["fbs", "prop", "nitr", "pro", "diuretic"]:
        df.loc[df[c] > 1, c] = np.nan
    for c, how in heart.FILLED.items():
        df["imp_" + c] = df[c].fillna(df[c].mean() if how == "mean" else df[c].mode()[0])
    pd.testing.assert_frame_equal(ours, df, check_names=False, rtol=1e-9)
    train, test = heart.split_selected(heart.clean_selected(ingested))
    assert train.count() + test.count() == len(df)
    assert train.agg({"imp_trestbps": "max"}).first()[0] < 10


def smoking(spark, documented):
    return rates.smoking_rates(page(spark, BANDS_PAGE), page(spark, LISTS_PAGE), page(spark, SCHOOL_PAGE), documented)


def test_rates_as_coded(spark):
    got = {(r["sex"], r["age"]): r["smoke_rate"] for r in smoking(spark, False).collect()}
    assert len(got) == 152
    assert all(got[s, a] == 0 for s in (0, 1) for a in [*range(18), 24, 34, 44, 54, 64, 74])
    assert got[0, 18] == pytest.approx((7.1 + 5.3) / 2) and got[0, 40] == pytest.approx((11.6 + 12.6) / 2)
    assert got[0, 71] == pytest.approx((8.7 + 8.3) / 2) and got[0, 75] == pytest.approx(2.9 / 2)
    assert got[1, 71] == pytest.approx(got[0, 71] * 13.1 / 10.1)


def test_rates_as_documented(spark):
    got = {(r["sex"], r["age"]): r["smoke_rate"] for r in smoking(spark, True).collect()}
    assert len(got) == 152
    assert [got[0, a] for a in (13, 14, 15, 16, 17)] == pytest.approx([0, 5.4, 7.5, 9.8, 13.4])
    assert got[0, 74] == got[0, 71] and got[0, 75] == pytest.approx((2.9 + 8.3) / 2)


def test_merge_smoking(spark, ingested):
    clean = heart.clean_tabular(ingested)
    merged = heart.merge_smoking(clean, smoking(spark, True)).toPandas()
    assert len(merged) == clean.count() and set(merged["smoke"].dropna()) <= {0, 1}
    assert merged["smoke"].notna().all() and 0.02 < merged["smoke"].mean() < 0.25


def test_run_end_to_end(spark, raw, tmp_path):
    tables = Tables(spark, "hearttest")
    small = {"rf_spark": {"grid": {"numTrees": [5], "maxDepth": [3]}, "folds": 2},
             "lr_spark": {"grid": {"regParam": [0.01, 0.1]}, "folds": 2},
             "Logistic_sklearn": {"folds": 2}, "Logistic_scrape": {"folds": 2},
             "SVM_scrape": {"folds": 2, "params": {"landmarks": 8}}}
    pages = tuple(page(spark, h) for h in (BANDS_PAGE, LISTS_PAGE, SCHOOL_PAGE))
    metrics, best = str(tmp_path / "metrics"), str(tmp_path / "best")
    result = heart.run(tables, raw, pages, metrics, best, models=list(small), settings=small)
    scores = {r["metric"]: r["value"] for r in result.collect()}
    assert set(scores) == {"precision", "recall", "f1_score"} and 0.4 < scores["f1_score"] <= 1
    stored = read_metrics(spark, metrics)
    assert stored.select("model").distinct().count() == len(small)
    spark.sql("DROP DATABASE hearttest CASCADE")


def test_every_row_is_trained_on_and_scored(spark, monkeypatch):
    rows = [(f"k{n}", float(n % 2), float(n % 2) if n % 10 else None, None if n % 3 else 1.0, None) for n in range(60)]
    df = spark.createDataFrame(rows, "patient_key string, target double, age double, smoke double, sex double")
    seen = {}

    def kept(name):
        def stage(*args, handle_invalid="error", drop=None):
            frames = [a for a in args if hasattr(a, "columns")]
            skip = [heart.LABEL, heart.KEY, *drop]
            seen[name] = [op.feature_matrix(f.drop(*[c for c in drop if c in f.columns]), heart.LABEL, [heart.KEY], handle_invalid).count()
                          for f in frames], [c for c in frames[0].columns if c not in skip]
            return None, None
        return stage

    monkeypatch.setattr(heart.op, "train_and_evaluate", kept("evaluate"))
    monkeypatch.setattr(heart.op, "final_test", kept("final"))
    for name in ("lr_spark", "Logistic_sklearn"):
        heart.evaluate(op.RECIPES[name], df)
        heart.test_chosen(op.RECIPES[name], df, df.limit(31))
        # smoke has values, so it is used however few they are; sex has none
        assert seen == {"evaluate": ([60], ["age", "smoke"]), "final": ([60, 31], ["age", "smoke"])}
