"""Every registered query against its SQL, on the generated tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from oracle import connect, difference

QUERIES, ORACLES = entry_point.queries(), entry_point.oracle_sql()


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, small, duck, name):
    assert difference(QUERIES[name](spark, small), duck, ORACLES[name]) is None


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).limit(1).count() == 1


def test_only_training_goes_without_sql():
    without = {n for n in set(QUERIES) - set(ORACLES) if not n.startswith("op") and n != "pipeline"}
    assert all(n.startswith("train_") or n == "final_test" for n in without)


@pytest.mark.parametrize("name", ["exact_split", "stratified_folds", "prob_impute", "hash_split"])
def test_layout_does_not_matter(spark, small, name, monkeypatch):
    from tabwright.plans import queries as module
    expected = sorted(map(tuple, QUERIES[name](spark, small).collect()), key=str)
    plain = module.read_parquet_table
    monkeypatch.setattr(module, "read_parquet_table", lambda *a: plain(*a).repartition(16))
    assert sorted(map(tuple, QUERIES[name](spark, small).collect()), key=str) == expected
