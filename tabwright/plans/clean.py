"""Cleaning and feature steps of a labelled table, for any choice of columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright import operators as op
from tabwright.sources import materialise


@dataclass(frozen=True)
class Roles:
    """What the columns of a table are. Numeric ones are filled with their mean and trimmed in the given
    order, all others are filled with their mode, and the categorical ones are encoded."""

    label: str
    key: str
    numeric: list[str]
    categorical: list[str]


def fit_clean(
    df: DataFrame, roles: Roles, limit: float = 0.1, k: float = 2.0
) -> tuple[PipelineModel, DataFrame]:
    """Learn to fill columns with few gaps, drop those with many, trim outliers and encode categories.

    Returns what was learned, for other rows, and the cleaned table. The filled table is written once:
    each pass of the trimming, and the cleaned table, read only the columns and rows they need of it.
    """
    columns = [c for c in df.columns if c not in (roles.key, roles.label)]
    strategies = {c: "mean" if c in roles.numeric else "mode" for c in columns}
    impute = op.Impute(strategies, fill_under=limit, drop_over=limit).fit(df)
    filled = materialise(impute.transform(df))
    trim = op.SigmaTrim(roles.numeric, k).fit(filled)
    trimmed = trim.transform(filled)
    encode = op.TargetEncode(roles.categorical, roles.label).fit(trimmed)
    return PipelineModel([impute, trim, encode]), encode.transform(trimmed)


def fit_features(train: DataFrame, logged: list[str], scored: list[str], drop_source: bool = True) -> PipelineModel:
    """Learn the z-scores of ``scored``; applying also replaces ``logged`` by their logarithms."""
    scored = [c for c in scored if c in train.columns]
    stages = [op.LogAbs([c for c in logged if c in train.columns])]
    if scored:
        stages.append(op.ZScoreLog(scored, drop_source).fit(train))
    return PipelineModel(stages)


def split_and_transform(
    df: DataFrame, key: list[str], logged: list[str], scored: list[str], drop_source: bool = True,
    refit_test: bool = False, seed: int = 42,
) -> tuple[DataFrame, DataFrame]:
    """(train, test) features. The test rows use what was learned on the train rows, or with
    ``refit_test`` their own mean and deviation."""
    train, test = op.exact_split(df, key, 0.2, seed)
    features = fit_features(train, logged, scored, drop_source)
    tested = fit_features(test, logged, scored, drop_source) if refit_test else features
    return features.transform(train), tested.transform(test)


def reunited(train: DataFrame, test: DataFrame) -> DataFrame:
    """Both parts in one frame with the column ``part``."""
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
