"""Categories replaced by the mean label of their rows."""

from __future__ import annotations

from collections import Counter

from pyspark.ml import Estimator, Model
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwright.operators.profile import typed_value, value_groups, value_kind
from tabwright.operators.skew import spread_left_join
from tabwright.sources.durable import SMALL_ROWS, pin_small

LITERAL_ROWS = 64  # most categories written into the plan as a literal map


class TargetEncode(Estimator):
    """Add ``<column>_target`` and drop the column, for columns with enough categories.

    A missing value counts as a category but gets no encoding. One partial aggregation gives the means
    of all columns. A column with up to ``literal_rows`` categories is encoded by a literal map, one with
    up to ``small_rows`` by a broadcast join; beyond that its means stay a table and the join is a
    shuffle from which heavy categories are taken out.
    """

    def __init__(
        self, cols: list[str], label: str, min_categories: int = 3,
        literal_rows: int = LITERAL_ROWS, small_rows: int = SMALL_ROWS,
    ):
        super().__init__()
        self.cols = list(cols)
        self.label = label
        self.min_categories = min_categories
        self.literal_rows = literal_rows
        self.small_rows = small_rows

    def _fit(self, df: DataFrame) -> TargetEncodeModel:
        cols = [c for c in self.cols if c in df.columns]
        if not cols:
            return TargetEncodeModel({}, {})
        groups, rows = pin_small(value_groups(df, cols, self.label), self.small_rows)
        if rows is None:
            counted = groups.groupBy("col_name").agg(F.count(F.lit(1)).alias("n")).collect()
            sizes = {r["col_name"]: r["n"] for r in counted}
        else:
            sizes = Counter(r["col_name"] for r in rows)
        encoded = [c for c in cols if sizes.get(c, 0) >= self.min_categories]
        tiny = [c for c in encoded if sizes[c] <= self.literal_rows]
        if rows is None and tiny:  # at most literal_rows rows per column
            rows = [r.asDict() for r in groups.filter(F.col("col_name").isin(tiny)).collect()]

        literal: dict[str, dict] = {}
        joined: dict[str, tuple[DataFrame, bool]] = {}
        for c in encoded:
            kind = value_kind(df.schema[c].dataType)
            if c in tiny:
                mine = [r for r in rows if r["col_name"] == c and r[kind] is not None]
                literal[c] = {r[kind]: r["label_mean"] for r in mine if r["label_mean"] is not None}
            else:
                table = groups.filter((F.col("col_name") == c) & F.col(kind).isNotNull())
                joined[c] = (table.select(F.col(kind).alias("value"), "label_mean"), sizes[c] <= self.small_rows)
        return TargetEncodeModel(literal, joined)


class TargetEncodeModel(Model):
    """``literal``: column -> value -> mean. ``joined``: column -> (value, label_mean) and whether to
    broadcast it."""

    def __init__(self, literal: dict[str, dict], joined: dict[str, tuple[DataFrame, bool]]):
        super().__init__()
        self.literal = literal
        self.joined = joined

    def _transform(self, df: DataFrame) -> DataFrame:
        encoded = [c for c in df.columns if c in self.literal or c in self.joined]
        kept = [c for c in df.columns if c not in encoded]
        means = {}
        for c in encoded:
            value = typed_value(df, c)
            if c in self.literal:
                pairs = [F.lit(x) for pair in self.literal[c].items() for x in pair]
                means[c] = F.try_element_at(F.create_map(*pairs), value) if pairs else F.lit(None).cast("double")
            else:
                table, small = self.joined[c]
                side = table.select(F.col("value").alias(f"{c}__value"), F.col("label_mean").alias(f"{c}__mean"))
                if small:
                    df = df.join(F.broadcast(side), value == F.col(f"{c}__value"), "left")
                else:
                    df = spread_left_join(df, side, {f"{c}__value": value})
                means[c] = F.col(f"{c}__mean")
        return df.select(*kept, *[means[c].alias(f"{c}_target") for c in encoded])
