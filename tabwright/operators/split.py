"""Reproducible splits and folds.

Every split is a test on a hash of the row's key, so applying one never shuffles rows. The exact
ones first find the hashes at the wanted ranks, which takes a few aggregations over (group, hash
prefix) that read nothing but the key and group columns.
"""

from __future__ import annotations

from collections.abc import Callable
from math import ceil

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwright.functions import hash01, keyed_md5

STEP = 3  # hex digits resolved per aggregation: at most 4,096 prefixes per group or open cut
HASH_DIGITS = 32
MOST_GROUPS = 100  # labels that are cut by literals, and open cuts that are counted at a time
RANKED_ROWS = 100_000


class DuplicateKeys(ValueError):
    """An exact cut is impossible because several rows share the key it falls on."""


def _prefix_counts(df: DataFrame, digits: int) -> pd.DataFrame:
    """Rows and last hash per (group, hash prefix), in order; callers bound the groups and prefixes."""
    return df.groupBy("group", F.substring("hash", 1, digits).alias("prefix")).agg(
        F.count(F.lit(1)).alias("n"), F.max("hash").alias("last"),
    ).toArrow().to_pandas().sort_values("prefix")


def _cut_hashes(df: DataFrame, ranks: Callable[[int], list[int]]) -> dict[object, dict[int, str]]:
    """The hash at each wanted 1-based rank, per group of a frame (group, hash).

    ``ranks`` names the wanted ranks of a group of n rows. This is a radix selection: rows are counted
    by hash prefix, each rank moves into the prefix that holds it, and only rows under such a prefix
    are counted by their next digits. A prefix with exactly as many rows as are still wanted ends at
    the hash sought; with unique keys every rank gets there.
    """
    counted = _prefix_counts(df, STEP)
    groups = {None if pd.isna(g) else g: part for g, part in counted.groupby("group", dropna=False)}
    cuts: dict[object, dict[int, str]] = {g: {} for g in groups}
    todo = {(g, r): ("", r) for g, part in groups.items() for r in ranks(int(part["n"].sum()))}
    for digits in range(STEP, HASH_DIGITS + STEP, STEP):
        for (g, r), (prefix, left) in list(todo.items()):
            inside = groups[g][groups[g]["prefix"].str.startswith(prefix)]
            upto = inside["n"].cumsum()
            at = int((upto >= left).argmax())
            left -= int(upto.iloc[at] - inside["n"].iloc[at])
            if left == inside["n"].iloc[at]:
                cuts[g][r] = inside["last"].iloc[at]
                del todo[(g, r)]
            else:
                todo[(g, r)] = (inside["prefix"].iloc[at], left)
        if not todo:
            return cuts
        open_ = {g: sorted({p for (h, _), (p, _) in todo.items() if h == g}) for g in {g for g, _ in todo}}
        pairs = [(g, p) for g, prefixes in open_.items() for p in prefixes]
        batches = []
        for at in range(0, len(pairs), MOST_GROUPS):  # so that a count has at most MOST_GROUPS * 4,096 rows
            keep = F.lit(False)
            for g, p in pairs[at: at + MOST_GROUPS]:
                keep = keep | (F.col("group").eqNullSafe(F.lit(g)) & (F.substring("hash", 1, digits) == p))
            batches.append(_prefix_counts(df.filter(keep), digits + STEP))
        counted = pd.concat(batches).sort_values("prefix")
        groups = {None if pd.isna(g) else g: part for g, part in counted.groupby("group", dropna=False)}
    raise DuplicateKeys("the key must be unique for an exact split")


def exact_test_flag(df: DataFrame, key: list[str], test: float = 0.2, seed: int = 42) -> Column:
    """A boolean expression that is true for exactly ``ceil(test * n)`` rows of this frame.

    They are the rows with the smallest keyed hashes. Keys must be unique.
    """
    hashed = df.select(F.lit(0).alias("group"), keyed_md5(seed, *key).alias("hash"))
    cuts = _cut_hashes(hashed, lambda n: [ceil(round(n * test, 9))] if test > 0 else [])
    found = [h for by_rank in cuts.values() for h in by_rank.values()]
    return keyed_md5(seed, *key) <= F.lit(found[0]) if found else F.lit(False)


def exact_split(
    df: DataFrame, key: list[str], test: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, test) with exactly ``ceil(test * n)`` test rows; see ``exact_test_flag``."""
    flag = exact_test_flag(df, key, test, seed)
    return df.filter(~flag), df.filter(flag)


def hash_split(
    df: DataFrame, key: list[str], train: float = 0.8, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by one draw per key: about ``train`` of the rows, without looking at the data."""
    draw = hash01(seed, *key)
    return df.filter(draw < train), df.filter(draw >= train)


def hash_folds(df: DataFrame, key: list[str], k: int = 5, seed: int = 42, out: str = "fold") -> DataFrame:
    """Folds of about equal size from one draw per key; no pass over the data."""
    return df.withColumn(out, F.floor(hash01(seed, *key) * F.lit(k)).cast("int"))


def stratified_folds(
    df: DataFrame, label: str, key: list[str], k: int = 5, seed: int = 42, out: str = "fold"
) -> DataFrame:
    """Folds 0 to k-1 that hold each label in equal numbers, give or take one row.

    Within a label the rows are ordered by keyed hash and cut into k runs, the first ``n mod k`` of
    them one longer. Keys must be unique. Up to ``MOST_GROUPS`` labels are cut by comparing hashes with the
    cuts' own, without a shuffle; more labels are ranked by ``_ranked_folds``, with the same result.
    """
    if df.select(label).distinct().limit(MOST_GROUPS + 1).count() > MOST_GROUPS:
        return _ranked_folds(df, label, key, k, seed, out)

    def ends(n: int) -> list[int]:
        size, extra = divmod(n, k)
        return sorted({size * i + min(i, extra) for i in range(1, k)} - {0})

    hashed = df.select(F.col(label).alias("group"), keyed_md5(seed, *key).alias("hash"))
    digest = F.col("__digest")  # a column of its own: hashed once per row, compared with many cuts
    fold = F.lit(None).cast("int")
    for group, cuts in _cut_hashes(hashed, ends).items():
        above = F.lit(0)
        for h in cuts.values():
            above = above + F.when(digest > F.lit(h), 1).otherwise(0)
        fold = F.when(F.col(label).eqNullSafe(F.lit(group)), above).otherwise(fold)
    return df.withColumn("__digest", keyed_md5(seed, *key)).withColumn(out, fold.cast("int")).drop("__digest")


def _ranked_folds(df: DataFrame, label: str, key: list[str], k: int, seed: int, out: str) -> DataFrame:
    """``stratified_folds`` for any number of labels.

    Rows are ranked inside (label, hash prefix), the prefix long enough for about ``RANKED_ROWS`` rows of
    the whole table, and the counts of the prefixes before are added; no window holds a whole label.
    """
    digits, total = 1, df.count()
    while total > RANKED_ROWS * 16 ** digits:
        digits += 1
    rows = df.withColumn("__digest", keyed_md5(seed, *key)).withColumn("__prefix", F.substring("__digest", 1, digits))
    counts = rows.groupBy(F.col(label).alias("__label"), F.col("__prefix").alias("__p")).agg(F.count(F.lit(1)).alias("__n"))
    upto = Window.partitionBy("__label").orderBy("__p")
    counts = counts.withColumns({
        "__before": F.coalesce(F.sum("__n").over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "__total": F.sum("__n").over(Window.partitionBy("__label")),
    })
    same = F.col(label).eqNullSafe(F.col("__label")) & (F.col("__prefix") == F.col("__p"))
    inside = Window.partitionBy("__label", "__p").orderBy("__digest")
    rank = F.row_number().over(inside) - 1 + F.col("__before")
    size, extra = F.floor(F.col("__total") / k), F.col("__total") % k
    long_ = extra * (size + 1)  # rows in the runs that are one longer
    fold = F.when(rank < long_, F.floor(rank / (size + 1))).otherwise(extra + F.floor((rank - long_) / F.greatest(size, F.lit(1))))
    return rows.join(counts, same).withColumn(out, fold.cast("int")).drop(
        "__label", "__prefix", "__digest", "__p", "__n", "__before", "__total")
