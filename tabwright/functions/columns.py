"""Scalar expressions for cleaning, transforming and parsing.

Inside the library a missing value is always NULL: blanks and NaN are turned into NULL where data
enters, because NaN compares as larger than every number in Spark and poisons averages.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def nan_to_null(c: Column) -> Column:
    return F.nanvl(c, F.lit(None).cast("double"))


def blank_to_null(c: Column) -> Column:
    return F.when(F.trim(c) != "", c)


def to_double(c: Column) -> Column:
    """Any text or number as a double; blanks, words and NaN become NULL."""
    return nan_to_null(c.try_cast("double"))


def present(name: str, dtype: T.DataType) -> Column:
    """The column with NaN or blanks, where its type allows them, as NULL."""
    c = F.col(f"`{name}`")
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.nanvl(c, F.lit(None).cast(dtype))
    return blank_to_null(c) if isinstance(dtype, T.StringType) else c


def outside(c: Column, below: float | None = None, above: float | None = None) -> Column:
    """True where the value is lower than ``below`` or higher than ``above`` (both exclusive)."""
    tests = []
    if below is not None:
        tests.append(c < F.lit(float(below)))
    if above is not None:
        tests.append(c > F.lit(float(above)))
    if not tests:
        raise ValueError("give a lower or an upper bound")
    return tests[0] if len(tests) == 1 else tests[0] | tests[1]


def log_abs(c: Column) -> Column:
    return F.log1p(F.abs(c))


def clamp(c: Column, hi: float) -> Column:
    """Whole-number key, never above ``hi``; NULL stays NULL."""
    return F.when(c.isNotNull(), F.least(F.floor(c), F.lit(int(hi)))).cast("int")


def average_rates(first: Column, second: Column) -> Column:
    """Mean of two sources, an absent source counting as 0."""
    return (F.coalesce(first, F.lit(0.0)) + F.coalesce(second, F.lit(0.0))) / F.lit(2.0)


def scale_by_ratio(value: Column, flag: Column, ratio: Column) -> Column:
    """The value as it is for flag 0 and times ``ratio`` for every other flag."""
    return F.when(flag == 0, value).otherwise(value * ratio)


def text_slice(c: Column, start: int, stop: int, suffix: str = "") -> Column:
    """Characters ``start`` to ``stop`` (0-based, end exclusive), plus an optional suffix."""
    cut = F.substring(c, start + 1, stop - start)
    return F.concat(cut, F.lit(suffix)) if suffix else cut


def number_in(c: Column) -> Column:
    """The first decimal number in a text, or NULL."""
    return F.regexp_extract(c, r"([0-9]+\.?[0-9]*|\.[0-9]+)", 1).try_cast("double")


def list_slice(items: Column, lo: int | None = None, hi: int | None = None) -> Column:
    """Part of an array by 0-based bounds, negatives counting from the end, short arrays allowed."""
    n = F.size(items)

    def bound(at: int | None, default: Column) -> Column:
        if at is None:
            return default
        return F.least(F.lit(at), n) if at >= 0 else F.greatest(n + F.lit(at), F.lit(0))

    start, stop = bound(lo, F.lit(0)), bound(hi, n)
    return F.when(items.isNotNull(), F.slice(items, start + 1, F.greatest(stop - start, F.lit(0))))
