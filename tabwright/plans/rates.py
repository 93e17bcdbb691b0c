"""The reference rate table: scraped rates placed on a grid of sex and age."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.functions import number_in, text_slice
from tabwright.operators.extract import by_class, exploded, list_items, list_tail, table_rows
from tabwright.operators.reference import key_grid, rate_grid

# Age bands (from, to - exclusive, rate index in source 1, rate index in source 2).
# Ages 24, 34, 44, 54, 64, 74 and everything below 18 fall between the bands and get rate 0.
BANDS_AS_CODED = [
    (18, 24, 0, 0), (25, 34, 1, 1), (35, 44, 2, 1), (45, 54, 3, 2), (55, 64, 4, 2), (65, 74, 5, 3),
    (75, None, 6, None),
]
# The same bands without gaps, as the method is described.
BANDS_DOCUMENTED = [
    (18, 25, 0, 0), (25, 35, 1, 1), (35, 45, 2, 1), (45, 55, 3, 2), (55, 65, 4, 2), (65, 75, 5, 3),
    (75, None, 6, 3),
]
SCHOOL_AGES = (14, 15, 16, 17)  # one year each, in the order of the four school rates

# Where the second source's list items hold their band and their rate, by item index
# (start and end of the band, what to append to it, start and end of the rate). Later items use the last row.
AGE_ITEM_SLICES = [(33, 38, "", 46, 49), (35, 40, "", 48, 52), (35, 40, "", 48, 52), (33, 35, "+", 53, 56)]
SEX_ITEM_SLICES = [(28, 31, "", 33, 37), (28, 33, "", 35, 39)]


def bands_frame(spark: SparkSession, bands: list[tuple]) -> DataFrame:
    """(lo, hi, first, second) for a list of bands."""
    return spark.createDataFrame(bands, "lo int, hi int, first int, second int")


def sliced_items(pages: DataFrame, n: int, slices: list[tuple], **options) -> DataFrame:
    """(page_id, idx, key, value): the n-th list's items, cut at the offsets for their position."""
    items = list_items(pages, n, **options)
    key = value = None
    for at, (a, b, suffix, c, d) in reversed(list(enumerate(slices))):
        k, v = text_slice(F.col("item"), a, b, suffix), text_slice(F.col("item"), c, d)
        here = F.col("idx") <= at
        key = k if key is None else F.when(here, k).otherwise(key)
        value = v if value is None else F.when(here, v).otherwise(value)
    return items.select("page_id", "idx", key.alias("key"), value.alias("value"))


def school_rates(pages: DataFrame, **options) -> DataFrame:
    """(page_id, idx, value): the last four estimates in the first data table's 2017 points."""
    texts = by_class(
        pages, "span", "ds-data-point ds-2017", inner="dp-data-estimate", within="ds-data-table-container", **options
    )
    return exploded(list_tail(texts, -4, None, "texts"), "texts").withColumnRenamed("item", "value")


def with_rates(bands: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """(lo, hi, rate1, rate2): bands whose indexes are replaced by the (idx, value) rows of each source."""
    one = first.select(F.col("idx").alias("first"), number_in(F.col("value")).alias("rate1"))
    two = second.select(F.col("idx").alias("second"), number_in(F.col("value")).alias("rate2"))
    return bands.join(one, "first", "left").join(two, "second", "left").select("lo", "hi", "rate1", "rate2")


def school_bands(school: DataFrame) -> DataFrame:
    """One-year bands of the four school rates; both sources alike, so that their mean is the rate."""
    rate = number_in(F.col("value"))
    age = F.col("idx") + F.lit(SCHOOL_AGES[0])
    return school.select(
        age.cast("int").alias("lo"), (age + 1).cast("int").alias("hi"), rate.alias("rate1"), rate.alias("rate2")
    )


def men_ratio(sexes: DataFrame) -> DataFrame:
    """(ratio): the first listed sex's rate over the second's."""
    rate = number_in(F.col("value"))
    first, second = (F.max(F.when(F.col("idx") == i, rate)) for i in (0, 1))
    return sexes.agg((first / second).alias("ratio"))


def smoking_rates(
    bands_page: DataFrame, lists_page: DataFrame, school_page: DataFrame | None = None, documented: bool = False
) -> DataFrame:
    """(sex, age, smoke_rate), 152 rows, from the one-row frames (page_id, html) of the source pages.

    ``documented`` closes the gaps between the bands and gives ages 14 to 17 the school rates; else the
    rates come out as the original program computes them.
    """
    spark = bands_page.sparkSession
    bands = bands_frame(spark, BANDS_DOCUMENTED if documented else BANDS_AS_CODED)
    rated = with_rates(bands, table_rows(bands_page, 0), sliced_items(lists_page, 3, AGE_ITEM_SLICES))
    if documented and school_page is not None:
        rated = rated.unionByName(school_bands(school_rates(school_page)))
    return rate_grid(key_grid(spark), rated, men_ratio(sliced_items(lists_page, 2, SEX_ITEM_SLICES)))
