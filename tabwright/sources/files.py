"""Reading and writing tables as files or over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabwright.sources.records import header_names, read_records


# what is between two separators is NULL, "" is an empty text; quotes are doubled, blanks and backslashes are text
WRITE_CSV = {
    "escape": '"', "nullValue": "", "emptyValue": '""', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}
READ_CSV = {"escape": '"', "nullValue": "\0", "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "bad"}


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", header: bool = True, corrupt: str | None = None,
) -> DataFrame:
    """CSV typed by ``schema``, its columns found by their names in each file's header.

    Files may order their columns differently and have more of them; one that lacks a column is a ValueError. Without
    ``header`` columns are bound by place. Quoted fields may hold line feeds, and large files are still read
    in splits. A record with too few or too many fields, one with a quote that is never closed, and one with a field that is no value of its type is
    bad: what can be read of it is kept, the rest is NULL, and the column ``corrupt``, if asked for, holds its text.
    """
    records, headers = read_records(spark, path, sep, header)
    orders = [header_names(h, sep) for h in headers] or [schema.names]
    for names in orders:
        missing = [c for c in schema.names if c not in names]
        repeated = [c for c in schema.names if names.count(c) > 1]
        if missing or repeated:
            raise ValueError(f"the header {names} lacks {missing} and repeats {repeated}")
    types = {f.name: f.dataType.simpleString() for f in schema}
    fields = []
    for names in orders:
        ddl = ", ".join([*(f"c{i} {types.get(c, 'string')}" for i, c in enumerate(names)), "bad string"])
        row = F.from_csv("record", ddl, READ_CSV | {"sep": sep})
        # a record that fits but holds nothing is reported as bad by the parser
        empty = F.trim("record", F.lit(sep)) == ""
        whole = F.length("record") == (len(names) - 1) * len(sep)
        bad = F.when(~F.col("closed"), F.col("record")).when(~(empty & whole), row["bad"])
        fields.append(F.struct(*[row[f"c{names.index(c)}"].alias(c) for c in schema.names], bad.alias("bad record")))
    parsed = fields[0]
    for i, row in enumerate(fields[1:], 1):
        parsed = F.when(F.col("header") == i, row).otherwise(parsed)
    rows = records.select(parsed.alias("row"))
    columns = [F.col("row")[c].alias(c) for c in schema.names]
    return rows.select(*columns, *([F.col("row")["bad record"].alias(corrupt)] if corrupt else []))


def read_parquet_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def read_jdbc(
    spark: SparkSession, url: str, table: str, key: str, low: int, high: int, partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A database table read by ``partitions`` tasks, each taking one range of a numeric key."""
    return spark.read.jdbc(
        url=url, table=table, column=key, lowerBound=low, upperBound=high,
        numPartitions=partitions, properties=properties or {},
    )


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict[str, str] | None = None) -> None:
    """Replace a database table, one connection per partition."""
    df.write.jdbc(url=url, table=table, mode="overwrite", properties=properties or {})


def export_csv(df: DataFrame, path: str) -> None:
    """One CSV file per partition with a header; an earlier export is replaced. ``read_csv`` gives the same rows back.

    A NULL in a frame of one column would be a blank line, which is no record, and is a ValueError.
    """
    if len(df.columns) == 1 and not df.where(F.col(f"`{df.columns[0]}`").isNull()).isEmpty():
        raise ValueError("a single column with NULLs cannot be told from blank lines")
    df.write.mode("overwrite").options(header=True, **WRITE_CSV).csv(path)
