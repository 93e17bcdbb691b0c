"""Cutting lineage in shared storage, and telling small tables from large ones."""

from __future__ import annotations

import tempfile
import uuid
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SMALL_ROWS = 10_000  # most rows that may be pinned in the driver and broadcast
SMALL_BYTES = 16 << 20  # and the most bytes of them


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``; a temporary one in local mode only."""
    sc = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="tabwright-"))
        folder = sc.getCheckpointDir()
    return folder


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_folder(spark).rstrip('/')}/tabwright-{spark.sparkContext.applicationId}"


def scratch_folder(spark: SparkSession) -> str:
    """A new folder of this application in the shared one; ``discard`` removes it with the copies."""
    return f"{_own_folder(spark)}/{uuid.uuid4().hex}"


def materialise(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """The frame written once as parquet in the shared folder and read back.

    Later scans prune columns and push filters into the copy, and a lost executor re-reads a file
    instead of re-running the steps that led here. With ``partition_by`` a filter on that column opens
    only the files it needs. ``drop_copy`` removes one copy, ``discard`` all of them.
    """
    path = scratch_folder(df.sparkSession)
    df.write.parquet(path, partitionBy=partition_by)
    copy = df.sparkSession.read.schema(df.schema).parquet(path).select(*[f"`{c}`" for c in df.columns])
    copy.copy_path = path
    return copy


def drop_copy(copy: DataFrame) -> None:
    """Delete what ``materialise`` wrote for this frame; it and frames made from it are unusable after."""
    drop_folder(copy.sparkSession, copy.copy_path)


def drop_folder(spark: SparkSession, folder: str) -> None:
    """Delete a folder, such as one of ``scratch_folder``."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def discard(spark: SparkSession) -> None:
    """Delete everything ``materialise`` wrote in this application; its frames are unusable after."""
    drop_folder(spark, _own_folder(spark))


def pin_small(df: DataFrame, max_rows: int = SMALL_ROWS, max_bytes: int = SMALL_BYTES) -> tuple[DataFrame, list[dict] | None]:
    """(frame, rows): a local copy and its rows if it has at most ``max_rows`` and ``max_bytes``, else (a table, None).

    No more than ``max_rows + 1`` rows are looked at for this. Where their size is not plain from the types, they are stored
    and measured before they reach the driver. Either way the plan that made the frame is not run again by whoever
    uses the result.
    """
    few = df.limit(max_rows + 1)
    loose = [f.name for f in df.schema if not isinstance(f.dataType, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType))]
    if not loose:
        local = few.toArrow()
        if local.num_rows <= max_rows and local.nbytes <= max_bytes:
            return df.sparkSession.createDataFrame(local, df.schema), local.to_pylist()
        return materialise(df), None
    stored = materialise(few)
    length = reduce(add, [F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{c}`")))), F.lit(0)) for c in loose])
    told = stored.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(length), F.lit(0)).alias("bytes")).first()
    local = stored.toArrow() if told["rows"] <= max_rows and told["bytes"] <= max_bytes else None
    drop_copy(stored)
    if local is None:
        return materialise(df), None
    return df.sparkSession.createDataFrame(local, df.schema), local.to_pylist()
