"""Records of CSV files whose quoted fields may hold line feeds, found in all input splits at once.

A file is read as lines, split by split. A first pass tells for every split how it ends if it starts outside quotes,
and how if it starts inside: two answers, composed along the file, tell how each split really starts. The second pass cuts
records; one that reaches over the end of a split is put together from its parts. So a large file is read by
many tasks, which a reader of whole files cannot do.

A field is quoted if a quote stands right at its start; quotes inside are doubled. Other quotes and backslashes are text.
"""

from __future__ import annotations

import csv
import io
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MOST_SPLITS = 1_000_000  # splits that may start inside quotes, and files whose header is not the common one


def inside_after(line: str, inside: bool, sep: str) -> bool:
    """True if a quoted field is open after the line, which starts inside one or at a field's start."""
    if '"' not in line:
        return inside
    at = 0
    while True:
        if inside:
            close = line.find('"', at)
            if close < 0:
                return True
            if line.startswith('"', close + 1):
                at = close + 2
                continue
            inside, at = False, close + 1
        elif line.startswith('"', at):
            inside, at = True, at + 1
            continue
        comma = line.find(sep, at)
        if comma < 0:
            return False
        at = comma + len(sep)


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bool, list[str]]]:
    """(file, start, new split, lines): runs of lines of one split, in order."""
    last = None
    for batch in batches:
        values, files, starts = (c.to_pylist() for c in batch.columns)
        at = 0
        while at < len(values):
            end, split = at + 1, (files[at], starts[at])
            while end < len(values) and starts[end] == split[1] and files[end] == split[0]:
                end += 1
            yield *split, split != last, values[at:end]
            last, at = split, end


def _split_ends(lines: DataFrame, sep: str) -> DataFrame:
    """(file, start, from_out, from_in, header) of every split: whether it ends inside quotes, either way it starts."""
    def scan(batches):
        out, now = [], None
        for file, start, new, lines in _by_split(batches):
            if new:
                now = [file, start, False, True, None, start == 0]
                out.append(now)
            for line in lines:
                if now[5]:  # the header, which may hold line feeds too
                    now[4] = line if now[4] is None else f"{now[4]}\n{line}"
                now[2] = inside_after(line, now[2], sep)
                now[3] = inside_after(line, now[3], sep)
                now[5] = now[5] and now[2]
            if len(out) > 1000:
                yield _batch([o[:5] for o in out[:-1]])
                del out[:-1]
        yield _batch([o[:5] for o in out])

    def _batch(rows):
        names = ["file", "start", "from_out", "from_in", "header"]
        types = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], names)

    return lines.mapInArrow(scan, "file string, start long, from_out boolean, from_in boolean, header string")


def _split_starts(ends: DataFrame) -> DataFrame:
    """``ends`` with ``inside``: how each split starts. A split that ends alike either way decides, others turn or keep."""
    along = Window.partitionBy("file").orderBy("start")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    turns = ends.withColumn("turns", F.sum((F.col("from_out") & ~F.col("from_in")).cast("int")).over(along))
    settled = F.when(F.col("from_out") == F.col("from_in"), F.struct("start", F.col("from_out").alias("end"), "turns"))
    told = turns.withColumns({"settled": F.max(settled).over(before), "so_far": F.max("turns").over(before)})
    odd = (F.coalesce("so_far", F.lit(0)) - F.coalesce("settled.turns", F.lit(0))) % 2 == 1
    return told.select("file", "start", "header", (F.coalesce("settled.end", F.lit(False)) != odd).alias("inside"))


def read_records(spark: SparkSession, path: str, sep: str = ",", header: bool = True) -> tuple[DataFrame, list[str]]:
    """((record, header, closed), headers): every record of every file and the place of its file's header in the list.

    Without ``header`` the list is empty and the column is 0. Blank lines are no records. A quote that is never closed
    makes one record up to the end of its file, with ``closed`` false.
    """
    lines = _lines(spark, path)
    starts = _split_starts(_split_ends(lines, sep)).cache()  # one row per split
    try:
        inside = starts.where("inside").select("file", "start").limit(MOST_SPLITS + 1).toArrow()
        headers = [r["header"].removesuffix("\r") for r in starts.where("header IS NOT NULL").groupBy("header").count().orderBy(F.desc("count"), "header").collect()] \
            if header else []
        other = starts.where(F.col("header").isNotNull() & (F.regexp_replace("header", "\r$", "") != headers[0])).select("file", "header") \
            .limit(MOST_SPLITS + 1).toArrow() if len(headers) > 1 else None
    finally:
        starts.unpersist()
    if len(inside) > MOST_SPLITS or other is not None and len(other) > MOST_SPLITS:
        raise ValueError(f"more than {MOST_SPLITS} splits start inside quotes, or files have unlike headers")
    headers = list(dict.fromkeys(headers))
    open_at = set(zip(inside["file"].to_pylist(), inside["start"].to_pylist()))
    header_of = {f: headers.index(h.removesuffix("\r")) for f, h in zip(other["file"].to_pylist(), other["header"].to_pylist())} if other else {}
    told = spark.sparkContext.broadcast((open_at, header_of))

    def records(wanted_parts: bool):
        def cut(batches):
            open_at, header_of = told.value
            rows: list[tuple] = []
            held: list[str] = []  # lines of the record that is open
            split, skip, first, state = None, False, False, False

            def close(whole: bool) -> None:
                nonlocal held, skip, first
                file, start = split
                if whole and not first and skip:
                    skip = False  # the header
                elif whole and not first:
                    text = "\n".join(held).removesuffix("\r")
                    if text and not wanted_parts:
                        rows.append((file, start, 0, text, True))
                elif wanted_parts and held:  # part of a record that began before, or goes on after
                    rows.append((file, start, 0 if first else 1, "\n".join(held), whole))
                held, first = [], False

            for file, start, new, lines in _by_split(batches):
                if new:
                    if held:
                        close(False)
                    split, state = (file, start), (file, start) in open_at
                    first, skip = state, header and start == 0
                for line in lines:
                    held.append(line)
                    state = inside_after(line, state, sep)
                    if not state:
                        close(True)
                if len(rows) > 4096:
                    yield _rows(rows, header_of)
                    rows = []
            if held:
                close(False)
            yield _rows(rows, header_of)

        return cut

    def _rows(rows, header_of):
        file, start, order, record, closed = zip(*rows) if rows else ((), (), (), (), ())
        return pa.RecordBatch.from_arrays([
            pa.array(file, pa.string()), pa.array(start, pa.int64()), pa.array(order, pa.int32()), pa.array(record, pa.string()),
            pa.array([header_of.get(f, 0) for f in file], pa.int32()), pa.array(closed, pa.bool_())],
            ["file", "start", "order", "record", "header", "closed"])

    schema = "file string, start long, order int, record string, header int, closed boolean"
    whole = lines.mapInArrow(records(False), schema).select("record", "header", "closed")
    # records over the end of a split, and ones that no quote closes
    parts = lines.mapInArrow(records(True), schema)
    along = Window.partitionBy("file").orderBy("start", "order")
    began = F.max(F.when(F.col("order") == 1, F.col("start"))).over(along)
    joined = parts.withColumn("began", began).groupBy("file", "began", "header").agg(
        F.array_sort(F.collect_list(F.struct("start", "order", "record"))).alias("parts"), F.max("closed").alias("closed"))
    text = F.regexp_replace(F.array_join(F.transform("parts", lambda p: p["record"]), "\n"), "\r$", "")
    return whole.unionByName(joined.select(text.alias("record"), "header", "closed")), headers


def header_names(header: str, sep: str = ",") -> list[str]:
    return next(csv.reader(io.StringIO(header, newline=""), delimiter=sep))
