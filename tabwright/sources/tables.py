"""Named tables that steps read and replace."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession

COMMITS = 20  # tries to be the next writer


class Tables:
    """Tables of one catalog database, always replaced whole."""

    def __init__(self, spark: SparkSession, database: str = "default"):
        self.spark = spark
        self.database = database
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")

    def _name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def read(self, table: str) -> DataFrame:
        return self.spark.table(self._name(table))

    def drop(self, tables: Iterable[str]) -> None:
        for table in tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._name(table)}")

    def write(self, frames: dict[str, DataFrame], read_from: Iterable[str] = ()) -> None:
        """Replace every named table.

        A table that is also an input is written beside the old one first and swapped in after all
        outputs are complete, so no output ever reads a half-replaced input.
        """
        inputs = set(read_from)
        staged = [t for t in frames if t in inputs]
        for table, df in frames.items():
            target = f"{table}__next" if table in inputs else table
            df.write.mode("overwrite").format("parquet").saveAsTable(self._name(target))
        for table in staged:  # a failure in between leaves the old table under ``__old``
            self.drop([f"{table}__old"])
            self._rename(table, f"{table}__old")
            self._rename(f"{table}__next", table)
            self.drop([f"{table}__old"])

    def _rename(self, table: str, to: str) -> None:
        self.spark.sql(f"ALTER TABLE {self._name(table)} RENAME TO {self._name(to)}")


class FolderTables:
    """The same over a folder that all executors reach: parquet folders, and manifests that say which of them are the tables.

    Every write goes to new folders. When all of them are complete, one new manifest, with the next number, names the
    tables' folders; a file of its name can only be created once. So several outputs of a step appear at the same time
    or not at all, whatever fails in between, and a reader's files are not changed under it. ``vacuum`` removes folders
    that the latest manifests do not name.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def version(self) -> int:
        """Number of the latest manifest; 0 without one."""
        return max(self._versions(), default=0)

    def tables(self, version: int | None = None) -> dict[str, str]:
        """Folder of each table, now or as of an earlier version that ``vacuum`` has left."""
        version = self.version() if version is None else version
        return json.loads(self._text(self._manifest(version))) if version else {}

    def read(self, table: str, version: int | None = None) -> DataFrame:
        named = self.tables(version)
        if table not in named:
            raise ValueError(f"there is no table {table}")
        return self.spark.read.parquet(f"{self.folder}/{named[table]}")

    def drop(self, tables: Iterable[str]) -> None:
        gone = set(tables)
        self._commit(lambda named: {t: f for t, f in named.items() if t not in gone})

    def write(self, frames: dict[str, DataFrame], read_from: Iterable[str] = ()) -> None:
        """Replace every named table, all at once. Frames may read the tables they replace."""
        new = {table: f"{table}/{uuid.uuid4().hex}" for table in frames}
        for table, df in frames.items():
            df.write.parquet(f"{self.folder}/{new[table]}")
        self._commit(lambda named: named | new)

    def vacuum(self, keep: int = 2) -> None:
        """Remove manifests but the last ``keep``, and folders that none of these names. Not while a step writes."""
        versions = sorted(self._versions())
        kept, old = versions[-keep:], versions[:-keep]
        used = {f for v in kept for f in self.tables(v).values()}
        before = {f for v in old for f in self.tables(v).values()}
        for folder in before - used:
            self._system().delete(self._hadoop(f"{self.folder}/{folder}"), True)
        for v in old:
            self._system().delete(self._manifest(v), False)

    def _commit(self, change: Callable[[dict[str, str]], dict[str, str]]) -> None:
        for _ in range(COMMITS):
            version = self.version()
            before = self.tables(version)
            after = change(before)
            if after == before:
                return
            if self._create(self._manifest(version + 1), json.dumps(after, indent=1, sort_keys=True)):
                return
        raise OSError(f"other writers changed {self.folder} {COMMITS} times in a row")

    def _create(self, path, text: str) -> bool:
        """Write the manifest beside its place and give it its name, unless another writer has taken the name."""
        system, beside = self._system(), self._hadoop(f"{self.folder}/_manifests/_{uuid.uuid4().hex}")
        out = system.create(beside, False)
        out.write(bytearray(text.encode()))
        out.close()
        if not system.exists(path) and system.rename(beside, path):
            return True
        system.delete(beside, False)
        return False

    def _versions(self) -> list[int]:
        folder = self._hadoop(f"{self.folder}/_manifests")
        if not self._system().exists(folder):
            return []
        names = [s.getPath().getName() for s in self._system().listStatus(folder)]
        return [int(n.removesuffix(".json")) for n in names if n.endswith(".json")]

    def _manifest(self, version: int):
        return self._hadoop(f"{self.folder}/_manifests/{version:010d}.json")

    def _text(self, path) -> str:
        stream = self._system().open(path)
        try:
            return bytes(self.spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
        finally:
            stream.close()

    def _system(self):
        return self._hadoop(self.folder).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _hadoop(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)


def run_step(
    tables: Tables | FolderTables,
    inputs: str | list[str],
    step: Callable[..., dict[str, DataFrame]],
    drop_first: Iterable[str] = (),
) -> list[str]:
    """Load ``inputs`` (one name or a list), call ``step(*frames)``, write what it returns by name."""
    if not inputs:
        raise ValueError("a step needs at least one input table")
    names = [inputs] if isinstance(inputs, str) else list(inputs)
    doomed = list(drop_first)
    if set(doomed) & set(names):
        raise ValueError("a step cannot drop a table it reads")
    tables.drop(doomed)
    outputs = step(*[tables.read(n) for n in names])
    tables.write(outputs, read_from=names)
    return list(outputs)
