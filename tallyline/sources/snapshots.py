"""Tables published as snapshots: written aside, then made visible together.

A store is a folder. Data lies in a folder per transaction and is never changed. A snapshot is a
small numbered file that says, for each table, which folders hold it; it is created last, whole or
not at all, and only if no other writer took its number. Readers resolve the newest snapshot, so a
write that dies half-way, at any point, changes nothing for them.

    with TableStore(spark, root).begin() as txn:
        txn.write("core_sales", fact, partition_by="txn_year")
        txn.write("rpt_monthly_revenue", marts.monthly_revenue(txn.read("core_sales")))
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.sources import files

_NULL = "__HIVE_DEFAULT_PARTITION__"
_WHOLE = ""
OPEN_FILES = 16
CODEC = "zstd"


class StaleSnapshot(RuntimeError):
    """Another writer published first; the transaction has to be done again."""


class NoSuchTable(KeyError):
    """The snapshot has no table of that name."""


@dataclass(frozen=True)
class Table:
    """Where a table lies: the roots that hold each of its folders (one, ``""``, if it is not
    partitioned). ``column``: the table is what this struct column holds."""

    schema: str
    partition: str | None
    folders: dict[str, list[str]]
    column: str | None = None
    extra: dict = field(default_factory=dict)

    def as_json(self) -> dict:
        return dict(schema=self.schema, partition=self.partition, folders=self.folders,
                    column=self.column, extra=self.extra)


@dataclass(frozen=True)
class Snapshot:
    store: TableStore
    version: int
    tables: dict[str, Table]

    def read(self, name: str) -> DataFrame:
        if name not in self.tables:
            raise NoSuchTable(name)
        return self.store.frame(self.tables[name])


def folder_name(column: str, value) -> str:
    return f"{column}={_NULL if value is None else value}"


class TableStore:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _versions(self) -> list[int]:
        found = files.names(self.spark, f"{self.root}/_snapshots")
        return sorted(int(n.removesuffix(".json")) for n in found if not n.startswith("."))

    def _manifest(self, version: int) -> str:
        return f"{self.root}/_snapshots/{version:012d}.json"

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The newest snapshot, or an older one that has not expired."""
        if version is None:
            version = max(self._versions(), default=0)
        if version == 0:
            return Snapshot(self, 0, {})
        said = json.loads(files.read_text(self.spark, self._manifest(version)))
        return Snapshot(self, version, {n: Table(**t) for n, t in said["tables"].items()})

    def read(self, name: str) -> DataFrame:
        return self.snapshot().read(name)

    def frame(self, table: Table) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(table.schema))
        by_root: dict[str, list[str]] = {}
        for folder, roots in table.folders.items():
            for root in roots:
                by_root.setdefault(root, []).append(folder)
        frames = []
        for root, folders in by_root.items():
            base = f"{self.root}/{root}"
            paths = [f"{base}/{f}" if f else base for f in folders]
            reader = self.spark.read.schema(schema)
            if table.partition:
                reader = reader.option("basePath", base)
            frames.append(reader.parquet(*paths).select(*schema.fieldNames()))
        if not frames:
            frames = [self.spark.createDataFrame([], schema)]
        out = reduce(DataFrame.unionByName, frames)
        return out.select(f"{table.column}.*") if table.column else out

    def begin(self) -> Transaction:
        return Transaction(self)

    def publish(self, base: Snapshot, tables: dict[str, Table]) -> Snapshot:
        version = base.version + 1
        text = json.dumps({"tables": {n: t.as_json() for n, t in tables.items()}})
        if not files.create_text(self.spark, self._manifest(version), text):
            raise StaleSnapshot(f"snapshot {version} of {self.root} was published meanwhile")
        return Snapshot(self, version, tables)

    def expire(self, keep: int = 2) -> None:
        """Remove all but the newest snapshots, and the data that only the older ones have.

        What a transaction under way has written is in no snapshot, so it stays.
        """
        versions = self._versions()
        old, new = versions[:-keep], versions[-keep:]
        if not old:
            return
        kept = {root for v in new for t in self.snapshot(v).tables.values()
                for roots in t.folders.values() for root in roots}
        for version in old:
            for root in {root for t in self.snapshot(version).tables.values()
                         for roots in t.folders.values() for root in roots} - kept:
                files.remove(self.spark, f"{self.root}/{root}")
            files.remove(self.spark, self._manifest(version))


def counted(df: DataFrame, **counts: Column) -> tuple[DataFrame, Observation]:
    """The frame, and counts that the job which writes it takes along."""
    seen = Observation()
    return df.observe(seen, *(c.alias(n) for n, c in counts.items())), seen


@contextmanager
def _unsorted(spark: SparkSession) -> Iterator[None]:
    """Partitioned writes keep some files open per task before they resort to sorting."""
    conf, key = spark.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(key)
    conf.set(key, str(OPEN_FILES))
    try:
        yield
    finally:
        conf.set(key, before)


def _writer(df: DataFrame) -> DataFrameWriter:
    """Published tables take less room than in Spark's own codec, unless the session names one."""
    named = df.sparkSession.conf.get("spark.sql.parquet.compression.codec", CODEC)
    return df.write.option("compression", named)


class Transaction:
    """Writes of one snapshot. As a context it publishes at the end, or leaves no trace."""

    def __init__(self, store: TableStore):
        self.store, self.base = store, store.snapshot()
        self.tables = dict(self.base.tables)
        self.rows: dict[str, int] = {}
        self._last: dict[str, Table] = {}
        self._own: list[str] = []

    def _new_root(self, name: str) -> str:
        self._own.append(f"data/{uuid.uuid4().hex}/{name}")
        return self._own[-1]

    def write(
        self, name: str, df: DataFrame, partition_by: str | None = None,
        replace: Iterable | None = None, append: bool = False, extra: dict | None = None,
    ) -> int:
        """Write a table in one job; returns the rows written.

        ``replace`` names the partition values that ``df`` replaces (with nothing, where it has
        no rows of one); the other partitions stay as they are. ``append`` adds to the table.
        Without both the whole table is replaced.
        """
        root = self._new_root(name)
        path = f"{self.store.root}/{root}"
        frame, seen = counted(df, rows=F.count(F.lit(1)))
        if partition_by is None:
            _writer(frame).parquet(path)
        else:
            with _unsorted(self.store.spark):
                _writer(frame).partitionBy(partition_by).parquet(path)
        self.rows[name] = seen.get["rows"]
        made = [_WHOLE] if partition_by is None else [
            n for n in files.names(self.store.spark, path) if n.startswith(f"{partition_by}=")]
        before = self.tables.get(name)
        folders: dict[str, list[str]] = {}
        if before is not None and (append or replace is not None):
            if before.partition != partition_by:
                raise ValueError(f"{name} is partitioned by {before.partition}")
            gone = set() if append else {folder_name(partition_by, v) for v in replace}
            folders = {f: list(roots) for f, roots in before.folders.items() if f not in gone}
        for folder in made:
            folders.setdefault(folder, []).append(root)
        self.tables[name] = Table(df.schema.json(), partition_by, folders, extra={"rows": self.rows[name]} | (extra or {}))
        self._last[name] = Table(df.schema.json(), partition_by, {folder: [root] for folder in made})
        return self.rows[name]

    def write_split(
        self, df: DataFrame, flag: str, tables: dict[bool, tuple[str, T.StructType, str | None]],
    ) -> dict[str, int]:
        """Write several tables from one frame in one job, told apart by a boolean column.

        ``tables``: for each value of ``flag`` the table's name, the schema to read it with, and
        the struct column that holds it, if one does. Both kinds of rows are written as they
        come, without sorting them apart first.
        """
        root = self._new_root("split")
        path = f"{self.store.root}/{root}"
        frame, seen = counted(df, **{
            name: F.count_if(F.col(flag) == value) for value, (name, _, _) in tables.items()})
        with _unsorted(self.store.spark):
            _writer(frame).partitionBy(flag).parquet(path)
        made = files.names(self.store.spark, path)
        for value, (name, schema, column) in tables.items():
            folder = f"{flag}={str(value).lower()}"
            folders = {_WHOLE: [f"{root}/{folder}"]} if folder in made else {}
            self.tables[name] = Table(schema.json(), None, folders, column)
            self.rows[name] = seen.get[name]
        return {name: self.rows[name] for name, _, _ in tables.values()}

    def read(self, name: str) -> DataFrame:
        """A table as this transaction has it."""
        if name not in self.tables:
            raise NoSuchTable(name)
        return self.store.frame(self.tables[name])

    def written(self, name: str) -> DataFrame:
        """What this transaction's last write of a table has added to it."""
        return self.store.frame(self._last[name])

    def commit(self) -> Snapshot:
        return self.store.publish(self.base, self.tables)

    def abort(self) -> None:
        for root in self._own:
            files.remove(self.store.spark, f"{self.store.root}/{root.rsplit('/', 1)[0]}")

    def __enter__(self) -> Transaction:
        return self

    def __exit__(self, kind, *_) -> None:
        if kind is not None:
            self.abort()
            return
        try:
            self.commit()
        except StaleSnapshot:
            self.abort()
            raise
