"""Catalog tables: read, append, stage, replace, change and drop.

Plain Parquet tables have no row-level delete.  A table with a key is therefore
partitioned by a bucket of it, and a change overwrites only the buckets that hold a row
it removes, with Spark's dynamic partition overwrite.  The new rows of these buckets are
written aside first; other rows are appended.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Collection, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborload.functions import keys as K
from arborload.operators.columns import align
from arborload.sources.scratch import CODEC, WRITERS, directories, exists, remove
from arborload.tree import ROOT_KEY

BUCKET = "root_bucket"
PARALLEL_WRITES = 4
_COUNT = "arborload.buckets"
_KEY = "arborload.bucketed_by"


_SORTED = "arborload.sorted_by"
#: A key set up to this size is given to the scan as values, so that it skips row groups.
LOOKUP_KEYS = 1000
#: Rows that a bucket of a clustered table is expected to hold at most.
CLUSTER_ROWS = 2_000_000
_OVERWRITE = "spark.sql.sources.partitionOverwriteMode"
_READY = "ready"
_MANIFEST = "table string, bucket int, filled boolean"


@dataclass
class Change:
    """A prepared change of one table: new rows of some buckets, and rows to append.

    ``filled`` holds those of the ``buckets`` that have new rows, if that is known.
    """

    table: str
    folder: str
    buckets: list[int]
    added: DataFrame | None = None
    filled: set[int] | None = None


class Tables:
    """Tables of one database, kept below one location.

    ``buckets`` is the number of buckets of new tables; existing ones keep theirs.  All
    tables are managed: dropping a table or a partition removes its files.  With
    ``indexed`` the rows of a new bucketed table are sorted by its key inside their files,
    which carry Bloom filters of it: looking up few keys then skips row groups.
    """

    def __init__(
        self, spark: SparkSession, database: str, location: str, buckets: int = 256, indexed: bool = False
    ) -> None:
        self.spark = spark
        self.database = database
        self.location = location.rstrip("/")
        self.buckets = buckets
        self.indexed = indexed
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{self.location}/{database}/managed'")

    @property
    def work(self) -> str:
        """Folder for intermediate results of a run."""
        return f"{self.location}/{self.database}/_work"

    def name(self, table: str) -> str:
        return f"`{self.database}`.`{table}`"

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(f"{self.database}.{table}")

    def read(self, table: str) -> DataFrame:
        """Whole table; filters and column choices of the caller reach the scan."""
        return self.spark.table(self.name(table))

    def schema(self, table: str) -> T.StructType:
        """Columns without the bucket."""
        return T.StructType([f for f in self.read(table).schema.fields if f.name != BUCKET])

    def create(self, table: str, schema: T.StructType, key: str | None = None) -> None:
        """Create an empty table; one with a root key, or a given ``key``, is partitioned by its bucket."""
        columns = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields]
        by = ROOT_KEY if ROOT_KEY in schema.fieldNames() else key
        options, layout = {"compression": CODEC}, ""
        if by:
            columns.append(f"`{BUCKET}` int")
            properties = f"'{_COUNT}' = '{self.buckets}', '{_KEY}' = '{by}'"
            if self.indexed:
                properties += f", '{_SORTED}' = '{by}'"
                options |= {f"parquet.bloom.filter.enabled#{by}": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
            layout = f"PARTITIONED BY (`{BUCKET}`) TBLPROPERTIES ({properties})"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name(table)} ({', '.join(columns)}) "
            f"USING parquet OPTIONS ({', '.join(f"'{k}' = '{v}'" for k, v in options.items())}) {layout}"
        )

    def append(
        self,
        frame: DataFrame,
        table: str,
        drop: Collection[str] = (),
        key: str | None = None,
        finish: Callable[[DataFrame], DataFrame] | None = None,
        gathered: bool = False,
    ) -> None:
        """Add rows, matched to the table's columns by name; a new table is created.

        ``finish`` sees the rows as they are written, after the last shuffle, with the columns to
        ``drop`` behind the table's own; it may observe them.  ``gathered`` rows have been made
        from rows that :meth:`gather` has shuffled, and are written as they come.
        """
        if not self.exists(table):
            self.create(table, T.StructType([f for f in frame.schema.fields if f.name not in drop]), key)
        own = self.schema(table)
        extra = [f for f in frame.schema.fields if f.name in drop] if finish is not None else []
        rows = align(frame, T.StructType(own.fields + extra), drop)
        if self.bucketed_by(table):
            rows = self._bucketed(rows, table) if gathered else self._clustered(rows, table)
        if finish is not None:
            rows = finish(rows).drop(*[f.name for f in extra])
        rows = self._sorted(rows, table) if self.bucketed_by(table) else rows
        rows.write.insertInto(self.name(table))

    def gather(self, rows: DataFrame, table: str) -> DataFrame:
        """Rows with a root key, gathered by the bucket that this key has in a table, which may be a new one."""
        count = self.bucket_count(table) if self.exists(table) else self.buckets
        bucketed = rows.selectExpr("*", f"{K.bucket(ROOT_KEY, count)} AS {BUCKET}")
        return self._by_bucket(bucketed, table, count).drop(BUCKET)

    def stage(self, frame: DataFrame, table: str, drop: Collection[str] = ()) -> str:
        """Make ``stage_<table>`` anew, with the target's columns, and fill it."""
        staged = f"stage_{table}"
        self.drop(staged)
        rows = align(frame, self.schema(table), drop)
        rows.write.format("parquet").option("compression", CODEC).saveAsTable(self.name(staged))
        return staged

    def drop(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name(table)}")

    def replace(self, table: str, rows: DataFrame) -> None:
        """Swap the whole content of a table without a bucket for new rows, which may come from itself."""
        with self.changing(table) as folder:
            align(rows, self.schema(table)).write.parquet(f"{folder}/{table}", compression=CODEC)
            self.apply(folder, [Change(table, folder, [])])

    # -- bucketed change --------------------------------------------------

    def in_buckets(self, table: str, touched: Iterable[int]) -> DataFrame:
        """The table's rows in the given buckets; other buckets are not read."""
        return self.read(table).where(F.col(BUCKET).isin([int(b) for b in touched]))

    @contextmanager
    def changing(self, scope: str) -> Iterator[str]:
        """Folder for the prepared rows of one change; it goes when the change is done.

        If the change fails its folder stays, and ``recover`` finishes or forgets it.  One
        change of a ``scope``, the tables of a feed, may be under way at a time.
        """
        folder = f"{self._changes}/{scope}/{uuid.uuid4().hex}"
        yield folder
        remove(self.spark, folder)

    def prepare(
        self, folder: str, table: str, keys: DataFrame, touched: Iterable[int], fresh: DataFrame | None = None
    ) -> Change:
        """Write the rows that replace those of ``keys``; the table itself is not changed yet.

        ``keys`` holds the column the table is bucketed by and its bucket, ``touched``
        all their buckets.  Only buckets in which a key has a row are written, with
        their ``fresh`` rows; the other fresh rows are left to be appended.
        """
        key = self.bucketed_by(table)
        old = self._with_keys(self.in_buckets(table, touched), keys, key)
        wanted = keys.select(key, BUCKET)
        found = old.select(key, BUCKET).join(wanted, [key, BUCKET], "left_semi").select(BUCKET).distinct()
        buckets = sorted(r[0] for r in found.collect())
        added = None
        if fresh is not None:
            added = self._bucketed(align(fresh, self.schema(table)), table)
        if buckets:
            rows = self.in_buckets(table, buckets).join(wanted.select(key), key, "left_anti")
            within = F.col(BUCKET).isin(buckets)
            if added is not None:
                rows = rows.select(*added.columns).unionByName(added.where(within))
                added = added.where(~within)
            seen = Observation()
            rows = self._by_bucket(rows, table).observe(seen, F.collect_set(BUCKET).alias("filled"))
            rows.write.parquet(f"{folder}/{table}", compression=CODEC)
            return Change(table, folder, buckets, added, set(seen.get["filled"]))
        return Change(table, folder, buckets, added)

    def apply(self, folder: str, changes: Sequence[Change]) -> None:
        """Make prepared changes visible, several tables side by side.

        A manifest says that all rows are prepared and which buckets become empty.  A
        run that dies after it has been written is finished by ``recover``: overwriting
        a bucket twice with the same rows does no harm.  Rows are appended last; they
        are found by their keys, and replaced, when the same batch is run again.
        """
        self._manifest(changes).coalesce(1).write.parquet(f"{folder}/{_READY}")
        self._overwrite(folder)

        def append(change: Change) -> None:
            if change.added is not None:
                added = self._sorted(self._by_bucket(change.added, change.table), change.table)
                added.write.insertInto(self.name(change.table))

        _each(append, changes)

    def purge(self, scope: str, tables: Iterable[str], condition: str) -> None:
        """Remove the rows that satisfy a condition; only buckets that hold one are written anew."""
        left = f"NOT coalesce({condition}, false)"
        with self.changing(scope) as folder:
            changes = []
            for table in tables:
                rows, buckets = self.read(table), []
                if self.bucketed_by(table):
                    buckets = sorted(r[0] for r in rows.where(condition).select(BUCKET).distinct().collect())
                    if not buckets:
                        continue
                    rows = self.in_buckets(table, buckets)
                rows.where(left).write.parquet(f"{folder}/{table}", compression=CODEC)
                changes.append(Change(table, folder, buckets))
            self.apply(folder, changes)

    def recover(self, scope: str) -> list[str]:
        """Finish changes of a scope that were broken off while they were being made visible; returns their folders.

        Changes whose rows were not all prepared have changed nothing and are forgotten.
        """
        found = sorted(directories(self.spark, f"{self._changes}/{scope}"))
        for folder in found:
            if exists(self.spark, f"{folder}/{_READY}/_SUCCESS"):
                self._overwrite(folder)
            remove(self.spark, folder)
        return found

    def _manifest(self, changes: Sequence[Change]) -> DataFrame:
        """A row per table and bucket that changes; a table without buckets has one row."""
        rows = []
        for change in changes:
            if change.buckets:
                filled = change.filled
                if filled is None:
                    written = self.spark.read.parquet(f"{change.folder}/{change.table}").select(BUCKET).distinct()
                    filled = {r[0] for r in written.collect()}
                rows += [(change.table, b, b in filled) for b in change.buckets]
            elif change.added is None and exists(self.spark, f"{change.folder}/{change.table}"):
                rows.append((change.table, None, True))
        return self.spark.createDataFrame(rows, _MANIFEST)

    def _overwrite(self, folder: str) -> None:
        by_table: dict[str, list[tuple[int | None, bool]]] = {}
        for table, bucket, filled in self.spark.read.schema(_MANIFEST).parquet(f"{folder}/{_READY}").collect():
            by_table.setdefault(table, []).append((bucket, filled))
        before = self.spark.conf.get(_OVERWRITE)
        self.spark.conf.set(_OVERWRITE, "dynamic")

        def overwrite(table: str) -> None:
            buckets = by_table[table]
            if any(filled for _, filled in buckets):
                rows = self.spark.read.schema(self.read(table).schema).parquet(f"{folder}/{table}")
                self._sorted(rows, table).write.insertInto(self.name(table), overwrite=True)
            # Dynamic overwrite leaves a partition alone that the new rows don't have.
            empty = [f"PARTITION ({BUCKET}={b})" for b, filled in buckets if not filled]
            if empty:
                self.spark.sql(f"ALTER TABLE {self.name(table)} DROP IF EXISTS {', '.join(empty)}")
            self.spark.catalog.refreshTable(self.name(table))

        try:
            _each(overwrite, by_table)
        finally:
            self.spark.conf.set(_OVERWRITE, before)

    @property
    def _changes(self) -> str:
        return f"{self.work}/changes"

    # -- lookups and joins by key ------------------------------------------

    def lookup(self, table: str, keys: DataFrame) -> DataFrame:
        """The table's rows whose key is in ``keys``, which holds the column it is bucketed by.

        Only the buckets of the keys are read, and of an indexed table only row groups
        that may hold one.
        """
        key = self.bucketed_by(table)
        columns = self.schema(table).fieldNames()
        wanted = keys.select(key).where(f"`{key}` IS NOT NULL").distinct()
        bucketed = wanted.selectExpr(f"{K.bucket(f'`{key}`', self.bucket_count(table))} AS {BUCKET}").distinct()
        rows = self.in_buckets(table, [r[0] for r in bucketed.collect()])
        return self._with_keys(rows, wanted, key).join(wanted, key, "left_semi").select(*columns)

    def _with_keys(self, rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
        """Rows that may have one of the keys: a small key set is pushed into the scan as values."""
        few = [r[0] for r in keys.select(key).distinct().limit(LOOKUP_KEYS + 1).collect()]
        return rows if len(few) > LOOKUP_KEYS else rows.where(F.col(f"`{key}`").isin(few))

    def cluster(self, table: str, rows: DataFrame, key: str, count: int) -> DataFrame:
        """Write a table hashed and sorted by ``key`` into ``count`` buckets, one file each; returns it.

        A large table gets more, so that no bucket is expected to hold over ``CLUSTER_ROWS`` rows: a
        task sorts a bucket, when it is written and when it is joined.
        Joins on the key then exchange only the other side.  All rows of a key lie in one
        bucket, so the key has to be one that few rows share, such as the root key.
        """
        self.drop(table)
        count = max(count, -(-rows.count() // CLUSTER_ROWS))
        spread = rows.repartition(count, F.col(f"`{key}`"))
        spread.write.format("parquet").option("compression", CODEC).bucketBy(count, key).sortBy(key).saveAsTable(self.name(table))
        return self.read(table)

    def _sorted(self, rows: DataFrame, table: str) -> DataFrame:
        """Rows in the order in which an indexed table stores them."""
        key = self._property(table, _SORTED)
        return rows if key is None else rows.sortWithinPartitions(BUCKET, key)

    def ordered(self, names: Iterable[str]) -> bool:
        """Whether rows are stored in order in any of the given tables, or would be in a new one."""
        return self.indexed or any(self._property(t, _SORTED) is not None for t in names if self.exists(t))

    def most_buckets(self, names: Iterable[str]) -> int:
        """Number of buckets of the given tables at most; those that are not there get this object's."""
        found = [self._property(t, _COUNT) if self.exists(t) else self.buckets for t in names]
        return max(int(n or 0) for n in found)

    def bucketed_by(self, table: str) -> str | None:
        """Column whose bucket the table is partitioned by, if any."""
        return self._property(table, _KEY)

    def bucket_count(self, *tables: str) -> int:
        """Number of buckets of the given tables, which must agree."""
        counts = {int(self._property(t, _COUNT)) for t in tables}
        if len(counts) != 1:
            raise ValueError(f"tables differ in their number of buckets: {sorted(counts)}")
        return counts.pop()

    def _property(self, table: str, name: str) -> str | None:
        rows = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(table)}").collect()
        return next((r["value"] for r in rows if r["key"] == name), None)

    def _bucketed(self, rows: DataFrame, table: str) -> DataFrame:
        count = self.bucket_count(table)
        return rows.selectExpr("*", f"{K.bucket(f'`{self.bucketed_by(table)}`', count)} AS {BUCKET}")

    def _clustered(self, rows: DataFrame, table: str) -> DataFrame:
        """Rows gathered by bucket for writing."""
        return self._by_bucket(self._bucketed(rows, table), table)

    def _by_bucket(self, rows: DataFrame, table: str, count: int | None = None) -> DataFrame:
        """Rows shuffled by bucket, where Spark splits a bucket that is too large.

        Where a task may write all buckets side by side, rows stay where they are.
        """
        count = self.bucket_count(table) if count is None else count
        return rows if count <= int(self.spark.conf.get(WRITERS)) else rows.hint("rebalance", BUCKET)


def _each(work: Callable, items: Iterable) -> None:
    """Run the independent writes of a change side by side."""
    with ThreadPoolExecutor(PARALLEL_WRITES) as pool:
        list(pool.map(work, items))
