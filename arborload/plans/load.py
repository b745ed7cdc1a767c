"""A run: scan a slice, shape it, then append, upsert or delete."""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborload.functions import keys as K
from arborload.functions.header import SOURCE_FILE, VOLATILE
from arborload.operators import links, quality, reports
from arborload.operators.columns import align
from arborload.operators.flatten import flatten_from, rejects
from arborload.operators.metrics import Metrics
from arborload.operators.project import keeps, project, project_tree
from arborload.plans.config import Feed, Mode, Versions
from arborload.sinks.ledger import Ledger
from arborload.sinks.reports import report_path, write_rows, write_summary
from arborload.sinks.tables import BUCKET, PARALLEL_WRITES, Tables
from arborload.sources.csv import CsvTransform, csv_to_parquet
from arborload.sources.landing import (
    Granularity,
    cover,
    delete_keys,
    in_utc,
    missing,
    scan,
    scan_range,
    slice_of,
    slice_path,
    with_partitions,
)
from arborload.sources.scratch import CODEC, exists, materialise, remove, tidy
from arborload.streaming.incremental import load_batches
from arborload.tree import BATCH_ID, POSITION, ROOT_KEY, Tree, with_paths

RECORD_HASH = "recordHash"
_DIGEST = "__document_digest"
_ORDER = "__order"
_COPIES = "__copies"
#: So many rows of a file share a row of the marks that tell which documents stay.
MARK_SPAN = 1024
ROOT_VERSION = "root_version"

Read = Callable[[T.StructType, bool], DataFrame]


@dataclass
class Outcome:
    """What a run leaves behind besides the tables."""

    metrics: Metrics
    tables: list[str] = field(default_factory=list)
    report: str | None = None
    unmatched: str | None = None
    rejected: str | None = None


def run(
    spark: SparkSession,
    feed: Feed,
    mode: Mode | str,
    tables: Tables,
    run_id: str,
    granularity: Granularity | str = Granularity.ALL,
    as_of: datetime | None = None,
    reports_to: str | None = None,
    state: str | None = None,
    between: tuple[datetime, datetime] | None = None,
) -> Outcome:
    """Run one batch of a feed.

    ``bulk`` appends, ``upsert`` replaces every root of the batch together with its
    subtree, ``delete`` reads the batch as a delete feed and inserts nothing.  An
    unknown mode raises ``ValueError``.  Repeating an upsert or a delete with the
    same batch changes nothing.

    The clock is read once, and files modified since then are left out, so all tables
    load the same files whatever lands meanwhile.  With the granularity ``new`` the files
    are those that no earlier run with the same ``state`` folder has seen, in batches
    with a reports folder each.  A batch that failed is repeated; a ``bulk`` load first
    removes the rows that the failed attempt has left, so every row is there once.  A
    slice or an area that does not exist has no rows and gives two metrics.  ``between``
    is a range of landing times to load in place of a slice.
    """
    with tidy(spark, tables.ordered(_names(feed)), tables.most_buckets(_names(feed))):
        return _run(spark, feed, Mode(mode), tables, run_id, Granularity(granularity), as_of, reports_to, state, between)


def _run(spark, feed: Feed, mode: Mode, tables: Tables, run_id: str, granularity: Granularity, as_of, reports_to, state, between) -> Outcome:
    as_of = as_of or datetime.now(timezone.utc)
    outcome = Outcome(Metrics(run_id))
    tables.recover(_scope(feed))
    if granularity is Granularity.NEW:
        if state is None:
            raise ValueError("new files need a state folder")
        _run_new(spark, feed, mode, tables, outcome, as_of, reports_to, state)
    else:
        until = time.time()
        bounds = cover(*in_utc(*between)) if between else [slice_of(granularity, as_of)]
        if not any(exists(spark, slice_path(feed.landing, b)) for b in bounds):
            missing(outcome.metrics, feed.entity)

        def read(schema: T.StructType, file: bool) -> DataFrame:
            if between is not None:
                return scan_range(spark, feed.landing, schema, *between, source_file=file, until=until)
            return scan(spark, feed.landing, schema, granularity, as_of, source_file=file, until=until)

        _run_batch(feed, mode, tables, read, outcome, as_of, reports_to)
    outcome.tables = list(dict.fromkeys(outcome.tables))
    return outcome


def _names(feed: Feed) -> list[str]:
    """The feed's tables, the root's last."""
    return [feed.entity] if feed.tree is None else [feed.table(t) for t in feed.tree.leaf_first()]


def _scope(feed: Feed) -> str:
    """Name of the feed's changes: its root table, or its only one."""
    return feed.entity if feed.tree is None else feed.table(feed.tree.root.table)


def _run_new(spark, feed: Feed, mode: Mode, tables: Tables, outcome: Outcome, as_of, reports_to, state: str) -> None:
    ledger = Ledger(spark, f"{tables.location}/{tables.database}/_ledger/{uuid.uuid5(uuid.NAMESPACE_URL, state.rstrip("/")).hex}")
    schema = with_partitions(feed.schema)

    def batch(rows: DataFrame, number: int) -> None:
        tag = None
        if mode is Mode.BULK:
            if ledger.is_done(number):
                return
            tag = f"{outcome.metrics.run_id}/{number}"
            before = ledger.begun(number)
            if before is not None:
                _purge(feed, tables, before)
            ledger.begin(number, tag)
        path = f"{tables.work}/batch-{uuid.uuid4().hex}"
        rows.write.parquet(path, compression=CODEC)

        def read(narrow: T.StructType, file: bool) -> DataFrame:
            fields = with_partitions(narrow).fields + [T.StructField(SOURCE_FILE, T.StringType())] * file
            return spark.read.schema(T.StructType(fields)).parquet(path)

        folder = f"{reports_to.rstrip('/')}/batch-{number:06d}" if reports_to else None
        try:
            _run_batch(feed, mode, tables, read, outcome, as_of, folder, tag, (path,))
        finally:
            remove(spark, path)
        if tag is not None:
            ledger.done(number, tag)

    if not load_batches(spark, feed.landing, schema, state, batch):
        missing(outcome.metrics, feed.entity)


def _purge(feed: Feed, tables: Tables, tag: str) -> None:
    """Remove what a broken-off batch has appended."""
    tables.purge(_scope(feed), [n for n in _names(feed) if tables.exists(n)], f"{BATCH_ID} = {K.quoted(tag)}")


def _run_batch(
    feed: Feed,
    mode: Mode,
    tables: Tables,
    read: Read,
    outcome: Outcome,
    as_of,
    reports_to,
    tag: str | None = None,
    copied: Sequence[str] = (),
) -> None:
    """``copied`` names folders that only ``read`` needs; a tree load removes them once it has read its documents."""
    if mode is Mode.DELETE:
        _delete(feed, tables, read, outcome, reports_to, as_of)
    elif feed.tree is None:
        _load_flat(feed, mode, tables, read, outcome, reports_to, as_of, tag)
    else:
        _load_tree(feed, feed.tree, mode, tables, read, outcome, reports_to, as_of, tag, copied)


# -- documents ---------------------------------------------------------------


def _changed(feed: Feed, docs: DataFrame) -> DataFrame:
    """Documents after the feed's filter and transform."""
    if feed.where is not None:
        docs = docs.where(feed.where)
    return docs.transform(feed.transform) if feed.transform is not None else docs


def _paths_in(condition: str, schema: T.StructType) -> list[tuple[str, ...]]:
    """Columns of the schema that a condition may name; naming too many does no harm."""
    bare = re.sub(r"'(?:[^'\\]|\\.)*'", " ", condition)
    found = []
    for words in re.findall(r"(?:`[^`]+`|\w+)(?:\s*\.\s*(?:`[^`]+`|\w+))*", bare):
        path, inside = [], schema
        for word in re.findall(r"`[^`]+`|\w+", words):
            if not isinstance(inside, T.StructType):
                break
            here = next((f for f in inside.fields if f.name.lower() == word.strip("`").lower()), None)
            if here is None:
                break
            path.append(here.name)
            inside = here.dataType.elementType if isinstance(here.dataType, T.ArrayType) else here.dataType
        if path:
            found.append(tuple(path))
    return found


def _digest(schema: T.StructType) -> str:
    columns = ", ".join(f"`{f.name}`" for f in schema.fields)
    return f"md5(to_json(struct({columns}), map('ignoreNullFields', 'false')))"


def _ordered(feed: Feed) -> list[str]:
    """What orders the versions of a root: the known paths of ``latest_by``, then the digest."""
    known = [p for p in feed.latest_by if _paths_in(p, feed.schema) == [tuple(p.split("."))]]
    return [*known, _digest(feed.schema)]


def _root_path(tree: Tree, name: str) -> str | None:
    """SQL path of a root column in the documents."""
    found = next((f.path for f in tree.root.fields if f.name.lower() == name.lower()), None)
    return None if found is None else ".".join(f"`{p}`" for p in found)


def _latest(feed: Feed, tree: Tree, tables: Tables, read: Read) -> tuple[Read, str]:
    """Reader of the newest document of every natural key, and where its marks are; documents without a key all stay.

    Keys, what orders the versions, and places of documents tell which; whole documents are not sorted.
    """
    key = _root_path(tree, tree.key)
    order = [f"{p} AS {_ORDER}{i}" for i, p in enumerate(_ordered(feed))]
    names = [f"{_ORDER}{i}" for i in range(len(order))]
    ids = read(feed.schema, False).selectExpr(f"{key} AS k", *order, *_PLACE).where("k IS NOT NULL")
    newest = quality.latest_per_key(ids, ["k"], [*names, *_PLACE_NAMES]).select(*_PLACE_NAMES, F.lit(True).alias("__newest"))
    older = ids.select(*_PLACE_NAMES).join(newest, _PLACE_NAMES, "left").where("__newest IS NULL")
    marks, path = _marks(tables, older.select(*_PLACE_NAMES, F.lit(0).cast("long").alias("__n")))
    return _marked(read, marks), path


def _root_version(feed: Feed) -> Column:
    parts = ", ".join(f"'v{i}', {p}" for i, p in enumerate(_ordered(feed)))
    return F.expr(f"named_struct({parts})")


@dataclass
class _Documents:
    """How a run reads its documents: with which schema, and what tells versions apart."""

    read: Read
    tree: Tree
    version: list[str] | None = None
    # What has been written for the reads, and is needed until the last of them.
    written: list[str] = field(default_factory=list)
    # Every version of a document is read once; then only rows of one document can be equal.
    single: bool = False
    # Column with the number of copies that a document stands for, where copies have been removed.
    copies: str | None = None


def _documents(feed: Feed, tree: Tree, tables: Tables, read: Read) -> _Documents:
    """Reader that applies the feed's filter, transform and choice of versions.

    A table reads only the columns it needs, and those the filter names.  A transform,
    versions to compare with those of later runs, and telling versions apart by their content
    need whole documents: these are then written once and read from there.  Older versions and
    copies are marked by their places, and passed by in every read.
    """
    latest = Versions(feed.on_duplicate_root) is not Versions.KEEP_ALL
    by_hash = not tree.version and _root_path(tree, RECORD_HASH) is not None
    digest = not tree.version and not latest and not by_hash
    named = _paths_in(feed.where, feed.schema) if feed.where is not None else []
    source: Read | None = None
    written: list[str] = []

    def narrow(schema: T.StructType, file: bool) -> DataFrame:
        return _changed(feed, read(with_paths(schema, feed.schema, named), file))

    def keep(docs: DataFrame) -> Read:
        whole, path = materialise(docs, tables.work, "documents")
        extra = {f.name: f for f in whole.schema.fields if f.name not in feed.schema.fieldNames()}

        def kept(schema: T.StructType, file: bool) -> DataFrame:
            fields = schema.fields + [f for n, f in extra.items() if file or n != SOURCE_FILE]
            return tables.spark.read.schema(T.StructType(fields)).parquet(path)

        written.append(path)
        return kept

    def instead(before: list[str]) -> None:
        """Remove what an earlier reader needed."""
        for path in before:
            remove(tables.spark, path)
            written.remove(path)

    if feed.transform is not None or digest:
        docs = _changed(feed, read(feed.schema, True))
        source = keep(docs.withColumn(_DIGEST, F.expr(_digest(feed.schema))) if digest else docs)
    if latest:
        source, marks = _latest(feed, tree, tables, source or narrow)
        if Versions(feed.on_duplicate_root) is Versions.NEWEST:
            before = [*written, marks]
            written.append(marks)
            source = keep(source(feed.schema, True).withColumn(ROOT_VERSION, _root_version(feed)))
            instead(before)
        else:
            written.append(marks)
    if by_hash:
        tree = replace(tree, version=(RECORD_HASH,))
    single, copies, repeated = latest, None, False
    if by_hash and not latest:
        digest, clashing, repeated, alike = _same_hash(feed, tree, tables, source or narrow)
        single = not digest and (alike or not repeated)
        if digest:
            before, docs = [*written], (source or narrow)(feed.schema, True)
            source = keep(_digest_where_needed(feed, tree, docs, clashing))
            instead(before)
        if clashing is not None:
            remove(tables.spark, clashing)
    version = None
    if digest:
        version = [f"coalesce({_DIGEST}, hex({_root_path(tree, RECORD_HASH)}))" if by_hash else _DIGEST]
        repeated, single = _same_version(feed, tree, source, version[0])
    if single and repeated:
        same = version[0] if digest else _root_path(tree, RECORD_HASH)
        source, marks = _first_copies(feed, tree, tables, source or narrow, same)
        written.append(marks)
        copies = _COPIES
    return _Documents(source or narrow, tree, version, written, single, copies)


_PLACE = ["_metadata.file_path AS __file", "_metadata.row_index AS __index"]
_PLACE_NAMES = ["__file", "__index"]


def _marks(tables: Tables, places: DataFrame) -> tuple[DataFrame, str]:
    """Places of documents with a number ``__n``, written as a row per ``MARK_SPAN`` rows of a file, and where.

    No two documents share a place, so a span holds a bounded number of marks.
    """
    entry = F.struct(F.expr(f"CAST(__index % {MARK_SPAN} AS SMALLINT)"), F.col("__n"))
    spans = places.groupBy("__file", F.expr(f"__index div {MARK_SPAN}").alias("__span"))
    return materialise(spans.agg(F.map_from_entries(F.sort_array(F.collect_list(entry))).alias("__marks")), tables.work, "marks")


def _marked(read: Read, marks: DataFrame, copies: str | None = None) -> Read:
    """Reader without the documents that are marked 0; ``copies`` gives the others' mark, or 1.

    Documents are joined with the marks while they are read, so that none is written again. A
    mark takes a few bytes, so mostly these are broadcast.
    """

    def left(schema: T.StructType, file: bool) -> DataFrame:
        docs = read(schema, file)
        at = [f"_metadata.row_index div {MARK_SPAN} AS __span", f"CAST(_metadata.row_index % {MARK_SPAN} AS SMALLINT) AS __at"]
        found = docs.selectExpr("*", _PLACE[0], *at).join(marks, ["__file", "__span"], "left")
        number = F.coalesce(F.expr("try_element_at(__marks, __at)"), F.lit(1).cast("long"))
        found = found.withColumn("__n", number).where("__n > 0")
        kept = docs.columns if copies is None else [*docs.columns, copies]
        return found.withColumnRenamed("__n", copies or "__n").select(*[F.col(f"`{c}`") for c in kept])

    return left


def _first_copies(feed: Feed, tree: Tree, tables: Tables, read: Read, version: str) -> tuple[Read, str]:
    """Reader of documents without the copies of another one, with the number of copies that each stands for.

    Also returned is where the marks are written, which is needed as long as documents are read.

    The copy of the smallest file stays, of these the first.  Keys, versions and places of
    documents tell which, so that a document with very many copies is no hot key.
    """
    key = _root_path(tree, tree.key)
    paths = [f.path for f in tree.root.fields if f.name.lower() in (tree.key.lower(), RECORD_HASH.lower())]
    ids = read(with_paths(T.StructType([]), feed.schema, paths), True)
    ids = ids.selectExpr(f"{key} AS k", f"{version} AS h", *_PLACE).where("k IS NOT NULL")
    found = ids.groupBy("k", "h").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*_PLACE_NAMES)).alias("first"))
    several, path = materialise(found.where("n > 1"), tables.work, "copies")
    first = F.col("first.__file").eqNullSafe(F.col("__file")) & F.col("first.__index").eqNullSafe(F.col("__index"))
    places = ids.join(several, ["k", "h"], "inner").select(*_PLACE_NAMES, F.when(first, F.col("n")).otherwise(0).alias("__n"))
    marks, marked_at = _marks(tables, places)
    remove(tables.spark, path)
    return _marked(read, marks, _COPIES), marked_at


def _same_version(feed: Feed, tree: Tree, read: Read, version: str) -> tuple[bool, bool]:
    """Whether a version is repeated under its key, and whether the documents under each are copies of one.

    Versions come from digests of JSON text; a second hash sees what that leaves out of values.
    """
    docs = read(feed.schema, False).selectExpr(f"{_root_path(tree, tree.key)} AS k", f"{version} AS v", f"{_exact(feed.schema)} AS x")
    groups = docs.where("k IS NOT NULL").groupBy("k", "v").agg(F.count(F.lit(1)).alias("n"), F.min("x").alias("x0"), F.max("x").alias("x1"))
    repeated, differ = groups.agg(F.bool_or(F.col("n") > 1), F.bool_or(F.col("x0") != F.col("x1"))).first()
    return bool(repeated), not differ


def _exact(schema: T.StructType) -> str:
    """SQL for a hash that tells apart what JSON text does not; maps can't be hashed, so these never seem alike."""
    return "rand()" if _has_map(schema) else f"xxhash64({', '.join(f'`{f.name}`' for f in schema.fields)})"


def _same_hash(feed: Feed, tree: Tree, tables: Tables, read: Read) -> tuple[bool, str | None, bool, bool]:
    """Whether a record hash fails to tell documents apart, and where the keys are written that share one.

    A pass over keys and hashes finds out whether a hash is NULL or repeated under its key;
    only then are whole documents digested, and only hashes that stand for differing
    documents are written.  Also returned is whether a hash is repeated, and whether the documents
    under each are then copies of one: for that a second hash sees what JSON leaves out of
    values, such as microseconds.
    """
    key, value = _root_path(tree, tree.key), _root_path(tree, RECORD_HASH)
    paths = [f.path for f in tree.root.fields if f.name.lower() in (tree.key.lower(), RECORD_HASH.lower())]
    ids = read(with_paths(T.StructType([]), feed.schema, paths), False)
    pairs = ids.where(f"{key} IS NOT NULL").selectExpr(f"{key} AS k", f"{value} AS h")
    counts = pairs.groupBy("k", "h").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR h IS NULL")
    found = counts.agg(F.bool_or(F.col("h").isNull()), F.bool_or(F.col("h").isNotNull())).first()
    if not found[1]:
        return bool(found[0]), None, False, False
    docs = read(feed.schema, False).where(f"{value} IS NOT NULL")
    digests = docs.selectExpr(f"{key} AS k", f"{value} AS h", f"{_digest(feed.schema)} AS d", f"{_exact(feed.schema)} AS x")
    ends = [f(c).alias(f"{c}{i}") for c in "dx" for i, f in enumerate((F.min, F.max))]
    differ = digests.groupBy("k", "h").agg(*ends).where("d0 <> d1 OR x0 <> x1")
    saved, path = materialise(differ.selectExpr("k", "h", "d0 <> d1 AS apart"), tables.work, "same-hash")
    apart = saved.agg(F.bool_or("apart")).first()[0]
    if not apart:
        remove(tables.spark, path)
        return bool(found[0]), None, True, apart is None
    return True, path, True, False


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return any(_has_map(f.dataType) for f in kind.fields)
    return isinstance(kind, T.MapType) or (isinstance(kind, T.ArrayType) and _has_map(kind.elementType))


def _digest_where_needed(feed: Feed, tree: Tree, docs: DataFrame, clashing: str | None) -> DataFrame:
    """Documents with a digest wherever their record hash does not tell them apart."""
    key, value = _root_path(tree, tree.key), _root_path(tree, RECORD_HASH)
    needed = f"{value} IS NULL"
    if clashing is not None:
        pairs = docs.sparkSession.read.parquet(clashing).where("apart").selectExpr("k AS __k", "h AS __h", "true AS __clash")
        docs = docs.join(pairs, F.expr(f"{key} = __k AND {value} = __h"), "left")
        needed += " OR __clash"
    marked = docs.withColumn(_DIGEST, F.expr(f"CASE WHEN {needed} THEN {_digest(feed.schema)} END"))
    return marked.drop("__k", "__h", "__clash")


# -- loads -------------------------------------------------------------------


def _load_flat(feed, mode, tables: Tables, read, outcome: Outcome, reports_to, as_of, tag: str | None) -> None:
    docs = _changed(feed, read(feed.schema, True))
    run_id = outcome.metrics.run_id
    latest = Versions(feed.on_duplicate_root) is Versions.LATEST
    order = [f"{p} AS {_ORDER}{i}" for i, p in enumerate(_ordered(feed))] if latest else []
    if feed.entity in feed.projections:
        docs = project(
            docs,
            [*feed.projections.select_list(feed.entity, run_id), *order],
            header="nested" if feed.header else None,
            as_of=as_of,
        )
    elif order:
        docs = docs.selectExpr("*", *order)
    keyless = f"`{feed.natural_key}` IS NULL" if latest or mode is Mode.UPSERT else "false"
    if latest:
        names = [f"{_ORDER}{i}" for i in range(len(order))]
        newest = quality.latest_per_key(docs.where(f"NOT {keyless}"), [feed.natural_key], names)
        docs = newest.unionByName(docs.where(keyless)).drop(*names)
    if tag is not None:
        docs = docs.withColumn(BATCH_ID, F.lit(tag))
    outcome.tables.append(feed.entity)
    if mode is Mode.BULK:
        tables.append(outcome.metrics.rows(docs, feed.entity), feed.entity, key=feed.key)
        return
    _write_rejects(feed, tables, docs.where(keyless), outcome, reports_to, as_of)
    counted = outcome.metrics.rows(docs.where(f"NOT {keyless}"), feed.entity)
    if not tables.exists(feed.entity):
        tables.append(quality.distinct_rows(counted), feed.entity, key=feed.key)
        return
    staged = tables.read(tables.stage(counted, feed.entity))
    _change_flat(feed, tables, staged.select(feed.natural_key).distinct(), quality.distinct_rows(staged))
    tables.drop(f"stage_{feed.entity}")


def _numbered(feed: Feed, table: str) -> bool:
    """Whether the rows of a child table keep their position, and so differ within a document."""
    name = f"{feed.entity}_{table}"
    return name not in feed.projections or keeps(feed.projections.select_list(name, ""), POSITION)


def _write_rejects(feed: Feed, tables: Tables, rows: DataFrame, outcome: Outcome, reports_to, as_of) -> None:
    """Rows without a key, which no table can take; written and counted."""
    if reports_to:
        outcome.rejected = report_path(reports_to, "rejects", feed.entity, as_of)
    else:
        outcome.rejected = f"{tables.location}/{tables.database}/_rejects/{feed.entity}/{uuid.uuid4().hex}"
    outcome.metrics.rows(rows, feed.entity, "rejected_rows").write.mode("overwrite").parquet(outcome.rejected, compression=CODEC)


def _change_flat(feed: Feed, tables: Tables, keys: DataFrame, fresh: DataFrame | None) -> None:
    key, buckets = feed.natural_key, tables.bucket_count(feed.entity)
    bucketed = quality.distinct_rows(keys.selectExpr(f"`{key}`", f"{K.bucket(f'`{key}`', buckets)} AS {BUCKET}"))
    saved, path = materialise(bucketed, tables.work, "keys")
    with tables.changing(feed.entity) as folder:
        tables.apply(folder, [tables.prepare(folder, feed.entity, saved, _buckets_of(saved), fresh)])
    remove(tables.spark, path)


def _buckets_of(keys: DataFrame) -> list[int]:
    """The buckets of a key set: no more than the table has."""
    return sorted(r[0] for r in keys.select(BUCKET).distinct().collect())


def _load_tree(
    feed: Feed, tree: Tree, mode, tables: Tables, read, outcome: Outcome, reports_to, as_of, tag: str | None, copied: Sequence[str]
) -> None:
    metrics = outcome.metrics
    documents = _documents(feed, tree, tables, read)
    tree = documents.tree
    newest = (ROOT_VERSION,) if Versions(feed.on_duplicate_root) is Versions.NEWEST else ()
    carry = ((SOURCE_FILE,) if feed.header else ()) + newest
    every = () if documents.copies is None else (documents.copies,)

    def alone(table: str) -> bool:
        """Whether rows of a table are never equal: those of one document differ by parent and position."""
        return documents.single and not feed.digest_first and table != tree.root.table and _numbered(feed, table)

    def gathers(table: str) -> bool:
        """Whether rows are shuffled as arrays in their parent's row, which holds nothing else then."""
        return mode is Mode.BULK and alone(table) and not tree.children(table)

    def gather(table: str) -> Callable[[DataFrame], DataFrame] | None:
        return (lambda rows: tables.gather(rows, feed.table(table))) if gathers(table) else None

    flat = flatten_from(documents.read, tree, feed.schema, carry, tag or metrics.run_id, documents.version, every, gather)
    shaped = project_tree(flat, tree, feed.projections, feed.entity, metrics.run_id, as_of, feed.header, newest, every)
    volatile = (*VOLATILE, SOURCE_FILE)

    def load(table: str) -> None:
        names = {"rows_kept": "read_count", "rows_repeated": "repeated_rows"}
        observation = metrics.observation(table, names)
        skip = volatile if table == tree.root.table else ()
        written: list[str] = []
        name = feed.table(table)
        if alone(table):
            rows = shaped[table] if every else shaped[table].withColumn(_COPIES, F.lit(1).cast("long"))

            def counted(frame: DataFrame) -> DataFrame:
                return frame.observe(observation, *quality.counts_of_copies(_COPIES))

            tables.create(name, T.StructType([f for f in rows.schema.fields if f.name != _COPIES]))
            if mode is Mode.BULK:
                tables.append(rows, name, drop=[_COPIES], finish=counted, gathered=gathers(table))
            else:
                tables.stage(counted(rows), name, drop=[_COPIES])
            return
        if feed.digest_first:

            def keep(digests: DataFrame) -> DataFrame:
                kept, path = materialise(digests, tables.work, "repeated")
                written.append(path)
                return kept

            rows = quality.dedupe_by_digest(shaped[table], keep, skip, observation, copies=documents.copies)
        else:
            rows = quality.dedupe(shaped[table], skip, observation, documents.copies)
        tables.create(name, rows.schema)
        if mode is Mode.BULK:
            tables.append(rows, name)
        else:
            tables.stage(rows, name)
        for path in written:
            remove(tables.spark, path)

    _each(tree.leaf_first(), load)
    outcome.tables += [feed.table(t) for t in tree.tables]
    _write_rejects(feed, tables, rejects(documents.read(feed.schema, True), tree), outcome, reports_to, as_of)
    for path in (*documents.written, *copied):
        remove(tables.spark, path)
    if mode is Mode.UPSERT:
        apply_upserts(tables, tree, feed.table, outcome, reports_to, as_of, distinct=False, newest=bool(newest))


def apply_upserts(
    tables: Tables,
    tree: Tree,
    name: Callable[[str], str],
    outcome: Outcome,
    reports_to: str | None = None,
    as_of: datetime | None = None,
    distinct: bool = True,
    newest: bool = False,
) -> None:
    """Replace the subtrees of all staged roots, then drop the stage tables.

    ``distinct`` removes repeated stage rows; stages that a run has made have none.
    ``newest`` passes by staged roots whose ``root_version`` is below that of the table;
    they are counted as ``skipped_roots``.
    """
    stage = {t: tables.read(f"stage_{name(t)}") for t in tree.tables}
    root = name(tree.root.table)
    gone = stage[tree.root.table].select(ROOT_KEY).distinct()
    report = None
    if reports_to:
        report = report_path(reports_to, "updates", root, as_of)
    if distinct:
        stage = {t: quality.distinct_rows(align(rows, tables.schema(name(t)))) for t, rows in stage.items()}
    older = None
    if newest:
        found, older = _older_roots(tables, root, stage[tree.root.table])
        outcome.metrics.put("skipped_roots", root, found.count())
        stage = {t: rows.join(found, ROOT_KEY, "left_anti") for t, rows in stage.items()}
        gone = stage[tree.root.table].select(ROOT_KEY).distinct()
    _apply(tables, tree, name, gone, stage, reports.update_counts, report)
    if older is not None:
        remove(tables.spark, older)
    outcome.report = report
    for t in tree.tables:
        tables.drop(f"stage_{name(t)}")


def _older_roots(tables: Tables, root: str, stage: DataFrame) -> tuple[DataFrame, str]:
    """Keys of staged roots that are older than the table's, written once, and where.

    Only the buckets of staged roots are read, and of these only keys and versions; the
    largest version of a key counts, should a bulk load have left several.
    """
    buckets = tables.bucket_count(root)
    keyed = stage.selectExpr(ROOT_KEY, ROOT_VERSION, f"{K.bucket(ROOT_KEY, buckets)} AS {BUCKET}")
    held = tables.in_buckets(root, _buckets_of(keyed)).select(ROOT_KEY, F.col(ROOT_VERSION).alias("__held"))
    held = held.join(keyed.select(ROOT_KEY).distinct(), ROOT_KEY, "left_semi")
    held = held.groupBy(ROOT_KEY).agg(F.max("__held").alias("__held"))
    older = keyed.join(held, ROOT_KEY).where(f"{ROOT_VERSION} < __held").select(ROOT_KEY)
    return materialise(older, tables.work, "older-roots")


def apply_deletes(
    tables: Tables,
    tree: Tree,
    name: Callable[[str], str],
    keys: DataFrame,
    outcome: Outcome,
    reports_to: str | None = None,
    as_of: datetime | None = None,
) -> None:
    """Delete the subtrees of the given natural keys; keys without a root are reported."""
    root = name(tree.root.table)
    report = None
    if reports_to:
        report = report_path(reports_to, "deletes", root, as_of)
        outcome.unmatched = report_path(reports_to, "deletes", f"unmatched_{root}", as_of)
        write_rows(links.unmatched_keys(keys, tables.read(root), tree.key), outcome.unmatched)
    _apply(tables, tree, name, links.root_keys(keys, tree), None, reports.delete_counts, report)
    outcome.report = report


def _apply(tables: Tables, tree: Tree, name, gone: DataFrame, stage, counts, report) -> None:
    """Write the new rows of every table's touched buckets aside, then make them visible.

    The key set is written once, as it is used by each table.  All new rows exist
    before the first table changes; then all tables change side by side.  A run that
    dies in between is finished by the next run of these tables, and repeating it
    from the same batch gives the wanted tables.
    """
    buckets = tables.bucket_count(*[name(t) for t in tree.tables])
    bucketed = gone.selectExpr("*", f"{K.bucket(ROOT_KEY, buckets)} AS {BUCKET}")
    keys, path = materialise(bucketed, tables.work, "root-keys")
    touched = _buckets_of(keys)

    if report is not None:
        old = {t: tables.in_buckets(name(t), touched) for t in tree.tables}
        write_summary(counts(links.links_by_root(old, keys, tree), tree), report)

    with tables.changing(name(tree.root.table)) as folder:

        def prepare(table: str):
            return tables.prepare(folder, name(table), keys, touched, None if stage is None else stage[table])

        tables.apply(folder, _each(tree.leaf_first(), prepare))
    remove(tables.spark, path)


def _delete(feed: Feed, tables: Tables, read, outcome: Outcome, reports_to, as_of) -> None:
    if not feed.delete_path:
        raise ValueError(f"{feed.entity} has no delete_path")
    keys = delete_keys(read(feed.schema, True), feed.delete_path, feed.natural_key)
    if feed.tree is None:
        _change_flat(feed, tables, links.distinct_keys(keys, feed.natural_key), None)
        outcome.tables.append(feed.entity)
        return
    apply_deletes(tables, feed.tree, feed.table, keys, outcome, reports_to, as_of)
    outcome.tables += [feed.table(t) for t in feed.tree.tables]


def _each(names: Iterable[str], work: Callable) -> list:
    """Run the independent writes of one batch side by side."""
    with ThreadPoolExecutor(PARALLEL_WRITES) as pool:
        return list(pool.map(work, names))


def load_csv(
    spark: SparkSession,
    source: str,
    landing: str,
    feed: str,
    table: str,
    tables: Tables,
    run_id: str,
    transforms: Mapping[str, CsvTransform] | None = None,
    columns: Sequence[str] | None = None,
) -> Outcome:
    """Convert a CSV feed to Parquet at ``landing`` and append its rows to a table.

    CSV feeds are not projected: their transform already gives the table's columns.
    Damaged lines are written beside the landing folder (``Outcome.rejected``) and counted.
    """
    outcome = Outcome(Metrics(run_id), [table])
    rejects = f"{landing.rstrip('/')}-rejects/{uuid.uuid4().hex}"
    rows = csv_to_parquet(spark, source, landing, feed, run_id, transforms, columns, outcome.metrics, rejects)
    if exists(spark, rejects):
        outcome.rejected = rejects
    tables.append(outcome.metrics.rows(rows, table), table)
    return outcome
