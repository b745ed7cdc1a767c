"""Filter interaction audit: what each filter removes in every order, from one stream over the files.

Files arrive as micro-batches.  Four of the five filters judge a text on its own and give
it a mask of failed filters; the fifth, "a copy of a smaller id", depends on all rows.  State
keyed by text keeps the smallest id seen so far.  When a smaller one arrives, the mask
counted for the earlier holder is retracted from its part's counters and counted again as
that of a copy.  Every batch writes its changes of the counters under its own number, so
a repeated batch replaces what it wrote.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from arborload.llm.shared import SPACE, require, shared_dir, shared_table, ship

FILTERS = "ABCDE"
MIN_WORDS = 200
DISTINCT_PERCENT = 50
CAPITAL_PERCENT = 3
MARKS = "#$%&*|"
COPY = 1 << FILTERS.index("E")
MASKS = 1 << len(FILTERS)
GOOD, TOXIC = 1, 2
BATCHES = 4
NULL_SPREAD = 64
#: A state holds the texts of one bucket of hashes: one for so many bytes of files, and several per task.
BUCKET_BYTES = 1 << 18
TASK_BUCKETS = 16

_CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
_TRAIL = bytes(range(0x80, 0xC0))
#: Settings of a query whose state may outgrow the memory of the executors.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "64",
    "spark.sql.streaming.stateStore.rocksdb.writeBufferSizeMB": "1",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.unloadOnCommit": "true",
}


def own_mask(data: bytes) -> int:
    """The filters A to D that a text in UTF-8 fails, as bits."""
    words = data.split()
    marks = data.translate(None, MARKS.encode())
    return (
        (len(words) < MIN_WORDS)
        | (100 * len(set(words)) < DISTINCT_PERCENT * len(words)) << 1
        | (100 * (len(data) - len(data.translate(None, _CAPITALS))) > CAPITAL_PERCENT * len(data.translate(None, _TRAIL))) << 2
        | (len(marks) < len(data)) << 3
    )


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal rows of a batch as one, with key and mask of their text in place of the text."""
    for batch in batches:
        ids, texts, parts = (batch.column(i).to_pylist() for i in range(3))
        rows: Counter = Counter()
        for doc, text, part in zip(ids, texts, parts):
            data = (text or "").encode("utf-8", "surrogatepass")
            rows[hashlib.md5(data).digest(), own_mask(data), doc, part or ""] += 1
        keys = list(rows)
        columns = [[k[i] for k in keys] for i in range(4)]
        types = [pa.binary(), pa.int32(), batch.schema.field(0).type, pa.string()]
        arrays = [pa.array(c, t) for c, t in zip(columns, types)]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array(list(rows.values()), pa.int64())], ["key", "mask", "doc", "part", "n"])


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per text only the rows of the batch's smallest id keep it; the others are copies whatever comes.

    Copies need no state.  They are counted together and get a key of their own, so they
    don't meet in the bucket of their text.
    """
    for batch in batches:
        rows = list(zip(*[c.to_pylist() for c in batch.columns]))
        least: dict = {}
        for key, _, doc, *_ in rows:
            if doc is not None and (key not in least or doc < least[key]):
                least[key] = doc
        out: Counter = Counter()
        for key, mask, doc, part, flags, n in rows:
            if doc is not None and doc != least[key]:
                spread = hashlib.md5(f"{flags} {mask} {part}".encode("utf-8", "surrogatepass") + rows[0][0]).digest()
                out[spread, mask, None, part, flags, True] += n
            else:
                out[key, mask, doc, part, flags, False] += n
        keys = list(out)
        arrays = [pa.array([k[i] for k in keys], batch.schema.field(i).type) for i in range(5)]
        arrays += [pa.array([k[5] for k in keys], pa.bool_()), pa.array(list(out.values()), pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, [*batch.schema.names[:5], "copy", "n"])


def changes(held: tuple | None, rows: list[tuple], delta: Counter) -> tuple | None:
    """New state of a text; adds what changes in the counters by part, mask and flags.

    ``held`` is the smallest id with its rows as (part, flags, n); ``rows`` are (mask,
    id, part, flags, copy, n).  Several rows may share the smallest id: none of them is
    a copy.  Rows without an id are no copies and make none.
    """
    smallest = min((r[1] for r in rows if r[1] is not None), default=None)
    if held is not None and (smallest is None or held[0] <= smallest):
        smallest = held[0]
    holders: Counter = Counter()
    if held is not None:
        if held[0] == smallest:
            holders.update({(part, flags): n for part, flags, n in held[1]})
        else:
            for part, flags, n in held[1]:
                delta[part, rows[0][0], flags] -= n
                delta[part, rows[0][0] | COPY, flags] += n
    for mask, doc, part, flags, copy, n in rows:
        later = copy or (doc is not None and doc != smallest)
        delta[part, mask | COPY if later else mask, flags] += n
        if doc is not None and not later:
            holders[part, flags] += n
    return None if smallest is None else (smallest, [(*k, n) for k, n in holders.items()])


def _retracting(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Changes of the counters by the texts of one bucket; its state is a row per holder of a text."""
    texts: dict[bytes, list[tuple]] = {}
    for frame in frames:
        docs = [None if gone else doc for doc, gone in zip(frame["doc"].tolist(), frame["absent"].tolist())]
        columns = [frame[c].tolist() for c in ("key", "mask", "part", "flags", "copy", "n")]
        for text, mask, part, flags, copy, n, doc in zip(*columns, docs):
            texts.setdefault(text, []).append((mask, doc, part, flags, copy, n))
    held: dict[bytes, tuple] = {}
    if state.exists:
        for text, doc, *holder in zip(*state.get):
            held.setdefault(bytes(text), (doc, []))[1].append(tuple(holder))
    delta: Counter = Counter()
    for text, rows in texts.items():
        after = changes(held.get(text), rows, delta)
        if after is not None:
            held[text] = after
    lines = [(text, doc, *holder) for text, (doc, holders) in held.items() for holder in holders]
    if lines:
        state.update(tuple(map(list, zip(*lines))))
    yield pd.DataFrame([(*k, n) for k, n in delta.items() if n], columns=["part", "mask", "flags", "n"])


def _source(spark: SparkSession, path: str) -> tuple[str, int]:
    """The path as a file stream takes it, and the bytes of its files.

    File streams take folders and patterns: a single file becomes a pattern for its name.
    """
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    summary = target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target)
    if not summary.getDirectoryCount():
        folder, _, name = path.rstrip("/").rpartition("/")
        path = f"{folder}/{{{name}}}"
    return path, summary.getLength()


def _exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _layout(spark: SparkSession, folder: str, wanted: int) -> int:
    """Number of buckets of the state, chosen at the first run with a folder and kept there."""
    path = f"{folder}/layout"
    if not _exists(spark, path):
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        buckets = max(wanted, TASK_BUCKETS * tasks)
        spark.range(1).select(F.lit(buckets).alias("buckets")).write.parquet(path)
    return spark.read.schema("buckets int").parquet(path).first()[0]


def counted(
    spark: SparkSession,
    path: str,
    labels: DataFrame,
    folder: str,
    batches: int = BATCHES,
    doc_id: str = "doc_id",
    text: str = "text",
    part: str = "lang",
) -> DataFrame | None:
    """Stream the Parquet files at ``path``; counters by part, mask and label flags.

    ``folder`` must be seen by all executors; it holds the checkpoint of the stream and the
    changes of each batch.  A stream that was broken off goes on from it when called
    again with the same folder, and files that came meanwhile are added.  Returns ``None``
    if there has never been a row.
    """
    schema = spark.read.parquet(path).schema
    kind = schema[doc_id].dataType
    name = kind.simpleString()
    wanted = labels.where(F.col(doc_id).isNotNull()).groupBy(F.col(doc_id).alias("__doc"))
    flag = F.max(F.when(F.col("quality") == 1, GOOD).otherwise(0)) + F.max(F.when(F.col("toxic") == 1, TOXIC).otherwise(0))
    flags = shared_table(wanted.agg(flag.alias("flags"), F.lit(0).alias("__salt")), "audit-labels")

    source, size = _source(spark, path)
    stream = (
        spark.readStream.schema(T.StructType([schema[c] for c in dict.fromkeys((doc_id, text, part))]))
        .option("maxBytesPerTrigger", max(1, -(-size // batches)))
        .parquet(source)
        .select(doc_id, F.col(text).cast("string"), F.col(part).cast("string"))
    )
    judged = stream.mapInArrow(_judged, f"key binary, mask int, doc {name}, part string, n long")
    # Rows without an id match no label; the salt keeps them from meeting in one task.
    salt = F.when(F.col("doc").isNull(), F.pmod(F.xxhash64("key"), F.lit(NULL_SPREAD)).cast("int")).otherwise(0)
    rows = (
        judged.withColumn("__own", salt)
        .join(flags, (F.col("doc") == F.col("__doc")) & (F.col("__own") == F.col("__salt")), "left")
        .select("key", "mask", "doc", "part", F.coalesce("flags", F.lit(0)).alias("flags"), "n")
        .mapInArrow(_gathered, f"key binary, mask int, doc {name}, part string, flags int, copy boolean, n long")
    )
    # pandas has no NULL among integers: a column of its own says which ids are absent.
    empty = F.lit("") if isinstance(kind, T.StringType) else F.lit(0)
    rows = rows.withColumn("absent", F.col("doc").isNull()).withColumn("doc", F.coalesce("doc", empty.cast(kind)))
    buckets = _layout(spark, folder, max(1, -(-size // BUCKET_BYTES)))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
    deltas = rows.groupBy("bucket").applyInPandasWithState(
        _retracting,
        "part string, mask int, flags int, n long",
        f"texts array<binary>, docs array<{name}>, parts array<string>, flags array<int>, counts array<long>",
        "update",
        GroupStateTimeout.NoTimeout,
    )
    counters = f"{folder}/counters"

    def write(batch: DataFrame, number: int) -> None:
        total = batch.groupBy("part", "mask", "flags").agg(F.sum("n").alias("n"))
        total.write.mode("overwrite").parquet(f"{counters}/batch={number}")

    before = {name: spark.conf.get(name, None) for name in STATE}
    try:
        for name, value in STATE.items():
            spark.conf.set(name, value)
        query = (
            deltas.writeStream.foreachBatch(write)
            .outputMode("update")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    query.awaitTermination()
    if not _exists(spark, counters):
        return None
    changed = spark.read.schema("part string, mask int, flags int, n long, batch long").parquet(counters)
    return changed.groupBy("part", "mask", "flags").agg(F.sum("n").alias("n"))


def _steps() -> list[tuple[str, int, int, int]]:
    """Every order with each of its steps: the filters before, and the filter's own bit."""
    out = []
    for order in map("".join, itertools.permutations(FILTERS)):
        bits = [1 << FILTERS.index(f) for f in order]
        out += [(order, k + 1, sum(bits[:k]), bits[k]) for k in range(len(bits))]
    return out


def _left(cells: Column) -> Column:
    """For every set of filters, the rows that fail none of them."""
    return F.array(*[sum((cells[m] for m in range(MASKS) if not m & s), F.lit(0).cast("long")) for s in range(MASKS)])


def orders(counters: DataFrame) -> DataFrame:
    """The audit of every part, order and step, from counters by part, mask and flags."""
    cell = {"n": F.lit(True), "good": F.col("flags").bitwiseAND(GOOD) > 0, "toxic": F.col("flags").bitwiseAND(TOXIC) > 0}
    sums = [
        F.array(*[F.sum(F.when((F.col("mask") == m) & c, F.col("n")).otherwise(0)) for m in range(MASKS)]).alias(name)
        for name, c in cell.items()
    ]
    cells = counters.groupBy("part").agg(*sums)
    left = cells.select("part", "n", *[_left(F.col(c)).alias(f"{c}_left") for c in cell])
    plan = _steps()
    numbered = left.select("*", F.explode(F.sequence(F.lit(0), F.lit(len(plan) - 1))).alias("i"))

    def value(at: int, kind: str) -> Column:
        return F.element_at(F.split(F.lit(",".join(str(s[at]) for s in plan)), ","), F.col("i") + 1).cast(kind)

    placed = numbered.select(
        "*", value(0, "string").alias("filter_order"), value(1, "int").alias("step"), value(2, "int").alias("b"), value(3, "int").alias("f")
    )
    after = F.col("b").bitwiseOR(F.col("f"))

    def lost(name: str, before: Column = F.col("b"), then: Column = after) -> Column:
        return F.get(f"{name}_left", before) - F.get(f"{name}_left", then)

    removed = lost("n")
    share = F.lit(0).cast("long")
    for s in range(MASKS):
        size = s.bit_count()
        weight = math.factorial(size) * math.factorial(max(0, len(FILTERS) - 1 - size))
        gone = lost("n", F.lit(s), F.lit(s).bitwiseOR(F.col("f")))
        share = share + F.when(F.col("f").bitwiseAND(s) == 0, gone * weight).otherwise(0)
    return placed.select(
        "part",
        "filter_order",
        "step",
        F.get("n_left", after).alias("kept"),
        removed.alias("removed"),
        (lost("n", F.lit(0), F.col("f")) - removed).alias("redundant"),
        F.get("n", F.col("f")).alias("unique_fails"),
        lost("good").alias("good_lost"),
        lost("toxic").alias("toxic_lost"),
        share.alias("shapley"),
    )


def audited(spark: SparkSession, path: str, labels: DataFrame, folder: str | None = None, **settings) -> DataFrame:
    """Counts of every part, order of the filters A to E and step, for the files at ``path``.

    A: fewer than 200 words; B: under half of the words distinct; C: over 3 % capitals; D:
    a character of ``#$%&*|``; E: the text of a smaller id.  ``kept`` documents are left after
    the step, ``removed`` go in it, ``redundant`` fail its filter but went before,
    ``unique_fails`` fail no other filter; ``good_lost`` and ``toxic_lost`` are the removed
    ones with such a label; ``shapley`` sums what the filter removes over all orders.

    NULL texts and empty ones are equal; a NULL part is the empty string.  Rows that
    share the smallest id of a text are no copies, nor are rows without an id.  A row
    counts as good or toxic if any of its labels says so.  An empty table gives no rows;
    other columns are not read.  See :func:`counted` for ``folder`` and the settings.
    """
    require(labels, "doc_id", "quality", "toxic")
    ship(spark)
    folder = folder or f"{shared_dir(spark)}/corpus/audit-{uuid.uuid4().hex}"
    counters = counted(spark, path, labels, folder, **settings)
    if counters is None:
        counters = spark.createDataFrame([], "part string, mask int, flags int, n long")
    return orders(counters)


def _oracle() -> str:
    letters = ", ".join(f"('{f}', {1 << i})" for i, f in enumerate(FILTERS))
    word = re.sub(r"\[", "[^", SPACE, count=1)
    joins = " JOIN ".join(
        f"letters l{i}" + (" ON " + " AND ".join(f"l{i}.f <> l{j}.f" for j in range(i)) if i else "")
        for i in range(len(FILTERS))
    )
    steps = " UNION ALL ".join(
        f"SELECT {' || '.join(f'l{i}.f' for i in range(5))} AS filter_order, {k + 1} AS step, "
        f"{' + '.join(['0', *[f'l{i}.bit' for i in range(k)]])} AS b, l{k}.bit AS f FROM {joins}"
        for k in range(len(FILTERS))
    )
    return rf"""
    WITH letters(f, bit) AS (VALUES {letters}), steps AS ({steps}),
    flags AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
    texts AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
                     regexp_extract_all(coalesce(text, ''), '{word}') AS words FROM documents),
    masks AS (SELECT doc_id, part,
        (len(words) < {MIN_WORDS})::INT
        + 2 * (100 * len(list_distinct(words)) < {DISTINCT_PERCENT} * len(words))::INT
        + 4 * (100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > {CAPITAL_PERCENT} * length(text))::INT
        + 8 * regexp_matches(text, '[{MARKS}]')::INT
        + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false)::INT AS mask FROM texts),
    cells AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
              FROM masks LEFT JOIN flags USING (doc_id) GROUP BY part, mask),
    audit AS (SELECT part, filter_order, step, f,
        sum(n) FILTER (mask & (b | f) = 0) AS kept,
        sum(n) FILTER (mask & b = 0 AND mask & f > 0) AS removed,
        sum(n) FILTER (mask & b > 0 AND mask & f > 0) AS redundant,
        sum(n) FILTER (mask = f) AS unique_fails,
        sum(good) FILTER (mask & b = 0 AND mask & f > 0) AS good_lost,
        sum(toxic) FILTER (mask & b = 0 AND mask & f > 0) AS toxic_lost
        FROM cells, steps GROUP BY part, filter_order, step, f)
    SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept,
           coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
           coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost,
           coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
           coalesce(sum(removed) OVER (PARTITION BY part, f), 0)::BIGINT AS shapley
    FROM audit"""


ORACLE = _oracle()
