"""Mixture-controlled packing by deficit round-robin over source queues."""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arborload.llm.shared import require, settle, shared_table, ship
from arborload.llm.tokens import encoder

SEQUENCE = 1024
WINDOW = 64 * SEQUENCE
END = 0
_ONE = 1 << 16  # quanta are held in 65,536ths of a token
_CHUNK = 4096  # rounds that one row stands for while they are spread over tasks


def tokenized(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Ids of every document and its place in its task's queue of its source.

    ``start`` is the number of tokens before the document in the queue of its
    ``part`` (the task) and ``source``; the closing id counts.  Ids take two bytes
    where the vocabulary allows.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        model = encoder(tokenizer)
        kind = np.dtype("<u2" if model.size <= 1 << 16 else "<u4")
        filled: dict[str | None, int] = {}
        for batch in batches:
            sources, texts = batch.column(1).to_pylist(), batch.column(2)
            start, count, ids = [], [], []
            for source, text in zip(sources, texts):
                found = np.append(model.ids(text.as_py() or ""), np.uint32(END)).astype(kind)
                start.append(filled.get(source, 0))
                count.append(len(found))
                filled[source] = start[-1] + len(found)
                ids.append(found.tobytes())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(np.full(len(count), part, dtype=np.int64)),
                    pa.array(start, pa.int64()),
                    pa.array(count, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                ["doc_id", "source", "part", "start", "tokens", "ids"],
            )

    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), "text")
    kind = dict(rows.dtypes)["doc_id"]
    schema = f"doc_id {kind}, source string, part long, start long, tokens long, ids binary"
    return rows.mapInArrow(encoded, schema)


def round_of(position: int, quantum: int) -> int:
    """The round in which a queue sends its token at ``position``."""
    return ((position + 1) * _ONE - 1) // quantum


def sent(k: int, quantum: int) -> int:
    """Tokens that a queue which has not run out has sent before round ``k``.

    This is deficit round-robin in closed form.  In a round a queue is given its quantum
    and sends whole tokens up to what it has been given and not yet sent; the fraction
    left is the deficit that it carries on.  So any task can place any token of a queue
    without running the rounds before it.  A round is one window.
    """
    return k * quantum // _ONE


def queues(parts: DataFrame, window: int, temperature: float, proportions: Mapping[str, float] | None) -> DataFrame:
    """Size, quantum and first round of every source's queue.

    Target proportions are the given ones, or ``tokens ** temperature``.  Sources whose
    proportion is zero or not given come after all others have run out, by ``tokens **
    temperature`` among themselves.  Written once: quanta must not change when a task is
    repeated.
    """
    totals = parts.groupBy("source").agg(F.sum("n").alias("n"))
    power = F.pow(F.col("n").cast("double"), F.lit(temperature))
    if proportions is None:
        weighed = totals.select("*", power.alias("weight"), F.lit(0).alias("turn"))
    else:
        rows = [(k, float(v)) for k, v in proportions.items() if v > 0]
        given = parts.sparkSession.createDataFrame(rows, "__source string, __weight double")
        joined = totals.join(given, F.col("source").eqNullSafe(F.col("__source")), "left")
        some = F.col("__weight").isNotNull()
        weighed = joined.select(
            "source", "n", F.when(some, F.col("__weight")).otherwise(power).alias("weight"), F.when(some, 0).otherwise(1).alias("turn")
        )
    weighed = shared_table(weighed, "weights")
    whole = weighed.groupBy("turn").agg(F.sum("weight").alias("__total"))
    share = F.col("weight") / F.col("__total") * F.lit(float(window) * _ONE)
    given = shared_table(
        weighed.join(F.broadcast(whole), "turn").select(  # at most two rows
            "source", "n", "turn", F.greatest(F.lit(1), F.round(share).cast("long")).alias("quantum")
        ),
        "quanta",
    )
    rounds = F.expr(f"(n * {_ONE} + quantum - 1) div quantum")
    first = given.where("turn = 0").agg(F.coalesce(F.max(rounds), F.lit(0)).alias("m")).first()[0]
    return given.withColumn("first_round", F.when(F.col("turn") == 0, 0).otherwise(first).cast("long")).drop("turn")


def slices(queued: DataFrame) -> DataFrame:
    """What every queue sends in every window: ``source``, ``window``, ``begin`` and ``size``.

    A queue that is given less than a token a round has a slice per token.  A long queue
    is spread over tasks in chunks of rounds.
    """
    wide = f"quantum >= {_ONE}"
    steps = f"CASE WHEN {wide} THEN (n * {_ONE} + quantum - 1) div quantum ELSE n END"
    chunks = queued.selectExpr("*", f"explode(sequence(0L, ({steps} - 1) div {_CHUNK})) AS chunk").where("n > 0")
    spread = chunks.repartition("source", "chunk")
    each = spread.selectExpr("*", f"explode(sequence(chunk * {_CHUNK}, least((chunk + 1) * {_CHUNK}, {steps}) - 1)) AS i")
    rounds = each.selectExpr("*", f"CASE WHEN {wide} THEN i ELSE ((i + 1) * {_ONE} - 1) div quantum END AS k")
    bounds = rounds.selectExpr(
        "source",
        "first_round + k AS window",
        f"least(n, k * quantum div {_ONE}) AS begin",
        f"least(n, (k + 1) * quantum div {_ONE}) AS stop",
    )
    return bounds.selectExpr("source", "window", "begin", "stop - begin AS size").where("size > 0")


def shifts(sliced: DataFrame) -> DataFrame:
    """What has to be added to a token's place in its queue to get its place among all tokens.

    Inside a window the sources follow each other; the sizes of the windows before are
    summed in two levels, so no task sees all windows.
    """
    before = Window.partitionBy("window").orderBy(F.asc_nulls_first("source")).rowsBetween(Window.unboundedPreceding, -1)
    inside = sliced.withColumn("inside", F.coalesce(F.sum("size").over(before), F.lit(0)))
    sizes = sliced.groupBy("window").agg(F.sum("size").alias("__size")).withColumn("__range", F.expr(f"window div {_CHUNK}"))
    order = Window.partitionBy("__range").orderBy("window").rowsBetween(Window.unboundedPreceding, -1)
    ranges = sizes.groupBy("__range").agg(F.sum("__size").alias("__whole"))
    all_before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # a row per 4,096 windows
    bases = ranges.select("__range", F.coalesce(F.sum("__whole").over(all_before), F.lit(0)).alias("__base"))
    starts = sizes.withColumn("__start", F.coalesce(F.sum("__size").over(order), F.lit(0))).join(bases, "__range")
    joined = inside.join(starts.select(F.col("window").alias("__window"), "__start", "__base"), F.col("window") == F.col("__window"))
    shift = F.col("__base") + F.col("__start") + F.col("inside") - F.col("begin")
    return joined.select(F.col("source").alias("__source"), "__window", shift.alias("shift"))


def packed(
    docs: DataFrame,
    tokenizer: str,
    sequence: int = SEQUENCE,
    window: int = WINDOW,
    temperature: float = 0.7,
    proportions: Mapping[str, float] | None = None,
) -> DataFrame:
    """Pieces of all documents, laid into sequences of ``sequence`` tokens.

    The documents of a source form a queue.  Every window of ``window`` tokens takes
    from each queue its target proportion of tokens, by deficit round-robin with
    deficits carried over windows and over the tasks that hold parts of a queue.  A
    queue that has run out leaves the rounds: later windows are shorter and the
    others keep their proportions to each other.  Windows follow each other without
    a gap and are cut into sequences, so only the last sequence needs padding.  See
    :func:`queues` for the target proportions; any number of sources may have one.

    Returns ``doc_id``, ``source``, ``start``, ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset``, ``window_id`` and ``ids`` (the
    piece's ids, four bytes each).  A document is its ids and a closing id 0; a NULL
    or empty text is that id alone.  NULL ``doc_id`` and ``source`` are kept, NULL
    being a source of its own.  Repeated rows are packed as often as they come.  A
    very long document is cut into many pieces.  An empty table gives no pieces.
    """
    require(docs, "doc_id", "text", "source")
    ship(docs.sparkSession)
    tokens = settle(tokenized(docs, tokenizer))
    parts = shared_table(tokens.groupBy("source", "part").agg(F.sum("tokens").alias("n")), "parts")
    queued = shared_table(queues(parts, window, temperature, proportions), "queues")
    shifted = shared_table(shifts(slices(queued)), "shifts")
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    based = parts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    own = shared_table(
        based.join(queued, based["source"].eqNullSafe(queued["source"])).select(
            based["source"].alias("__source"), F.col("part").alias("__part"), "base", "quantum", "first_round"
        ),
        "bases",
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = 4 if encoder(tokenizer).size > 1 << 16 else 2
        for batch in batches:
            found: dict[str, list] = {c: [] for c in "row window place start length ids".split()}
            firsts, counts, quanta, rounds = (batch.column(i).to_pylist() for i in (2, 3, 4, 5))
            for row, (first, count, quantum, start) in enumerate(zip(firsts, counts, quanta, rounds)):
                raw = batch.column(6)[row].as_py()
                at, end = first, first + count
                while at < end:
                    k = round_of(at, quantum)
                    stop = min(end, sent(k + 1, quantum))
                    found["row"].append(row)
                    found["window"].append(start + k)
                    found["place"].append(at)
                    found["start"].append(at - first)
                    found["length"].append(stop - at)
                    found["ids"].append(raw[(at - first) * width : (stop - first) * width])
                    at = stop
            rows = pa.array(found["row"], pa.int64())
            numbers = [pa.array(found[c], pa.int64()) for c in ("window", "place", "start", "length")]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(i).take(rows) for i in (0, 1, 3)], *numbers, pa.array(found["ids"], pa.binary())],
                "doc_id source doc_tokens window_id place start length ids".split(),
            )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = "<u4" if encoder(tokenizer).size > 1 << 16 else "<u2"
        for batch in batches:
            found: dict[str, list] = {c: [] for c in "row start length crc sequence offset ids".split()}
            places, starts, lengths = (batch.column(i).to_pylist() for i in (4, 5, 6))
            for row, (place, start, length) in enumerate(zip(places, starts, lengths)):
                ids = np.frombuffer(batch.column(7)[row].as_py(), dtype=kind).astype("<u4")
                at = 0
                while at < length:
                    size = min(length - at, sequence - place % sequence)
                    piece = ids[at : at + size].tobytes()
                    found["row"].append(row)
                    found["start"].append(start + at)
                    found["length"].append(size)
                    found["crc"].append(zlib.crc32(piece))
                    found["sequence"].append(place // sequence)
                    found["offset"].append(place % sequence)
                    found["ids"].append(piece)
                    at += size
                    place += size
            rows = pa.array(found["row"], pa.int64())
            numbers = {c: pa.array(found[c], pa.int64()) for c in ("start", "length", "crc", "sequence", "offset")}
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(rows),
                    batch.column(1).take(rows),
                    numbers["start"],
                    numbers["length"],
                    numbers["crc"],
                    batch.column(2).take(rows),
                    numbers["sequence"],
                    numbers["offset"],
                    batch.column(3).take(rows),
                    pa.array(found["ids"], pa.binary()),
                ],
                "doc_id source start length ids_crc32 doc_tokens sequence_id offset window_id ids".split(),
            )

    same = F.col("source").eqNullSafe(F.col("__source"))
    placed = tokens.join(own, same & (F.col("part") == F.col("__part")), "inner").select(
        "doc_id", "source", (F.col("base") + F.col("start")).alias("first"), "tokens", "quantum", "first_round", "ids"
    )
    kind = dict(docs.dtypes)["doc_id"]
    cuts = placed.mapInArrow(
        cut, f"doc_id {kind}, source string, doc_tokens long, window_id long, place long, start long, length long, ids binary"
    )
    # Always a shuffle: the table grows with the windows, and no key has more than a window's tokens.
    laid = cuts.join(shifted.hint("merge"), same & (F.col("window_id") == F.col("__window")), "inner").select(
        "doc_id", "source", "doc_tokens", "window_id", (F.col("place") + F.col("shift")).alias("place"), "start", "length", "ids"
    )
    return laid.mapInArrow(
        pieces,
        f"doc_id {kind}, source string, start long, length long, ids_crc32 long, doc_tokens long,"
        " sequence_id long, offset long, window_id long, ids binary",
    )
