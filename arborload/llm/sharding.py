"""Sharding by balanced label propagation."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborload.llm.shared import numbered, require, settle, shared_table, text_key

SHARDS = 40
# Askers of a round over the fewest of a round before, above which it counts as idle.
LEAST_PROGRESS = 0.95
# A round that moves less than one of so many linked rows is idle too.
LEAST_MOVED = 1000
# A group moves as a whole if a shard holds so many of its size.
SMALL = 8
BUCKET_ROWS = 100_000


def _shard_counts(rows: DataFrame) -> dict[int, int]:
    """Rows per shard: as many rows reach the driver as there are shards."""
    return {r["shard"]: r["count"] for r in rows.groupBy("shard").count().collect()}


def _by_shard(values: list) -> Column:
    """A column with the value of each row's shard."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("shard") + 1)


def _drawn(*parts) -> Column:
    """A number in [0, 1) hashed from the parts."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 32)) / F.lit(float(1 << 32))


def _small(capacity: int) -> Column:
    """Whether a group is small beside a shard, so that it moves as a whole."""
    return F.col("total") * SMALL <= capacity


def _moves(state: DataFrame, slack: list[int], capacity: int, number: int) -> DataFrame:
    """Which groups want to leave which shards, and where to.

    A group wants to be in the shards that could hold most of its documents, with
    ``slack`` rows that may come in: a small group in one, a larger one in as few as
    hold all.  Ties are drawn anew in every round.  A group and shard are one row, so a group's rows are at most as many as there are shards,
    however many documents it has.
    """
    votes = state.groupBy("key", "shard").agg(F.count(F.lit(1)).alias("n"))
    total = F.sum("n").over(Window.partitionBy("key"))
    votes = votes.withColumn("slack", _by_shard(slack)).withColumn("total", total)
    holds = F.col("n") + F.least(F.col("slack"), F.col("total") - F.col("n"))
    strongest = Window.partitionBy("key").orderBy(holds.desc(), F.desc("n"), F.xxhash64(F.lit(number), "key", "shard"), "shard")
    before = F.coalesce(F.sum(F.col("n") + F.col("slack")).over(strongest.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    first = F.row_number().over(strongest) == 1
    ranked = votes.withColumn("stays", F.when(_small(capacity), first).otherwise(before < F.col("total")))
    wanted = F.when(F.col("stays") & (F.col("slack") > 0), F.struct("shard", "slack"))
    targets = F.array_sort(F.collect_list(wanted).over(Window.partitionBy("key")))
    moving = ranked.withColumn("targets", targets).where(~F.col("stays") & (F.size("targets") > 0))
    return moving.select(F.col("key").alias("__key"), F.col("shard").alias("__from"), "n", "total", "targets")


def _chances(asked: np.ndarray, room: np.ndarray) -> np.ndarray:
    """The share of its askers that each shard lets in, as many as it can in balance.

    ``asked`` holds the rows that want to go from a shard (row) to another (column).
    What a shard lets in is at most its room and what leaves it, so that full shards
    exchange rows; an overfull one has negative room.  The largest such shares are what
    is left when all begin at 1 and each is lowered to what the others allow.
    """
    into = np.maximum(asked.sum(axis=0), 1e-9)
    chance = np.ones(len(room))
    while True:
        lower = np.clip((room + asked @ chance) / into, 0.0, chance)
        if np.max(chance - lower) < 1e-3:
            return lower
        chance = lower


def propagate(linked: DataFrame, shards: int, capacity: int) -> tuple[DataFrame, dict[int, int]]:
    """Move linked documents towards the shards of their neighbours; also returns the loads.

    ``linked`` has ``doc_id``, ``key`` (equal for neighbours) and ``shard``.  In every
    round each group names the shards that could hold most of its documents, and those
    in other shards ask to move there.  A shard lets in as many as it has room for and
    as leave it in the same round, so shards without room exchange rows; if more ask,
    each is let in with the probability that keeps the balance, drawn from its hash: a
    small group is let in or not as a whole, a larger one row by row.  Rounds end when
    nobody asks, or after two idle ones in a row: the askers have hardly become fewer,
    or almost nothing moves.
    """
    state = settle(linked)
    loads = _shard_counts(state)
    leaving = [capacity] * shards
    fewest, idle, number = math.inf, 0, 0
    while True:
        room = [capacity - loads.get(s, 0) for s in range(shards)]
        moves = settle(_moves(state, [max(0, room[s]) + leaving[s] for s in range(shards)], capacity, number))
        spread = F.aggregate("targets", F.lit(0).cast("long"), lambda a, t: a + t["slack"])
        shares = moves.withColumn("all_slack", spread).withColumn("t", F.explode("targets"))
        asking = shares.groupBy("__from", "t.shard").agg(F.sum(F.col("n") * F.col("t.slack") / F.col("all_slack")).alias("n"))
        asked = np.zeros((shards, shards))
        for r in asking.collect():
            asked[r["__from"], r["shard"]] = r["n"]
        chance = _chances(asked, np.array(room, dtype=float))
        little = (asked @ chance).sum() * LEAST_MOVED < sum(loads.values())
        idle = idle + 1 if little or asked.sum() > LEAST_PROGRESS * fewest else 0
        if not asked.any() or idle == 2:
            return state, loads
        fewest, number = min(fewest, asked.sum()), number + 1
        leaving = [int(n) for n in np.ceil(asked @ chance)]
        joined = state.join(moves, (F.col("key") == F.col("__key")) & (F.col("shard") == F.col("__from")), "left")
        place = _drawn(F.lit(number), F.lit("place"), "key", "doc_id", "size") * spread
        passed = F.aggregate(
            "targets",
            F.struct(F.lit(0).cast("long").alias("upto"), F.lit(-1).alias("shard")),
            lambda a, t: F.struct(
                (a["upto"] + t["slack"]).alias("upto"),
                F.when((a["shard"] < 0) & (place < a["upto"] + t["slack"]), t["shard"]).otherwise(a["shard"]).alias("shard"),
            ),
        )["shard"]
        target = F.col("__target")
        alone = _drawn(F.lit(number), F.lit("lot"), "key", "doc_id", "size")
        together = _drawn(F.lit(number), F.lit("lot"), "key")
        lot = F.when(_small(capacity), together).otherwise(alone)
        share = F.element_at(F.array(*[F.lit(float(c)) for c in chance]), F.greatest(target, F.lit(0)) + 1)
        let_in = (target >= 0) & (lot < share)
        moved = joined.withColumn("__target", F.coalesce(passed, F.lit(-1)))
        # A file and no checkpoint, which would hand on constraints that double with every round.
        state = shared_table(
            moved.withColumn("shard", F.when(let_in, target).otherwise(F.col("shard"))).select(*linked.columns), "linked"
        )
        loads = _shard_counts(state)


def assigned(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """A shard and a slot for every document, shard sizes at most one row apart.

    Documents with equal texts are neighbours.  They begin in hash-drawn shards and
    are moved together by ``propagate`` within the size of a shard; what exceeds it in
    the end is released.  Released documents and those without a neighbour, which cut
    no edge wherever they are, fill the shards to their exact sizes in hash order.

    Returns ``doc_id``, ``size`` (UTF-8 bytes of the text and 16), ``text_crc32``
    (unsigned), ``law`` (``rows``), ``shard``, ``slot`` (from 0 without gaps inside a
    shard), ``grown_shard`` (NULL under this law) and ``linked`` (whether it has a
    neighbour).  A NULL text has size 16 and the checksum of an empty text, but its
    only neighbours are other NULL texts.  NULL ids and repeated rows are documents
    like any other.  With fewer documents than shards some shards stay empty.
    """
    require(docs, "doc_id", "text")
    text = F.coalesce("text", F.lit(""))
    rows = settle(
        docs.select(
            "doc_id",
            (F.octet_length(text) + 16).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            text_key(F.col("text")).alias("key"),
        )
    )
    count = rows.count()
    targets = [count // shards + (s < count % shards) for s in range(shards)]
    # Settled, so that the joins below have a shuffle on both sides and Spark can split a hot text.
    groups = settle(rows.groupBy("key").count().where("count > 1").select("key"))
    order = ["key", "doc_id", "size", "text_crc32"]
    begin = F.pmod(F.xxhash64(F.lit(-1), "doc_id", "key"), F.lit(shards)).cast("int")
    linked = rows.join(groups, "key", "left_semi").withColumn("shard", begin)
    placed, loads = propagate(linked.select("doc_id", "size", "text_crc32", "key", "shard"), shards, count // shards)
    in_shard = max(1, math.ceil(count / shards / BUCKET_ROWS))
    ranked = numbered(placed, ["shard"], order, in_shard, "slot")
    kept = ranked.where(F.col("slot") < _by_shard(targets))
    loads = {s: min(loads.get(s, 0), targets[s]) for s in range(shards)}
    released = ranked.where(F.col("slot") >= _by_shard(targets)).select(*order, F.lit(True).alias("linked"))
    single = rows.join(groups, "key", "left_anti").select(*order, F.lit(False).alias("linked"))
    free = released.unionByName(single)
    starts, total = [], 0
    for s in range(shards):
        starts.append(total)
        total += targets[s] - loads[s]
    dealt = numbered(free, [], order + ["linked"], max(64, math.ceil(count / BUCKET_ROWS)), "__at")
    # A shard that needs no more begins where the next one does, so the last start that is not after counts.
    shard = F.size(F.filter(F.array(*[F.lit(x).cast("long") for x in starts]), lambda x: x <= F.col("__at"))) - 1
    filled = dealt.withColumn("shard", shard).withColumn(
        "slot", F.col("__at") - _by_shard(starts) + _by_shard([loads[s] for s in range(shards)])
    )
    columns = ["doc_id", "size", "text_crc32", "shard", "slot", "linked"]
    both = kept.withColumn("linked", F.lit(True)).select(*columns).unionByName(filled.select(*columns))
    return both.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"),
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "linked",
    )
