"""SimHash near-dedup with pigeonring filtering."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborload.llm.graph import components
from arborload.llm.shared import require, settle, ship, text_key

SEED = 42
SEGMENTS = 7
#: Fingerprints of one bucket that a task holds and compares; larger ones are linked through midpoints.
DENSE = 16384
_SMALL = 16


def segment_masks(segments: int = SEGMENTS) -> list[int]:
    """64 bits cut into consecutive segments, as even as possible."""
    edges = [64 * i // segments for i in range(segments + 1)]
    return [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:])]


def key_masks(distance: int, segments: int = SEGMENTS) -> list[int]:
    """Masks of which two fingerprints within ``distance`` agree on at least one.

    At most ``distance`` segments can differ, so every choice of the others is a key.
    """
    if not 0 <= distance < segments:
        raise ValueError("distance must be smaller than the number of segments")
    masks = segment_masks(segments)
    return [sum(masks[i] for i in chosen) for chosen in combinations(range(segments), segments - distance)]


def fingerprint(text: str | None, words: int = 4) -> int:
    """SimHash of the word shingles of a whole text; 0 without a word."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    if len(found) < words:
        shingles = [b" ".join(found)]
    else:
        line = b" ".join(found)
        ends = np.cumsum([len(w) + 1 for w in found])
        starts = np.concatenate(([0], ends[:-1]))
        shingles = [line[a:b] for a, b in zip(starts[: len(found) - words + 1].tolist(), (ends[words - 1 :] - 1).tolist())]
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(shingles), 1 << 15):
        part = shingles[at : at + (1 << 15)]
        hashes = np.fromiter((digest(s, SEED) for s in part), dtype="<u8", count=len(part))
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(shingles)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, words: int = 4) -> DataFrame:
    """``doc_id``, the key of the text and the signed fingerprint of every row."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t, words) for t in batch.column(2).to_pylist()]
            signed = np.array(prints, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(signed)], ["doc_id", "key", "print"])

    rows = docs.select("doc_id", text_key(F.col("text")).alias("key"), F.col("text"))
    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(hashed, f"doc_id {kind}, key string, print long")


def chained(differing: np.ndarray, distance: int, segments: int = SEGMENTS) -> np.ndarray:
    """The pigeonring filter on XORs of fingerprints.

    If the segments on a ring differ in at most ``distance`` bits in all, there is a
    segment from which every chain of l consecutive segments differs in at most
    ``l * distance / segments`` bits.  A pair without such a start can be dropped.
    """
    counts = [np.bitwise_count(differing & np.uint64(m)) for m in segment_masks(segments)]
    found = np.zeros(len(differing), dtype=bool)
    for start in range(segments):
        total = counts[start].copy()
        holds = total <= distance // segments
        for length in range(2, segments + 1):
            if not holds.any():
                break
            total += counts[(start + length - 1) % segments]
            holds &= total <= length * distance // segments
        found |= holds
    return found


def near(differing: np.ndarray, distance: int, segments: int = SEGMENTS) -> np.ndarray:
    """Whether XORs have at most ``distance`` bits: first the chains, then the full count."""
    result = np.zeros(len(differing), dtype=bool)
    left = np.flatnonzero(chained(differing, distance, segments))
    result[left] = np.bitwise_count(differing[left]) <= distance
    return result


def _forest(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index that each of ``size`` nodes reaches over the links a-b."""
    label = np.arange(size)
    while len(a):
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _small_buckets(keys: np.ndarray, prints: np.ndarray, distance: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join each bucket's near fingerprints, at most one per fingerprint."""
    found_a, found_b = [], []
    rows = np.arange(len(keys))
    for lag in range(1, len(keys)):
        rows = rows[rows + lag < len(keys)]
        rows = rows[keys[rows] == keys[rows + lag]]
        if not len(rows):
            break
        hit = near(prints[rows] ^ prints[rows + lag], distance, segments)
        found_a.append(rows[hit])
        found_b.append(rows[hit] + lag)
    if not found_a:
        return prints[:0], prints[:0]
    label = _forest(len(keys), np.concatenate(found_a), np.concatenate(found_b))
    moved = np.flatnonzero(label != np.arange(len(keys)))
    return prints[moved], prints[label[moved]]


def _large_bucket(prints: np.ndarray, distance: int, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for one bucket: each fingerprint is linked to the one that found it."""
    left, links = prints, []
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            one = frontier.pop()
            hit = near(left ^ one, distance, segments)
            new, left = left[hit], left[~hit]
            links.append((new, np.full(len(new), one, dtype=np.uint64)))
            frontier.extend(new)
    if not links:
        return prints[:0], prints[:0]
    return np.concatenate([x for x, _ in links]), np.concatenate([x for _, x in links])


def _bucket_links(distance: int, segments: int, dense: int):
    """Task over rows sorted by bucket key: links inside buckets, dense buckets' rows flagged."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(u: np.ndarray, v: np.ndarray, is_dense: bool) -> pa.RecordBatch:
            flags = np.full(len(u), is_dense)
            return pa.RecordBatch.from_arrays(
                [pa.array(u.view(np.int64)), pa.array(v.view(np.int64)), pa.array(flags)], ["u", "v", "dense"]
            )

        keys, prints = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        flowing = None  # key of a bucket that is too large to hold

        def settle_rows(keys: np.ndarray, prints: np.ndarray) -> Iterator[pa.RecordBatch]:
            cuts = np.flatnonzero(np.diff(keys)) + 1
            starts, ends = np.concatenate(([0], cuts)), np.concatenate((cuts, [len(keys)]))
            sizes = ends - starts
            small = np.repeat((sizes > 1) & (sizes <= _SMALL), sizes)
            yield out(*_small_buckets(keys[small], prints[small], distance, segments), False)
            for i in np.flatnonzero(sizes > _SMALL):
                yield out(*_large_bucket(prints[starts[i] : ends[i]], distance, segments), False)

        for batch in batches:
            k = batch.column(0).to_numpy(zero_copy_only=False)
            p = batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            if flowing is not None:
                same = k == flowing
                if same.any():
                    yield out(p[same], p[same], True)
                    k, p = k[~same], p[~same]
                if len(k):
                    flowing = None
            if not len(k):
                continue
            keys, prints = np.concatenate((keys, k)), np.concatenate((prints, p))
            last = int(np.searchsorted(keys, keys[-1], side="left"))
            if last:
                yield from settle_rows(keys[:last], prints[:last])
                keys, prints = keys[last:], prints[last:]
            if len(keys) > dense:
                flowing = keys[0]
                yield out(prints, prints, True)
                keys, prints = keys[:0], prints[:0]
        if len(keys):
            yield from settle_rows(keys, prints)

    return linked


def _midpoint_links(dense: DataFrame, distance: int) -> DataFrame:
    """Links of fingerprints in dense buckets, without comparing pairs.

    Every fingerprint is spread to the points within half of ``distance``, rounded up;
    those within half, rounded down, are its near points.  Fingerprints within
    ``distance`` share a point that is near to one of them, and a fingerprint is
    within ``distance`` of all that are near to a point of its own.  So each is linked
    to the smallest fingerprint near to each of its points.
    """
    near_side = distance // 2
    flips = [(sum(1 << b for b in c), r) for r in range(distance - near_side + 1) for c in combinations(range(64), r)]

    def points(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flipped = np.array([f for f, _ in flips], dtype=np.uint64)
        close = pa.array(np.array([r <= near_side for _, r in flips]))
        for batch in batches:
            for one in batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64):
                own = np.full(len(flipped), one).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((flipped ^ one).view(np.int64)), pa.array(own), close], ["point", "print", "close"]
                )

    spread = dense.mapInArrow(points, "point long, print long, close boolean")
    least = spread.where("close").groupBy("point").agg(F.min("print").alias("v"))
    return spread.join(least, "point").select(F.col("print").alias("u"), "v").where("u != v").distinct()


def links(prints: DataFrame, distance: int = 4, segments: int = SEGMENTS, dense: int = DENSE) -> DataFrame:
    """Links ``u``-``v`` whose components are those of all pairs within ``distance`` bits.

    ``prints`` has distinct fingerprints in ``print``.  A task gets whole buckets of
    fingerprints that agree on a key, checks them by chains and then in full, and
    returns a spanning forest of each bucket.  Buckets of more than ``dense``
    fingerprints are neither held nor compared: they go through midpoints, which is
    linear in their size.
    """
    ship(prints.sparkSession)
    masks = [m - (1 << 64) if m >> 63 else m for m in key_masks(distance, segments)]
    keys = F.array(*[F.xxhash64(F.lit(i), F.col("print").bitwiseAND(F.lit(m))) for i, m in enumerate(masks)])
    rows = prints.select(F.explode(keys).alias("bucket"), "print").repartition("bucket").sortWithinPartitions("bucket")
    found = settle(rows.mapInArrow(_bucket_links(distance, segments, dense), "u long, v long, dense boolean"))
    edges = found.where("NOT dense").select("u", "v")
    crowded = found.where("dense")
    if crowded.isEmpty():
        return edges
    return edges.unionByName(_midpoint_links(crowded.select(F.col("u").alias("print")).distinct(), distance))


def grouped(docs: DataFrame, words: int = 4, distance: int = 4, segments: int = SEGMENTS, dense: int = DENSE) -> DataFrame:
    """Fingerprint and group of every document.

    Returns ``doc_id``, ``key`` (of the text), ``fingerprint`` (16 hexadecimal digits)
    and ``component_id``, the smallest ``doc_id`` among the documents reachable over
    fingerprints within ``distance`` bits.  Every row of the input gives one row, so
    repeated rows stay.  NULL, empty and blank texts have fingerprint zero, which
    links like any other.  A NULL ``doc_id`` is never the smallest; a group that has
    no other gets NULL.  An empty table gives an empty table.
    """
    require(docs, "doc_id", "text")
    ship(docs.sparkSession)
    rows = settle(fingerprints(docs, words))
    nodes = rows.groupBy("print").agg(F.min("doc_id").alias("least"))
    found = components(links(nodes.select("print"), distance, segments, dense))
    rooted = nodes.join(found.withColumnRenamed("node", "print"), "print", "left").withColumn(
        "root", F.coalesce("root", "print")
    )
    # Settled, so that both sides of the join come from a shuffle and Spark can split a large group.
    smallest = settle(rooted.groupBy("root").agg(F.min("least").alias("component_id")))
    named = rooted.join(smallest, "root").select("print", "root", "component_id")
    return rows.join(named, "print").select(
        "doc_id",
        "key",
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
        "root",
    )


def deduplicated(docs: DataFrame, words: int = 4, distance: int = 4, segments: int = SEGMENTS, dense: int = DENSE) -> DataFrame:
    """One document of every group, with all columns of ``docs``.

    The document with the smallest ``doc_id`` stays (NULL comes last; among equal ids
    the smallest text digest, among equal texts any one row).
    """
    groups = grouped(docs, words, distance, segments, dense)
    ranked = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("key"))
    first = groups.groupBy("root").agg(F.min(ranked).alias("first"))
    chosen = first.select(F.col("first.doc_id").alias("__doc"), F.col("first.key").alias("__key")).distinct()
    keyed = docs.withColumn("__text", text_key(F.col("text")))
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__text") == F.col("__key"))
    kept = keyed.join(chosen, same, "left_semi")
    return kept.dropDuplicates(["doc_id", "__text"]).select(*[F.col(f"`{c}`") for c in docs.columns])
