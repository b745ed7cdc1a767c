"""Vector code compression: four codebooks of 256 entries, found by equal-average search.

A part and a codebook entry whose component sums differ by ``g`` are at least ``g * g /
dimension`` apart in squared distance.  Entries sorted by their sums are therefore
looked at outward from a part's own sum, upward and downward, until that bound exceeds
the best distance so far.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborload.llm.shared import require, settle, ship

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
#: Sums over a vector stay below this, so that squares fit 64 bits.
REACH = 1 << 31
_EXACT = 1 << 53
_BLOCK = 8192
_VECTOR = "__vector"


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index and squared distance of the entry nearest to each part; ties to the lower index.

    ``parts`` and ``book`` are integer rows of equal length.
    """
    found, least = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for start in range(0, len(parts), _BLOCK):
        index, distance = _nearest(parts[start : start + _BLOCK], book)
        found.append(index)
        least.append(distance)
    return np.concatenate(found), np.concatenate(least)


def _nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    dimension = max(1, parts.shape[1])
    largest = max([1, *(int(np.abs(a).max()) for a in (parts, book) if a.size)])
    kind = np.float64 if 4 * dimension * dimension * largest * largest < _EXACT else np.int64
    parts, book = parts.astype(kind), book.astype(kind)
    own, sums = parts.sum(axis=1), book.sum(axis=1)
    order = np.argsort(sums, kind="stable")
    book, sums = book[order], sums[order]
    start = np.searchsorted(sums, own)
    best = np.full(len(parts), -1, dtype=kind)
    index = np.full(len(parts), len(book), dtype=np.int64)
    up = down = np.arange(len(parts))
    for step in range(len(book)):
        up = _look(up, start[up] + step, parts, own, book, sums, order, best, index, dimension)
        down = _look(down, start[down] - 1 - step, parts, own, book, sums, order, best, index, dimension)
        if not len(up) and not len(down):
            break
    return index, best.astype(np.int64)


def _look(rows, at, parts, own, book, sums, order, best, index, dimension) -> np.ndarray:
    """Compare rows with the entries at the given places; the rows that go on in this direction."""
    inside = (at >= 0) & (at < len(book))
    rows, at = rows[inside], at[inside]
    gap = own[rows] - sums[at]
    near = (best[rows] < 0) | (gap * gap <= best[rows] * dimension)
    rows, at = rows[near], at[near]
    apart = parts[rows] - book[at]
    distance = np.einsum("ij,ij->i", apart, apart)
    entry = order[at]
    better = (best[rows] < 0) | (distance < best[rows]) | ((distance == best[rows]) & (entry < index[rows]))
    best[rows[better]], index[rows[better]] = distance[better], entry[better]
    return rows


def assign(vectors: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of every part of every vector; a column per part."""
    cut = vectors.reshape(len(vectors), PARTS, -1)
    pairs = [nearest(cut[:, p], books[p]) for p in range(PARTS)]
    return np.stack([i for i, _ in pairs], axis=1), np.stack([d for _, d in pairs], axis=1)


def quantised(frame: DataFrame, vector: str, width: int) -> DataFrame:
    """Vectors as ``floor(1024 * x)``, padded with zeros to ``width`` components."""
    limit = float(REACH // max(1, width))
    whole = F.transform(
        F.col(vector), lambda x: F.floor(F.greatest(F.lit(-limit), F.least(F.lit(limit), x.cast("double") * SCALE)))
    )
    zeros = F.array_repeat(F.lit(0).cast("long"), width - F.size(vector))
    return frame.withColumn(_VECTOR, F.concat(whole, zeros)).drop(vector)


def matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def refined(kept: DataFrame, books: np.ndarray, width: int) -> np.ndarray:
    """Codebooks after one round: sums per entry, first within each task, then over all."""
    size = width // PARTS

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((PARTS, books.shape[1], size), dtype=np.int64)
        counts = np.zeros((PARTS, books.shape[1]), dtype=np.int64)
        for batch in batches:
            vectors = matrix(batch.column(0), width)
            entries, _ = assign(vectors, books)
            cut = vectors.reshape(len(vectors), PARTS, size)
            for p in range(PARTS):
                np.add.at(sums[p], entries[:, p], cut[:, p])
                counts[p] += np.bincount(entries[:, p], minlength=books.shape[1])
        part, entry = np.nonzero(counts)
        places = np.tile(np.arange(size + 1), len(part))
        values = np.concatenate([counts[part, entry][:, None], sums[part, entry]], axis=1).ravel()
        if len(part):
            columns = [np.repeat(part, size + 1), np.repeat(entry, size + 1), places, values]
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["part", "entry", "place", "value"])

    rows = kept.select(_VECTOR).mapInArrow(partial, "part long, entry long, place long, value long")
    totals = rows.groupBy("part", "entry", "place").agg(F.sum("value").alias("value"))
    shifted = np.zeros((PARTS, books.shape[1], size + 1), dtype=np.int64)
    for part, entry, place, value in totals.collect():  # one row per component of the codebooks
        shifted[part, entry, place] = value
    counts = shifted[:, :, :1]
    return np.where(counts > 0, shifted[:, :, 1:] // np.maximum(counts, 1), books)


def checksum(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def compressed(vectors: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """Id, ``code``, ``error``, ``label_error`` and ``codebooks_sha256`` of every usable vector.

    Rows whose vector is NULL or holds a NULL or non-finite component are dropped.  The
    codebook of each part position starts as that part of the 256 smallest ids (NULL
    ids last, equal ids by their vectors), or of all rows if there are fewer.  Four
    rounds move every used entry to the floor of the mean of its parts.  ``code`` has
    two hexadecimal digits per part, ``error`` is the sum of the squared distances,
    ``label_error`` their sum over all rows with the same label, NULLs together.

    Vectors of unequal length are padded with zeros to the longest, rounded up to a
    multiple of four.  Integers beyond ``2 ** 31 / length`` are taken as that limit, so
    that all squares fit 64 bits.  Repeated rows are coded alike, an empty table gives
    an empty table, and other columns are not returned.

    Each round is one pass over the written integers.  Tasks send sums per codebook
    component, so the shuffle grows with the tasks, not with the rows, and the driver
    gets one row per component.
    """
    require(vectors, vec_id, vector, label)
    spark = vectors.sparkSession
    ship(spark)
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    kept = vectors.select(F.col(vec_id), F.col(label), F.col(vector)).where(F.col(vector).isNotNull()).where(good)
    longest = kept.agg(F.max(F.size(vector))).first()[0]
    fields = [vectors.schema[vec_id], vectors.schema[label]]
    rows_of = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    if longest is None:
        return spark.createDataFrame(
            [], f"`{vec_id}` {fields[0].dataType.simpleString()}, code string, error long, label_error long, codebooks_sha256 string"
        )
    width = PARTS * -(-max(1, longest) // PARTS)
    kept = settle(quantised(kept, vector, width))
    first = kept.orderBy(F.col(vec_id).asc_nulls_last(), _VECTOR).limit(ENTRIES).select(_VECTOR).collect()
    seeds = np.array([r[0] for r in first], dtype=np.int64)
    books = np.ascontiguousarray(seeds.reshape(len(seeds), PARTS, -1).transpose(1, 0, 2))
    for _ in range(ROUNDS):
        books = refined(kept, books, width)

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries, distances = assign(matrix(batch.column(2), width), books)
            codes = [bytes(e).hex() for e in entries.astype(np.uint8)]
            arrays = [batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(distances.sum(axis=1))]
            yield pa.RecordBatch.from_arrays(arrays, [vec_id, label, "code", "error"])

    codes = settle(kept.select(vec_id, label, _VECTOR).mapInArrow(coded, f"{rows_of}, code string, error long"))
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    totals = codes.groupBy(F.col(label).alias("__label")).agg(
        F.least(total, F.lit(2**63 - 1).cast("decimal(38,0)")).cast("long").alias("label_error")
    )
    joined = codes.join(settle(totals), F.col(label).eqNullSafe(F.col("__label")), "inner")
    return joined.select(vec_id, "code", "error", "label_error", F.lit(checksum(books)).alias("codebooks_sha256"))


def oracle(width: int = 64) -> str:
    """The same in SQL, for vectors of ``width`` components."""
    size = width // PARTS
    book = f"""SELECT part, entry, ints[part * {size} + 1 : (part + 1) * {size}] AS book
        FROM (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS entry, ints FROM kept), range({PARTS}) p(part)
        WHERE entry < {ENTRIES}"""
    steps = [
        f"""kept AS MATERIALIZED (SELECT vec_id, label,
            list_transform(embedding, lambda x: CAST(floor({SCALE} * x::DOUBLE) AS BIGINT)) AS ints
        FROM embeddings WHERE embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""parts AS MATERIALIZED (SELECT vec_id, label, part, ints[part * {size} + 1 : (part + 1) * {size}] AS own
        FROM kept, range({PARTS}) p(part))""",
        f"book0 AS MATERIALIZED ({book})",
    ]
    squared = (
        "list_sum(list_transform(list_zip(own, book), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
    )
    for r in range(ROUNDS + 1):
        steps.append(
            f"""near{r} AS MATERIALIZED (SELECT vec_id, label, part, own, least_of.d AS distance, least_of.e AS entry
            FROM (SELECT vec_id, any_value(label) AS label, part, any_value(own) AS own,
                         min({{'d': {squared}, 'e': entry}}) AS least_of
                  FROM parts JOIN book{r} USING (part) GROUP BY vec_id, part))"""
        )
        if r < ROUNDS:
            steps.append(
                f"""book{r + 1} AS MATERIALIZED (SELECT part, entry, coalesce(moved, book) AS book
                FROM book{r} LEFT JOIN (
                    SELECT part, entry, list(floor(total / n)::BIGINT ORDER BY place) AS moved FROM (
                        SELECT part, entry, place, sum(own[place + 1])::DOUBLE AS total, count(*) AS n
                        FROM near{r}, range({size}) q(place) GROUP BY part, entry, place)
                    GROUP BY part, entry) USING (part, entry))"""
            )
    return f"""WITH {", ".join(steps)}, codes AS (
        SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code,
               sum(distance)::BIGINT AS error FROM near{ROUNDS} GROUP BY vec_id)
    SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
           (SELECT sha256(string_agg(array_to_string(book, ','), ',' ORDER BY part, entry)) FROM book{ROUNDS})
               AS codebooks_sha256
    FROM codes"""


ORACLE = oracle()
