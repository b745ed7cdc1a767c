"""Toxic passages by maximum-scoring segments over token log-odds."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborload.llm.shared import require, ship, without
from arborload.llm.words import WordHasher, mixed

BUCKETS = 1 << 18
TRAIN_DOCS = 40_000
PRIOR = 2000.0
DRIFT = 0.25
SIGNIFICANT = 0.01
STEMS = (5, 7)
_SALT = np.uint64(0xA0761D6478BD642F)
HELD_OUT = 2
#: Word characters: letters, digits and every byte of other scripts; all else separates words.
SEPARATORS = bytes(b for b in range(128) if not chr(b).isalnum() and chr(b) != "'")


def token_buckets(text: str, hasher: WordHasher, buckets: int = BUCKETS) -> np.ndarray:
    """A row per word, in order: buckets of the lower-case word and of its stems.

    A stem is the first bytes of a word; it catches inflected forms never seen before.
    """
    words = hasher.prefixes(text.lower().encode("utf-8", "surrogatepass"), STEMS)
    salted = words + np.arange(words.shape[1], dtype=np.uint64) * _SALT
    return (mixed(salted) % np.uint64(buckets)).astype(np.int64)


def best_segment(scores: np.ndarray) -> float:
    """Sum of the segment with the largest sum; 0 if no token scores above zero."""
    sums = np.concatenate(([0.0], np.cumsum(scores)))
    return float((sums - np.minimum.accumulate(sums)).max())


def maximal_segments(scores: np.ndarray, least: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments of at least ``least``, as (start, end, sum).

    One pass: a token above zero opens a segment, which swallows the segments back to
    the nearest one that begins at a lower cumulated sum as long as that one ends
    lower than the new segment does.  Every segment is swallowed once, so the scan is
    linear.
    """
    open_segments: list[tuple[int, int, float, float]] = []  # start, end, sum before, sum after
    lower: list[int] = []  # nearest open segment before each that begins at a lower sum
    total = 0.0
    for at, score in enumerate(scores.tolist()):
        before, total = total, total + score
        if score <= 0:
            continue
        start, low = at, before
        back = len(open_segments) - 1
        while True:
            while back >= 0 and open_segments[back][2] >= low:
                back = lower[back]
            if back < 0 or open_segments[back][3] >= total:
                break
            start, low = open_segments[back][0], open_segments[back][2]
            before_it = lower[back]
            del open_segments[back:], lower[back:]
            back = before_it
        open_segments.append((start, at + 1, low, total))
        lower.append(back)
    return [(a, b, high - low) for a, b, low, high in open_segments if high - low >= least]


@dataclass
class Model:
    """Token scores, extreme-value parameters and the calibration to a probability."""

    scores: np.ndarray
    rate: float
    scale: float = 1.0
    intercept: float = -2.0
    slope: float = 0.0

    def of(self, tokens: np.ndarray) -> np.ndarray:
        """The score of every token: the mean of its word's and its stems'."""
        return self.scores[tokens].mean(axis=1)

    def evidence(self, tokens: np.ndarray) -> tuple[float, list[tuple[int, int, float]]]:
        """Minus log of the p-value of a text's best passages, and the significant ones.

        By extreme-value theory a segment's sum S among n tokens of the background
        has about ``scale * n * exp(-rate * S)`` equals by chance.  The p-value of the
        r best passages together comes from the sum of their normalised sums; the
        best r counts.
        """
        if not len(tokens):
            return 0.0, []
        scores = self.of(tokens)
        base = math.log(self.scale * len(tokens))
        top = self.rate * best_segment(scores) - base
        alone = -math.log(-math.expm1(-math.exp(-top))) if top < 30 else top
        least = (base - math.log(SIGNIFICANT)) / self.rate
        if top < -math.log(SIGNIFICANT):
            return max(alone, 0.0), []
        found = maximal_segments(scores, least)
        together, best = 0.0, alone
        for r, s in enumerate(sorted((self.rate * x[2] - base for x in found), reverse=True), start=1):
            together += s
            if r > 1:
                p = together - (r - 1) * math.log(together) + math.lgamma(r + 1) + math.lgamma(r)
                best = max(best, p)
        return best, found

    def probability(self, evidence: float) -> float:
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, self.intercept + self.slope * math.log1p(evidence)))))


def training_sample(labels: DataFrame, limit: int = TRAIN_DOCS) -> DataFrame:
    """At most ``limit`` labelled ids outside the held-out fold, by smallest hash."""
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    rows = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(fold != HELD_OUT)
    once = rows.groupBy(F.col("doc_id").alias("__labelled")).agg(F.max("toxic").cast("int").alias("__toxic"))
    return once.orderBy(F.xxhash64("__labelled"), "__labelled").limit(limit)


def class_counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """Tokens per bucket over all documents, the toxic and the clean training ones."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, buckets), dtype=np.int64)
        hasher = WordHasher(SEPARATORS)
        for batch in batches:
            found: dict[int | None, list[np.ndarray]] = {None: [], 0: [], 1: []}
            for text, toxic in zip(batch.column(0), batch.column(1).to_pylist()):
                found[toxic].append(token_buckets(text.as_py() or "", hasher, buckets))
            for toxic, lists in found.items():
                for at in range(0, len(lists), 256):
                    counts = np.bincount(np.concatenate(lists[at : at + 256]).ravel(), minlength=buckets)
                    sums[0] += counts
                    if toxic is not None:
                        sums[2 - toxic] += counts
        used = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), *[pa.array(s[used]) for s in sums]], ["bucket", "every", "toxic", "clean"]
        )

    rows = docs.select("text", "__toxic").mapInArrow(counted, "bucket long, every long, toxic long, clean long")
    return rows.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("every", "toxic", "clean")])


def token_scores(counts: np.ndarray, prior: float = PRIOR, drift: float = DRIFT) -> np.ndarray:
    """Log-odds of toxic against clean text with a Dirichlet prior of the corpus' shape.

    ``counts`` has a row for all, the toxic and the clean training tokens.  The
    log-odds are drawn towards zero by their standard error, and ``drift`` is taken
    off every token, so that background text scores below zero on average.
    """
    every, toxic, clean = counts.astype(float)
    shape = prior * (every + 0.01) / (every + 0.01).sum()
    odds = []
    for own in (toxic, clean):
        total = own.sum() + prior
        odds.append(np.log(own + shape) - np.log(total - own - shape))
    error = np.sqrt(1.0 / (toxic + shape) + 1.0 / (clean + shape))
    raw = odds[0] - odds[1]
    return np.sign(raw) * np.maximum(np.abs(raw) - error, 0.0) - drift


def tail(sizes: np.ndarray, best: np.ndarray) -> tuple[float, float]:
    """Rate and scale of the extreme-value law of the best sums of background texts.

    The best sum S of n tokens is at most s with probability
    ``exp(-scale * n * exp(-rate * s))``.  The most likely scale has a closed form for
    each rate; the most likely rate is found by golden section on its logarithm.
    """
    if not len(sizes):
        return 1.0, 1.0

    def scale(rate: float) -> float:
        return 1.0 / float(np.mean(sizes * np.exp(-rate * best)))

    def likelihood(log_rate: float) -> float:
        rate = math.exp(log_rate)
        return log_rate + math.log(scale(rate)) - rate * float(best.mean())

    low, high = math.log(0.02), math.log(20.0)
    golden = (math.sqrt(5) - 1) / 2
    for _ in range(60):
        left, right = high - golden * (high - low), low + golden * (high - low)
        low, high = (left, high) if likelihood(left) < likelihood(right) else (low, right)
    rate = math.exp((low + high) / 2)
    return rate, scale(rate)


def calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression of labels on the logged evidence, by Newton steps."""
    if not len(y) or y.min() == y.max():
        rate = (y.sum() + 0.5) / (len(y) + 1.0)
        return math.log(rate / (1 - rate)), 0.0
    design = np.column_stack((np.ones(len(x)), np.log1p(x)))
    weights = np.zeros(2)
    for _ in range(50):
        p = 1.0 / (1.0 + np.exp(-np.clip(design @ weights, -30, 30)))
        pull = design.T @ (y - p) - 1e-3 * weights
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(curve, pull)
        weights += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-9:
            break
    return float(weights[0]), max(0.0, float(weights[1]))


def fit(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, train_docs: int = TRAIN_DOCS) -> Model:
    """Learn from a bounded sample of training labels and the counts of all documents.

    At most ``buckets`` rows of counts and ``train_docs`` rows of one best sum and one
    label reach the driver.
    """
    ship(docs.sparkSession)
    sample = F.broadcast(training_sample(labels, train_docs))
    joined = docs.select("doc_id", "text").join(sample, F.col("doc_id") == F.col("__labelled"), "left")
    counts = np.zeros((3, buckets), dtype=np.int64)
    for row in class_counts(joined, buckets).collect():
        counts[:, row["bucket"]] = row["every"], row["toxic"], row["clean"]
    if not counts[1].sum() or not counts[2].sum():
        return Model(np.full(buckets, -DRIFT), 1.0)
    scores = token_scores(counts)
    model = Model(scores, 1.0)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(SEPARATORS)
        for batch in batches:
            tokens = [token_buckets(t.as_py() or "", hasher, buckets) for t in batch.column(0)]
            best = [best_segment(model.of(t)) if len(t) else 0.0 for t in tokens]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(map(len, tokens)), pa.int64()), pa.array(best, pa.float64()), batch.column(1)],
                ["n", "best", "toxic"],
            )

    def evidence(model: Model):
        def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            hasher = WordHasher(SEPARATORS)
            for batch in batches:
                x = [model.evidence(token_buckets(t.as_py() or "", hasher, buckets))[0] for t in batch.column(0)]
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.float64()), batch.column(1)], ["x", "toxic"])

        return of

    training = joined.where("__toxic IS NOT NULL").select("text", "__toxic")
    background = training.where("__toxic = 0").mapInArrow(sums, "n long, best double, toxic int").where("n > 0").collect()
    model.rate, model.scale = tail(np.array([r["n"] for r in background], dtype=float), np.array([r["best"] for r in background]))
    rows = training.mapInArrow(evidence(model), "x double, toxic int").collect()
    x, y = np.array([r["x"] for r in rows]), np.array([r["toxic"] for r in rows], dtype=float)
    model.intercept, model.slope = calibrate(x, y)
    return model


def scored(docs: DataFrame, model: Model, limit: float = 0.3) -> DataFrame:
    """All documents with their toxicity, verdict and significant passages.

    ``score`` is the probability of the toxic label, ``predicted`` is 1 from ``limit``
    on, and ``passages`` holds the token ranges and sums of all significant segments.
    The score sees nothing but the text.  NULL and empty texts have no evidence and
    get the smallest score.  Added columns replace input columns so named.  Repeated
    rows are scored alike; an empty table gives an empty table.
    """
    require(docs, "text")
    ship(docs.sparkSession)
    buckets = len(model.scores)
    added = ("score", "predicted", "evidence", "passages")
    columns = without(docs, added)
    at = columns.index("text")
    passage = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("sum", pa.float64())]))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(SEPARATORS)
        for batch in batches:
            found = [model.evidence(token_buckets(t.as_py() or "", hasher, buckets)) for t in batch.column(at)]
            scores = [model.probability(x) for x, _ in found]
            spans = [[{"start": a, "end": b, "sum": s} for a, b, s in p] for _, p in found]
            arrays = [
                *batch.columns,
                pa.array(scores, pa.float64()),
                pa.array([int(s >= limit) for s in scores], pa.int32()),
                pa.array([x for x, _ in found], pa.float64()),
                pa.array(spans, passage),
            ]
            yield pa.RecordBatch.from_arrays(arrays, [*columns, *added])

    chosen = docs.select(*[F.col(f"`{c}`") for c in columns])
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields]
    fields += [
        "score double", "predicted int", "evidence double",
        "passages array<struct<start: bigint, end: bigint, sum: double>>",
    ]
    return chosen.mapInArrow(measured, ", ".join(fields))
