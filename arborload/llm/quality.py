"""Quality rules: text statistics and an n-gram log-likelihood ratio."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborload.llm.shared import require, ship, without
from arborload.llm.words import WordHasher, mixed

#: Smallest and largest number of buckets; the largest is a table of 16 MB in every worker.
LEAST_BUCKETS, MOST_BUCKETS = 1 << 16, 1 << 22
TARGET_DOCS = 20_000
THRESHOLD = -0.12
PRIOR = 10.0
MIN_WORDS = 50
REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\r\x0b\x0c"
ADDED = tuple("n_words word_chars n_symbols n_dup_lines n_repeat_words ratio base_failed kept".split())
_PAIR = np.uint64(0xC2B2AE3D27D4EB4F)


def bucket_count(rows: int) -> int:
    """Buckets for a corpus of so many documents.

    They grow with the square root of the documents, about as distinct n-grams do, so a
    bucket holds as few of them in a large corpus as in a small one.
    """
    wanted = 512 * math.sqrt(max(1, rows))
    return min(MOST_BUCKETS, max(LEAST_BUCKETS, 1 << math.ceil(math.log2(wanted))))


def ngram_buckets(words: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets of all words, given as hashes, and of all pairs of neighbouring words."""
    pairs = words[:-1] * _PAIR + words[1:]
    return (mixed(np.concatenate((words, pairs))) % np.uint64(buckets)).astype(np.int64)


def statistics(text: str) -> tuple[int, int, int, int, int]:
    """Words, their characters, symbols, repeated lines and words in repeated 3-word windows."""
    words = text.encode("utf-8", "surrogatepass").split()
    chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    return len(words), chars, symbols, len(lines) - len(set(lines)), repeated_words(words)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a 3-word window found at least twice, the first one included."""
    windows = list(zip(words, words[1:], words[2:]))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    twice = np.fromiter((counts[w] > 1 for w in windows), dtype=bool, count=len(windows))
    covered = np.zeros(len(words), dtype=bool)
    for shift in range(3):
        covered[shift : shift + len(twice)] |= twice
    return int(covered.sum())


def ngram_counts(docs: DataFrame, flag: str, buckets: int) -> DataFrame:
    """Counts per bucket over all documents (``raw``) and the flagged ones (``target``)."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(buckets, dtype=np.int64), np.zeros(buckets, dtype=np.int64)
        hasher = WordHasher()
        for batch in batches:
            found: tuple[list, list] = ([], [])
            for text, trusted in zip(batch.column(0), batch.column(1).to_pylist()):
                words = hasher.hashes((text.as_py() or "").encode("utf-8", "surrogatepass"))
                found[bool(trusted)].append(ngram_buckets(words, buckets))
            for sums, lists in ((raw, found[0] + found[1]), (target, found[1])):
                for at in range(0, len(lists), 256):
                    sums += np.bincount(np.concatenate(lists[at : at + 256]), minlength=buckets)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(raw[used]), pa.array(target[used])], ["bucket", "raw", "target"]
        )

    rows = docs.select("text", F.col(flag).alias("flag")).mapInArrow(counted, "bucket long, raw long, target long")
    return rows.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))


def ratios(counts: DataFrame, buckets: int, prior: float = PRIOR) -> np.ndarray:
    """Log of the target's over the raw probability of every bucket.

    The target multinomial has a prior of the raw one's shape, worth ``prior`` counts
    in each bucket: buckets that a small target hardly reaches have a ratio near 0.
    At most ``buckets`` rows reach the driver, whatever the size of the corpus.
    """
    raw, target = np.zeros(buckets), np.zeros(buckets)
    found = counts.toArrow()
    places = found.column("bucket").to_numpy()
    raw[places], target[places] = found.column("raw").to_numpy(), found.column("target").to_numpy()
    expected = target.sum() * raw / max(raw.sum(), 1.0)
    return np.log((target + prior) / (expected + prior)).astype(np.float32)


def trusted_sample(labels: DataFrame, limit: int = TARGET_DOCS) -> DataFrame:
    """At most ``limit`` ids labelled good, those with the smallest hashes."""
    good = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("__good")).distinct()
    return good.orderBy(F.xxhash64("__good"), "__good").limit(limit)


def scored(
    docs: DataFrame,
    labels: DataFrame,
    buckets: int | None = None,
    threshold: float = THRESHOLD,
    target_docs: int = TARGET_DOCS,
) -> DataFrame:
    """All documents with their statistics, likelihood ratio and verdict.

    The target multinomial is counted over the documents labelled good, of which a
    bounded hash-chosen sample of ``target_docs`` is used; the raw one over all
    documents.  Both count words and pairs of words hashed to ``buckets``, a number that
    grows with the documents unless it is given.  ``ratio``
    is the mean over a document's n-grams of the log of target over raw probability;
    a document is kept if its ratio is at least ``threshold`` and the base rules hold:
    at least 50 words, of which at most half lie in repeated 3-word windows.

    Adds ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``ratio``, ``base_failed`` and ``kept`` in place of input
    columns so named.  A NULL text is empty: it has ratio 0 and fails the base rules.
    Without labelled documents all ratios are 0.  Repeated rows are scored alike; an
    empty table gives an empty table.
    """
    require(docs, "doc_id", "text")
    ship(docs.sparkSession)
    trusted = F.broadcast(trusted_sample(labels, target_docs))
    buckets = bucket_count(docs.count()) if buckets is None else buckets
    flagged = docs.select("doc_id", "text").join(trusted, F.col("doc_id") == F.col("__good"), "left")
    log_ratio = ratios(ngram_counts(flagged.withColumn("flag", F.col("__good").isNotNull()), "flag", buckets), buckets)
    columns = without(docs, ADDED)
    at = columns.index("text")

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            stats, ratio = [], []
            for value in batch.column(at):
                text = value.as_py() or ""
                stats.append(statistics(text))
                found = ngram_buckets(hasher.hashes(text.encode("utf-8", "surrogatepass")), buckets)
                ratio.append(round(float(log_ratio[found].mean(dtype=np.float64)), 9) if len(found) else 0.0)
            numbers = np.array(stats, dtype=np.int64).reshape(-1, 5)
            score = np.array(ratio, dtype=float)
            failed = (numbers[:, 0] < MIN_WORDS) | (100 * numbers[:, 4] > REPEAT_PERCENT * numbers[:, 0])
            arrays = [
                *batch.columns,
                *[pa.array(np.ascontiguousarray(numbers[:, i])) for i in range(5)],
                pa.array(score),
                pa.array(failed),
                pa.array(~failed & (score >= threshold)),
            ]
            yield pa.RecordBatch.from_arrays(arrays, [*columns, *ADDED])

    chosen = docs.select(*[F.col(f"`{c}`") for c in columns])
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields]
    fields += [f"{c} long" for c in ADDED[:5]] + ["ratio double", "base_failed boolean", "kept boolean"]
    return chosen.mapInArrow(measured, ", ".join(fields))
