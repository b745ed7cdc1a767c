"""Mixing sources to target weights by Poisson replication."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborload.llm.shared import require, shared_table, without

PART_MEAN = 8.0
TERMS = 63
ADDED = ("rate", "repetitions", "copy", "shuffle_key")


def source_rates(
    docs: DataFrame, temperature: float = 0.7, epochs: float = 1.0, weights: Mapping[str, float] | None = None
) -> DataFrame:
    """Mean number of repetitions of the documents of every source.

    A source with n characters gets a share of the output in proportion to
    ``n ** temperature``, or to its entry in ``weights`` (sources without an entry:
    zero); the whole output has ``epochs`` times the characters of the input on
    average.  NULL is a source of its own.  A source without a character has rate 0
    where weights are given and ``epochs`` otherwise.
    """
    sizes = docs.groupBy("source").agg(F.sum(F.coalesce(F.length("text"), F.lit(0))).cast("double").alias("n"))
    if weights is None:
        share = F.pow("n", F.lit(float(temperature)))
    else:
        entries = [x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))]
        named = F.create_map(*entries) if entries else F.expr("map('', 0D)")
        share = F.coalesce(F.try_element_at(named, F.col("source")), F.lit(0.0))
    shared = sizes.withColumn("share", share)
    total = shared.agg(F.sum("n").alias("all_n"), F.sum("share").alias("all_share"))
    empty = F.lit(float(epochs) if weights is None else 0.0)
    rate = F.when(
        (F.col("n") > 0) & (F.col("all_share") > 0),
        F.lit(float(epochs)) * F.col("all_n") * F.col("share") / F.col("all_share") / F.col("n"),
    ).otherwise(empty)
    return shared.crossJoin(F.broadcast(total)).select("source", rate.alias("rate"))


def _uniform(seed: int, *parts: Column) -> Column:
    """52 bits of an md5 as a number in [0, 1)."""
    joined = F.concat_ws("|", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))


def replicate(
    docs: DataFrame,
    temperature: float = 0.7,
    epochs: float = 1.0,
    weights: Mapping[str, float] | None = None,
    seed: int = 11,
) -> DataFrame:
    """Repeat every document a Poisson number of times and shuffle all copies.

    The count of a document is the inverse of the Poisson distribution with the mean
    rate of its source at a number hashed from the seed and ``doc_id``, so a rerun
    gives the same copies.  A rate above 8 is split into equal parts that are drawn
    apart and added, which is the same distribution and keeps ``exp`` from underflow.
    Every copy goes to a partition by a hash of its own and is sorted there by it.

    Adds ``rate``, ``repetitions``, ``copy`` (from 0) and ``shuffle_key``, in place of
    input columns so named.  Documents drawn zero times are absent.  Rows that repeat
    a ``doc_id`` draw the same count; a NULL ``doc_id`` is drawn as the word null.
    NULL text and NULL source are kept.  An empty table gives an empty table.
    """
    require(docs, "doc_id", "text", "source")
    kept = without(docs, ADDED)
    rates = source_rates(docs, temperature, epochs, weights)
    steps = F.expr(
        f"aggregate(sequence(1, {TERMS}),"
        " named_struct('term', exp(-__mean), 'cdf', array(exp(-__mean))),"
        " (a, k) -> named_struct('term', a.term * __mean / k,"
        " 'cdf', array_append(a.cdf, element_at(a.cdf, -1) + a.term * __mean / k)), a -> a.cdf)"
    )
    parts = F.greatest(F.ceil(F.col("rate") / PART_MEAN), F.lit(1)).cast("int")
    table = (
        rates.withColumn("__parts", parts)
        .withColumn("__mean", F.col("rate") / F.col("__parts"))
        .withColumn("__cdf", steps)
        .select(F.col("source").alias("__source"), "rate", "__parts", "__cdf")
    )
    table = shared_table(table, "rates")
    drawn = docs.select(*kept).join(table, F.col("source").eqNullSafe(F.col("__source")), "inner")
    count = F.aggregate(
        F.sequence(F.lit(1), F.col("__parts")),
        F.lit(0),
        lambda total, part: total
        + F.size(F.filter("__cdf", lambda c: c <= _uniform(seed, F.col("doc_id"), part))),
    )
    counted = drawn.withColumn("repetitions", count).where("repetitions > 0")
    copies = counted.withColumn("copy", F.explode(F.expr("sequence(0, repetitions - 1)")))
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), "copy"))
    keyed = copies.withColumn("shuffle_key", key)
    return (
        keyed.select(*[F.col(f"`{c}`") for c in kept], *ADDED)
        .repartition("shuffle_key")
        .sortWithinPartitions("shuffle_key")
    )


ORACLE = f"""
WITH sizes AS (
  SELECT source, sum(coalesce(length(text), 0))::DOUBLE AS n FROM documents GROUP BY source
), rates AS (
  SELECT source,
    CASE WHEN n > 0 THEN 1.0::DOUBLE * (sum(n) OVER ()) * pow(n, 0.7) / (sum(pow(n, 0.7)) OVER ()) / n ELSE 1.0 END AS rate
  FROM sizes
), parts AS (
  SELECT source, rate, greatest(ceil(rate / 8.0), 1)::INT AS parts FROM rates
), cdf AS (
  WITH RECURSIVE steps(source, mean, k, term, total) AS (
    SELECT source, rate / parts, 0, exp(-rate / parts), exp(-rate / parts) FROM parts
    UNION ALL
    SELECT source, mean, k + 1, term * mean / (k + 1), total + term * mean / (k + 1) FROM steps WHERE k < {TERMS}
  ) SELECT source, list(total) AS totals FROM steps GROUP BY source
), drawn AS (
  SELECT d.*, p.rate, CAST(list_sum(list_transform(range(1, p.parts + 1), lambda j: len(list_filter(c.totals, lambda t:
    t <= (('0x' || substr(md5('11|' || coalesce(d.doc_id::VARCHAR, 'null') || '|' || j), 1, 13))::BIGINT)::DOUBLE / 4503599627370496.0)))) AS INT)
    AS repetitions
  FROM documents d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source JOIN cdf c ON c.source IS NOT DISTINCT FROM p.source
), copies AS (
  SELECT *, unnest(range(0, repetitions))::INT AS copy FROM drawn WHERE repetitions > 0
)
SELECT doc_id, text, lang, source, n_chars, round(rate, 9) AS rate, repetitions, copy,
  md5('11|' || coalesce(doc_id::VARCHAR, 'null') || '|' || copy) AS shuffle_key
FROM copies
"""
