"""Document fingerprints: bottom-k sketches of word shingles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arborload.llm.shared import SPACE, require, text_key

K = 128
WORDS = 5
#: Rows between two bounds on average. Many short ranges fill tasks more evenly; a bound costs one copied row.
RANGE_ROWS = 32
#: Beyond so many ranges these get longer instead; their bounds are one value of the plan.
MOST_BOUNDS = 1_000_000


def sketch(text: str, k: int = K, words: int = WORDS) -> Column:
    """The ``k`` smallest distinct hashes of the word shingles of a text, ascending.

    ``text`` is an SQL expression.  Fewer words than a shingle takes are one shingle;
    no word, an empty text and NULL give an empty sketch.
    """
    hashed = rf"transform(filter(split(coalesce({text}, ''), r'{SPACE}'), w -> w != ''), w -> xxhash64(w))"
    inner = ", ".join(f"w[i + {j}]" for j in range(words))
    shingles = (
        f"CASE WHEN size(w) = 0 THEN CAST(array() AS array<bigint>) WHEN size(w) < {words} THEN array(xxhash64(w))"
        f" ELSE transform(sequence(0, size(w) - {words}), i -> xxhash64({inner})) END"
    )
    # The outer transforms of one-element arrays name a value that is used twice.
    return F.expr(
        f"slice(sort_array(array_distinct(transform(array({hashed}), w -> {shingles})[0])), 1, {k})"
    )


def merged(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of the union of what two sketches were made of."""
    return F.slice(F.sort_array(F.array_union(a, b)), 1, k)


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below ``k``."""
    last = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit(k - 1.0) / last)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles among all of either; 1 for two empty sketches."""
    both = merged(a, b, k)
    common = F.size(F.array_intersect(both, F.array_intersect(a, b)))
    return F.when(F.size(both) == 0, F.lit(1.0)).otherwise(common / F.greatest(F.size(both), F.lit(1)))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the shingles behind ``a`` that are behind ``b`` too; 1 for an empty ``a``."""
    common = resemblance(a, b, k) * distinct_shingles(merged(a, b, k), k)
    own = distinct_shingles(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), common / F.greatest(own, F.lit(1.0))))


def fingerprint(a: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits for each hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def sketched(docs: DataFrame, k: int = K, words: int = WORDS, name: str = "sketch") -> DataFrame:
    """Documents with the sketch of their text in ``name`` (see ``sketch``)."""
    require(docs, "text")
    return docs.withColumn(name, sketch("text", k, words))


def merged_by(rows: DataFrame, by: str, k: int = K, name: str = "sketch") -> DataFrame:
    """One sketch per group of ``by``, from the sketches of its parts.

    Every task cuts a group to its ``k`` smallest hashes before the shuffle, so a group
    that holds most of the rows costs no more than any other.  A group without a
    shingle gets an empty sketch; NULL is a group of its own.
    """
    hashes = rows.select(F.col(by), F.explode(name).alias("__hash")).distinct()
    ranked = hashes.withColumn("__rank", F.row_number().over(Window.partitionBy(by).orderBy("__hash")))
    small = ranked.where(F.col("__rank") <= k).groupBy(F.col(by).alias("__by")).agg(F.sort_array(F.collect_list("__hash")).alias(name))
    groups = rows.select(by).distinct()
    empty = F.expr("CAST(array() AS array<bigint>)")
    joined = groups.join(small, F.col(by).eqNullSafe(F.col("__by")), "left")
    return joined.select(by, F.coalesce(name, empty).alias(name))


def _greater_or_equal(bounds: str) -> str:
    """SQL for the number of bounds that are not below ``doc_id``, by bisection of the ascending bounds."""
    middle = "CAST((a.low + a.high) div 2 AS INT)"
    search = (
        f"aggregate(sequence(1, 33), named_struct('low', 0, 'high', size({bounds})), (a, i) ->"
        f" CASE WHEN a.low >= a.high THEN a WHEN {bounds}[{middle}] < doc_id"
        f" THEN named_struct('low', {middle} + 1, 'high', a.high) ELSE named_struct('low', a.low, 'high', {middle}) END, a -> a.low)"
    )
    return f"CASE WHEN doc_id IS NULL THEN size({bounds}) ELSE size({bounds}) - {search} END"


def with_next(docs: DataFrame, k: int = K, words: int = WORDS) -> DataFrame:
    """Documents with sketch, and text and sketch of the next one, descending by ``doc_id``.

    After the last document comes the first.  Equal ids are ordered by their text's
    digest, and NULL ids come last.  Ids may be of any type that has an order.

    The documents are dealt once, by ranges of ids.  Ids whose hash is a multiple of a
    step cut the ranges, so ranges grow in number with the rows and the bounds are the
    same whenever they are computed.  Such a document is the first of its range; a copy
    of it closes the range before, so no range has to be joined with its neighbour.
    """
    step = max(RANGE_ROWS, -(-docs.count() // MOST_BOUNDS))
    cuts = F.col("doc_id").isNotNull() & (F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0)
    found = docs.agg(
        F.sort_array(F.collect_set(F.when(cuts, F.col("doc_id")))).alias("bounds"), F.max("doc_id").alias("top")
    )
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keyed = rows.select("*", text_key(F.col("text")).alias("__key"), sketch("text", k, words).alias("sketch"))
    known = keyed.withColumn("__found", found.select(F.struct("bounds", "top").alias("found")).scalar())
    own = known.withColumn("__own", F.expr(_greater_or_equal("__found.bounds")))
    places = F.filter(
        F.array(
            F.struct(F.col("__own").alias("range"), F.lit(False).alias("copy")),
            F.when(cuts, F.struct((F.col("__own") - 1).alias("range"), F.lit(True).alias("copy"))),
            F.when(
                F.col("doc_id").eqNullSafe(F.col("__found.top")),
                F.struct(F.size("__found.bounds").alias("range"), F.lit(True).alias("copy")),
            ),
        ),
        lambda p: p.isNotNull(),
    )
    dealt = own.select("doc_id", "text", "sketch", "__key", F.explode(places).alias("__place"))
    order = [F.asc("__place.copy"), F.desc_nulls_last("doc_id"), F.asc("__key")]
    after = F.lead(F.struct("text", "sketch")).over(Window.partitionBy("__place.range").orderBy(*order))
    return dealt.withColumn("next", after).where("NOT __place.copy").select("doc_id", "text", "sketch", "next")


def compared(docs: DataFrame, k: int = K, words: int = WORDS) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, and how alike they are.

    The edited text has the last third of the code points (rounded down) replaced by
    the first as many of the next document.  ``near_edited`` and ``near_next`` are the
    estimated resemblances to the edited text and to the next document,
    ``kept_by_edited`` is the estimated share of the document's shingles that the
    edited text has, ``n_shingles`` the estimated number of distinct shingles.  NULL
    texts are empty.  Two texts without a word are wholly alike.  Repeated rows follow
    each other.  An empty table gives an empty table.
    """
    require(docs, "doc_id", "text")
    third = "CAST(floor(char_length(text) / 3) AS INT)"
    edited = F.expr(f"concat(left(text, char_length(text) - {third}), left(next.text, {third}))")
    rows = with_next(docs, k, words).select(
        "doc_id", "sketch", F.char_length("text").cast("long").alias("n_chars"), F.col("next.sketch").alias("next_sketch"),
        edited.alias("edited"),
    )
    both = rows.select("*", sketch("edited", k, words).alias("edited_sketch"))
    own, changed = F.col("sketch"), F.col("edited_sketch")
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint(own).alias("fingerprint"),
        fingerprint(changed).alias("edited_fingerprint"),
        resemblance(own, changed, k).alias("near_edited"),
        resemblance(own, F.col("next_sketch"), k).alias("near_next"),
        containment(own, changed, k).alias("kept_by_edited"),
        distinct_shingles(own, k).alias("n_shingles"),
    )
