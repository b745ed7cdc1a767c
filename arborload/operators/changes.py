"""Upserts, deletes and merges as functions from the old rows to the new rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborload.operators import links as L
from arborload.operators.columns import align
from arborload.operators.quality import distinct_rows
from arborload.tree import ROOT_KEY, Tree

#: 4 million key hashes fill an eighth of so many words of 64 bits.
FILTER_WORDS = 1 << 19
_WORD, _BIT, _BITS = "__word", "__bit", "__bits"


def delete_by_key(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Target rows whose key is not in the key set.

    NULLs in the key set delete nothing, and target rows with a NULL key stay.
    The keys stay a DataFrame, so Spark broadcasts a small set and shuffles a large one.
    """
    return target.join(L.distinct_keys(keys, key), key, "left_anti").select(*target.columns)


def delete_by_many_keys(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows of :func:`delete_by_key`, with only those rows shuffled whose key may be in the key set.

    The key set leaves a bit per hash of a key in a table of at most ``FILTER_WORDS`` words of 64
    bits, which is broadcast at any size.  A row whose bit is not set stays without an exchange;
    the others are joined.  A key set that fills the table costs the exchange of all rows, as before.
    """
    gone = L.distinct_keys(keys, key)
    at = [f"pmod(xxhash64(`{key}`), {FILTER_WORDS * 64}L) div 64 AS {_WORD}", f"CAST(pmod(xxhash64(`{key}`), 64L) AS INT) AS {_BIT}"]
    words = gone.selectExpr(*at).groupBy(_WORD).agg(F.expr(f"bit_or(shiftleft(1L, {_BIT}))").alias(_BITS))
    tagged = target.selectExpr("*", *at).join(F.broadcast(words), _WORD, "left")
    maybe = f"`{key}` IS NOT NULL AND coalesce(getbit({_BITS}, {_BIT}) = 1, false)"
    sure = tagged.where(f"NOT ({maybe})").select(*target.columns)
    return sure.unionByName(tagged.where(maybe).select(*target.columns).join(gone, key, "left_anti").select(*target.columns))


def upsert_by_key(target: DataFrame, stage: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Delete the rows in the key set, then add the distinct rows of the stage."""
    fresh = distinct_rows(align(stage, target.schema))
    return delete_by_key(target, keys, key).unionByName(fresh)


def merge_by_key(
    target: DataFrame, stage: DataFrame, key: str, drop: tuple[str, ...] = ()
) -> DataFrame:
    """Replace the rows whose key the stage holds; repeated stage rows are all kept."""
    return delete_by_key(target, stage, key).unionByName(align(stage, target.schema, drop))


def delete_tree(
    targets: Mapping[str, DataFrame],
    keys: DataFrame,
    tree: Tree,
    by: str = "root_key",
    keep: L.Keep | None = None,
) -> dict[str, DataFrame]:
    """Rows that remain in every table once the given roots are gone.

    ``by="root_key"`` uses the tree key that flattening puts on every row: one join
    per table, however deep it sits.  ``by="links"`` follows the parent/child links
    for tables that lack it; ``keep`` writes each level once (see ``links.propagate``).  Both read only the old tables, so the order in which
    the results are written does not matter.
    """
    out = {}
    if by == "root_key":
        gone = L.root_keys(keys, tree)
        for table in tree.tables:
            out[table] = delete_by_many_keys(targets[table], gone, ROOT_KEY)
        return out
    if by != "links":
        raise ValueError(f"by must be root_key or links, not {by}")
    links = L.propagate(targets, keys, tree, keep)
    for table in tree.tables:
        gone, key = L.table_keys(links, tree, table)
        out[table] = delete_by_key(targets[table], gone, key)
    return out


def upsert_tree(
    targets: Mapping[str, DataFrame],
    stage: Mapping[str, DataFrame],
    tree: Tree,
    by: str = "root_key",
) -> dict[str, DataFrame]:
    """Replace the whole subtree of every root in the stage.

    Stage rows are always added, also for roots the target has not seen before.
    A table without stage rows only loses the rows of the staged roots.
    """
    kept = delete_tree(targets, stage[tree.root.table].select(tree.key), tree, by)
    out = {}
    for table, rows in kept.items():
        fresh = stage.get(table)
        if fresh is not None:
            rows = rows.unionByName(distinct_rows(align(fresh, rows.schema)))
        out[table] = rows
    return out
