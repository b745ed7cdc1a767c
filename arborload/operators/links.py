"""Key propagation: which rows of every table belong to the affected roots."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arborload.functions import keys as K
from arborload.operators.quality import distinct_rows
from arborload.tree import ROOT_KEY, Tree, id_column, link_column


def distinct_keys(frame: DataFrame, key: str, alias: str | None = None) -> DataFrame:
    """Distinct non-NULL values of one column.

    They are grouped as whole rows so that a join with them shuffles them itself:
    Spark divides a hot partition only if both sides come straight from a shuffle.
    """
    name = alias or key
    return distinct_rows(frame.select(F.col(key).alias(name)).where(F.col(name).isNotNull()))


def matched(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Target rows whose key is in the key set; copies in the key set change nothing."""
    return target.join(keys.select(key), key, "left_semi").select(*target.columns)


def unmatched_keys(keys: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Rows of the key set without a target row; a NULL key never matches.

    The target is first cut down to the wanted keys, so with a small key set it is
    scanned without a shuffle and a hot target key shrinks to one row.
    """
    present = distinct_rows(matched(target.select(key), distinct_keys(keys, key), key))
    return keys.join(present, key, "left_anti").select(*keys.columns)


def root_links(target: DataFrame, keys: DataFrame, tree: Tree) -> DataFrame:
    """Natural key and child links of the root rows in the key set."""
    found = matched(target, distinct_keys(keys, tree.key), tree.key)
    return found.select(tree.key, *tree.links(tree.root.table))


def child_links(target: DataFrame, parent_links: DataFrame, tree: Tree, table: str) -> DataFrame:
    """Child links of the rows of ``table`` that the parent's links point at."""
    back = id_column(_parent(tree, table))
    wanted = distinct_keys(parent_links, link_column(table), back)
    return _links_of(matched(target, wanted, back), tree, table)


Keep = Callable[[DataFrame, str], DataFrame]


def propagate(
    targets: Mapping[str, DataFrame], keys: DataFrame, tree: Tree, keep: Keep | None = None
) -> dict[str, DataFrame]:
    """Link rows of every table that has children, found by walking down the links.

    The frame of a table holds one column per child table; the root's also holds
    the natural key.  ``keep(frame, table)`` may write a level and return it as read
    back: without it every use of a deep level walks down from the root again.
    """
    out: dict[str, DataFrame] = {}
    for table in tree.tables:
        if table == tree.root.table:
            found = root_links(targets[table], keys, tree)
        elif tree.children(table):
            found = child_links(targets[table], out[_parent(tree, table)], tree, table)
        else:
            continue
        out[table] = found if keep is None else keep(found, table)
    return out


def links_by_root(targets: Mapping[str, DataFrame], gone: DataFrame, tree: Tree) -> dict[str, DataFrame]:
    """The same link rows as :func:`propagate`, from tables that carry the root key.

    Every table is matched directly, so a deep table costs one join instead of a
    chain of them.
    """
    out: dict[str, DataFrame] = {}
    for table in tree.tables:
        is_root = table == tree.root.table
        if not is_root and not tree.children(table):
            continue
        found = matched(targets[table], gone, ROOT_KEY)
        out[table] = (
            found.select(tree.key, *tree.links(table)) if is_root else _links_of(found, tree, table)
        )
    return out


def table_keys(links: Mapping[str, DataFrame], tree: Tree, table: str) -> tuple[DataFrame, str]:
    """Key set that selects the affected rows of ``table``, and its column."""
    parent = tree.parent(table)
    if parent is None:
        return distinct_keys(links[table], tree.key), tree.key
    back = id_column(parent)
    return distinct_keys(links[parent], link_column(table), back), back


def root_keys(keys: DataFrame, tree: Tree, natural: str | None = None) -> DataFrame:
    """Distinct tree keys for a frame of natural keys; NULLs are left out."""
    name = f"`{natural or tree.key}`"
    present = keys.where(f"{name} IS NOT NULL")
    return distinct_rows(present.selectExpr(f"{K.root_key(tree.root.table, name)} AS {ROOT_KEY}"))


def _parent(tree: Tree, table: str) -> str:
    parent = tree.parent(table)
    if parent is None:
        raise ValueError(f"{table} is the root")
    return parent


def _links_of(rows: DataFrame, tree: Tree, table: str) -> DataFrame:
    found = rows.select(*tree.links(table))
    return found if table in tree.keep_repeats else distinct_rows(found)
