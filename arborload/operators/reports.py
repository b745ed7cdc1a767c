"""Count reports and row metrics."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arborload.tree import Tree, link_column


def _counts(links: Mapping[str, DataFrame], tree: Tree, name: str, rule) -> DataFrame:
    """One row per table, from one aggregate per link frame.

    A frame is read once for all of its child tables.  A global aggregate gives a
    row even when the frame is empty, so tables without changes report 0.
    """
    parts = []
    for parent in links:
        columns = {c: link_column(c) for c in tree.children(parent)}
        if parent == tree.root.table:
            columns = {parent: tree.key, **columns}
        totals = links[parent].agg(*[rule(F.col(c)).alias(f"n{i}") for i, c in enumerate(columns.values())])
        pairs = ", ".join(f"'{t}', n{i}" for i, t in enumerate(columns))
        parts.append(totals.select(F.expr(f"stack({len(columns)}, {pairs}) AS (table, {name})")))
    return reduce(DataFrame.unionByName, parts)


def update_counts(links: Mapping[str, DataFrame], tree: Tree) -> DataFrame:
    """``(table, update_count)``: non-NULL links to each table."""

    def rule(column: Column) -> Column:
        return F.count(column)

    return _counts(links, tree, "update_count", rule)


def delete_counts(links: Mapping[str, DataFrame], tree: Tree) -> DataFrame:
    """``(table, delete_count)``: link rows of each table's parent, NULL links included."""

    def rule(column: Column) -> Column:
        return F.count(F.lit(1))

    return _counts(links, tree, "delete_count", rule)
