"""Per-table projections chosen by name."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborload.functions.header import HEADER_FIELDS, SOURCE_FILE, audit_header
from arborload.tree import BATCH_ID, ROOT_KEY, Tree, id_column

# A projection is a list of select expressions, a function run_id -> such a list,
# or a function (frame, run_id) -> frame for what a select list cannot say.
SelectList = Sequence[str]
Projection = SelectList | Callable[[str], SelectList]
FrameTransform = Callable[[DataFrame, str], DataFrame]


class Projections:
    """Projections by entity; looked up lazily, with optional aliases for whole feeds."""

    def __init__(
        self,
        by_entity: Mapping[str, Projection],
        aliases: Mapping[str, str] | None = None,
    ) -> None:
        self._by_entity = dict(by_entity)
        self._aliases = dict(aliases or {})

    def _resolve(self, entity: str) -> str:
        if entity in self._by_entity:
            return entity
        for alias, original in self._aliases.items():
            if entity.startswith(alias):
                return original + entity[len(alias) :]
        return entity

    def __contains__(self, entity: str) -> bool:
        return self._resolve(entity) in self._by_entity

    def select_list(self, entity: str, run_id: str) -> list[str]:
        name = self._resolve(entity)
        if name not in self._by_entity:
            raise KeyError(f"no projection for {entity}")
        found = self._by_entity[name]
        return list(found(run_id) if callable(found) else found)


def project(
    frame: DataFrame,
    select_list: SelectList,
    header: str | None = None,
    as_of: datetime | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Apply a select list, preceded by the audit header if one is asked for.

    ``header`` is ``"nested"``, ``"flattened"`` or None.  ``keep`` names key columns
    that follow the projected ones unless the select list already gives them.
    """
    columns = audit_header(header == "flattened", as_of) if header else []
    columns += [F.expr(e) for e in select_list]
    given = {c.lower() for c in frame.select(*columns).columns}
    return frame.select(*columns, *[k for k in keep if k.lower() not in given])


def keeps(select_list: SelectList, column: str) -> bool:
    """Whether a select list gives a column as it is, under its own or another name."""
    plain = re.compile(rf"\s*`?{re.escape(column)}`?(\s+(as\s+)?(`[^`]+`|\w+))?\s*", re.IGNORECASE)
    return any(plain.fullmatch(e) for e in select_list)


def project_view(spark: SparkSession, frame: DataFrame, name: str, select_text: str) -> DataFrame:
    """Register ``frame`` under ``name`` and run a textual select list over it."""
    frame.createOrReplaceTempView(name)
    return spark.sql(f"SELECT {select_text} FROM {name}")


def project_tree(
    tables: Mapping[str, DataFrame],
    tree: Tree,
    projections: Projections,
    entity: str,
    run_id: str,
    as_of: datetime | None = None,
    header: bool = True,
    carry: Sequence[str] = (),
    every: Sequence[str] = (),
) -> dict[str, DataFrame]:
    """Project every flattened table under ``<entity>_<table>``.

    The header goes on the root only, and only if ``header`` is set.  Link columns,
    the parent id, the root key and the batch id stay on every table, since upserts
    and deletes need them.  A table without a projection keeps its columns; of a root
    with a header those are the ones the header does not hold already.  ``carry`` names
    further columns that stay on the root, ``every`` those that stay on all tables.
    """
    out = {}
    for table, frame in tables.items():
        with_header = header and table == tree.root.table
        parent = tree.parent(table)
        keep = [*tree.links(table), ROOT_KEY] + ([id_column(parent)] if parent else [])
        keep += [BATCH_ID] if BATCH_ID in frame.columns else []
        keep += [*carry, *every] if parent is None else every
        name = f"{entity}_{table}"
        if name in projections:
            select = projections.select_list(name, run_id)
        elif with_header:
            held = {c.lower() for c in (*HEADER_FIELDS.values(), SOURCE_FILE)}
            select = [f"`{c}`" for c in frame.columns if c.lower() not in held]
        else:
            out[table] = frame
            continue
        out[table] = project(frame, select, "flattened" if with_header else None, as_of, keep)
    return out
