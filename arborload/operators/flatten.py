"""Nested documents to linked tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from arborload.functions import keys
from arborload.tree import BATCH_ID, POSITION, ROOT_KEY, Node, Tree, id_column, link_column

_ROW = "__row"
_LINK = "__link"
_ELEMENT = "__element"
# A map has no order of its own: its entries are numbered by their keys.
_ENTRIES = (
    f"array_sort(map_entries({_ELEMENT}), (a, b) -> CASE WHEN a.key < b.key THEN -1 WHEN a.key > b.key THEN 1 ELSE 0 END)"
)


def _dig(path: tuple[str, ...], base: str | None = None) -> str:
    parts = path if base is None else (base, *path)
    return ".".join(f"`{p}`" for p in parts)


def _links(node: Node, base: str | None, row: str) -> list[str]:
    return [
        f"CASE WHEN size({_dig(child.array, base)}) > 0 THEN {keys.link_key(child.table, row)} END"
        f" AS `{link_column(child.table)}`"
        for child in node.children
    ]


def _path_of(tree: Tree, name: str) -> str:
    return _dig(next(f.path for f in tree.root.fields if f.name.lower() == name.lower()))


def version_values(tree: Tree) -> list[str]:
    """SQL for the values that tell versions of a root apart; binary ones as hexadecimal text."""
    values = []
    for name in tree.version:
        field = next(f for f in tree.root.fields if f.name.lower() == name.lower())
        binary = isinstance(field.data_type, T.BinaryType)
        values.append(f"hex({_dig(field.path)})" if binary else _dig(field.path))
    return values


def rejects(docs: DataFrame, tree: Tree) -> DataFrame:
    """Documents without a natural key; they cannot be linked and are not flattened."""
    return docs.where(f"{_path_of(tree, tree.key)} IS NULL")


def flatten(
    docs: DataFrame,
    tree: Tree,
    table: str,
    carry: tuple[str, ...] = (),
    batch: str | None = None,
    version: Sequence[str] | None = None,
    every: Sequence[str] = (),
    gather: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Rows of one table of the tree.

    Root rows keep their scalar columns; child rows get ``<parent>_id`` and ``pos``.
    Every row has a ``<child>_fk`` per child table (NULL when it has no children)
    and the ``root_key`` of its document.  ``carry`` names extra top-level columns,
    such as the source file, that stay on the root rows.  ``batch`` is put on every
    row as ``batch_id``.  ``version`` gives SQL for the values that tell versions of a
    root apart, in place of the tree's version columns.  ``every`` names top-level columns
    that stay on the rows of every table.  ``gather`` may shuffle the rows by their root key
    before the last explode, where each still holds its child rows in an array.

    Only ``posexplode`` and hashing are involved: there is no shuffle, and key
    hashes are computed once per parent row, below the explode.
    """
    line = tree.lineage(table)
    natural = _path_of(tree, tree.key)
    root_key = keys.root_key(tree.root.table, natural)
    row = keys.root_row_key(tree.root.table, natural, version_values(tree) if version is None else version)
    tags = [ROOT_KEY] if batch is None else [ROOT_KEY, f"{keys.quoted(batch)} AS {BATCH_ID}"]
    kept = [f"`{c}`" for c in every]
    tags += kept
    frame = docs.where(f"{natural} IS NOT NULL")

    if len(line) == 1:
        scalars = [f"{_dig(f.path)} AS `{f.name}`" for f in tree.root.fields]
        links = _links(tree.root, None, row)
        tags[0] = f"{root_key} AS {ROOT_KEY}"
        return frame.selectExpr(*scalars, *[f"`{c}`" for c in carry], *links, *tags)

    frame = frame.selectExpr(
        f"{root_key} AS {ROOT_KEY}", *kept, f"{row} AS {_ROW}", f"{_dig(line[1].array)} AS {_ELEMENT}"
    )
    for depth, node in enumerate(line[1:], start=1):
        frame = frame.where(f"size({_ELEMENT}) > 0")
        if gather is not None and depth == len(line) - 1:
            frame = gather(frame)
        frame = frame.selectExpr(
            ROOT_KEY,
            *kept,
            f"{keys.link_key(node.table, _ROW)} AS {_LINK}",
            f"posexplode({_ENTRIES if node.entries else _ELEMENT}) AS ({POSITION}, {_ELEMENT})",
        )
        if depth < len(line) - 1:
            frame = frame.selectExpr(
                ROOT_KEY,
                *kept,
                f"{keys.row_key(_LINK, POSITION)} AS {_ROW}",
                f"{_dig(line[depth + 1].array, _ELEMENT)} AS {_ELEMENT}",
            )

    node, parent = line[-1], line[-2]
    return frame.selectExpr(
        f"{_LINK} AS `{id_column(parent.table)}`",
        POSITION,
        *[f"{_dig(f.path, _ELEMENT)} AS `{f.name}`" for f in node.fields],
        *_links(node, _ELEMENT, keys.row_key(_LINK, POSITION)),
        *tags,
    )


def flatten_all(docs: DataFrame, tree: Tree, carry: tuple[str, ...] = ()) -> dict[str, DataFrame]:
    """Every table of the tree from one frame of documents."""
    return {t: flatten(docs, tree, t, carry if t == tree.root.table else ()) for t in tree.tables}


def flatten_from(
    read: Callable[[T.StructType, bool], DataFrame],
    tree: Tree,
    schema: T.StructType,
    carry: tuple[str, ...] = (),
    batch: str | None = None,
    version: Sequence[str] | None = None,
    every: Sequence[str] = (),
    gather: Callable[[str], Callable[[DataFrame], DataFrame] | None] = lambda table: None,
) -> dict[str, DataFrame]:
    """Every table of the tree, each from its own narrow scan.

    ``read(schema, is_root)`` returns the documents read with the given schema.
    Spark prunes nested columns through an explode only when a single field is
    used, so each table asks for just the leaves it needs.  Together the scans
    read about one copy of the input, however many tables there are.
    """
    out = {}
    for t in tree.tables:
        is_root = t == tree.root.table
        docs = read(tree.read_schema(t, schema), is_root)
        out[t] = flatten(docs, tree, t, carry if is_root else (), batch, version, every, gather(t))
    return out
