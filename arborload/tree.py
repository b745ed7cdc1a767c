"""Description of a tree of linked tables.

A tree is normally derived from the declared schema of the nested document
(:meth:`Tree.from_schema`): every array becomes a child table, nested structs are
folded into the columns of the row that holds them.  Trees over tables that are
already relational are written down by name (:meth:`Tree.of`).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

ROOT_KEY = "root_key"
BATCH_ID = "batch_id"
POSITION = "pos"
VALUE = "val"


def link_column(child: str) -> str:
    """Parent column that points at the rows of ``child``."""
    return f"{child}_fk"


def id_column(parent: str) -> str:
    """Child column that points back at ``parent``."""
    return f"{parent}_id"


@dataclass(frozen=True)
class Field:
    """One scalar column of a table and where it sits inside the document."""

    name: str
    path: tuple[str, ...]
    data_type: T.DataType


@dataclass(frozen=True)
class Node:
    """One table: the array or map it comes from, its scalar columns, its child tables.

    An array directly inside an array has an empty path: it is the element itself.
    ``entries`` marks a map, whose rows are its entries.
    """

    table: str
    array: tuple[str, ...] = ()
    fields: tuple[Field, ...] = ()
    children: tuple[Node, ...] = ()
    scalar: bool = False
    entries: bool = False


@dataclass(frozen=True)
class Tree:
    """A root table, its natural key and everything below it.

    ``version`` names root columns that tell versions of one root apart.
    ``keep_repeats`` names tables whose link rows are counted without removing
    repeats; the links of all other tables are made distinct first.
    """

    root: Node
    key: str
    version: tuple[str, ...] = ()
    keep_repeats: frozenset[str] = frozenset()
    _index: Mapping[str, tuple[Node, ...]] = field(init=False, repr=False, compare=False)

    def __post_init__(self) -> None:
        index: dict[str, tuple[Node, ...]] = {}

        def visit(node: Node, above: tuple[Node, ...]) -> None:
            if node.table in index:
                raise ValueError(f"two arrays give the same table name: {node.table}")
            index[node.table] = (*above, node)
            _check_columns(node, above[-1] if above else None)
            for child in node.children:
                visit(child, (*above, node))

        visit(self.root, ())
        object.__setattr__(self, "_index", index)

    # -- construction -----------------------------------------------------

    @classmethod
    def of(
        cls,
        root: str,
        key: str,
        children: Mapping[str, Sequence[str]],
        keep_repeats: Sequence[str] = (),
    ) -> Tree:
        """Tree over existing relational tables, given as parent -> children names."""

        def build(name: str) -> Node:
            return Node(name, (name,), children=tuple(build(c) for c in children.get(name, ())))

        return cls(build(root), key, keep_repeats=frozenset(keep_repeats) | {root})

    @classmethod
    def from_schema(
        cls,
        root: str,
        key: str,
        schema: T.StructType,
        version: Sequence[str] = (),
        qualify: bool = False,
        keep_repeats: Sequence[str] = (),
    ) -> Tree:
        """Derive the tables from a document schema.

        Column names keep the last part of their path and table names its lower
        case.  An array in an array becomes a child table ``<name>_val`` of the outer
        one's, a map a table of its entries with the columns ``key`` and ``val`` (those
        of the value if it is a struct, a table ``<name>_val`` if it is nested).  Two columns of one table that end alike are an error unless
        ``qualify`` is set, which names the later one by its whole path.
        """
        node = _node(root.lower(), (), schema, qualify)
        if key.lower() not in {f.name.lower() for f in node.fields}:
            raise ValueError(f"natural key {key} is not a scalar column of {root}")
        return cls(node, key, tuple(version), frozenset(keep_repeats) | {node.table})

    # -- navigation -------------------------------------------------------

    def nodes(self) -> Iterator[Node]:
        """All nodes, parents before children."""
        return (line[-1] for line in self._index.values())

    @property
    def tables(self) -> list[str]:
        return list(self._index)

    def lineage(self, table: str) -> tuple[Node, ...]:
        """Nodes from the root down to ``table``."""
        if table not in self._index:
            raise KeyError(f"unknown table {table}; known: {', '.join(self._index)}")
        return self._index[table]

    def node(self, table: str) -> Node:
        return self.lineage(table)[-1]

    def parent(self, table: str) -> str | None:
        line = self.lineage(table)
        return line[-2].table if len(line) > 1 else None

    def children(self, table: str) -> list[str]:
        return [c.table for c in self.node(table).children]

    def links(self, table: str) -> list[str]:
        return [link_column(c) for c in self.children(table)]

    def leaf_first(self) -> list[str]:
        """Tables ordered so that every child comes before its parent."""
        return list(reversed(self.tables))

    # -- schemas ----------------------------------------------------------

    def read_schema(self, table: str, schema: T.StructType) -> T.StructType:
        """The part of ``schema`` that flattening ``table`` has to read.

        That is the natural key (and version columns), the columns of the table,
        the arrays on the way down and, for each child array, its narrowest leaf,
        which is enough to tell an empty array from a filled one.
        """
        line = self.lineage(table)
        keys = {n.lower() for n in (self.key, *self.version)}
        wanted = [f.path for f in self.root.fields if f.name.lower() in keys]
        prefix: tuple[str, ...] = ()
        for node in line:
            prefix += node.array
        wanted += [prefix + f.path for f in line[-1].fields if not line[-1].scalar]
        if line[-1].scalar:
            wanted.append(prefix)
        for child in line[-1].children:
            wanted.append(prefix + child.array + _narrowest(child))
        return _prune(schema, wanted)


def _check_columns(node: Node, parent: Node | None) -> None:
    generated = [link_column(c.table) for c in node.children]
    if node.fields:
        generated += [ROOT_KEY, BATCH_ID]
    if parent is not None:
        generated += [id_column(parent.table), POSITION]
    seen: set[str] = set()
    for name in [f.name for f in node.fields] + generated:
        if name.lower() in seen:
            raise ValueError(f"table {node.table} would have two columns named {name}")
        seen.add(name.lower())


def _node(table: str, array: tuple[str, ...], schema: T.StructType, qualify: bool) -> Node:
    fields: list[Field] = []
    children: list[Node] = []
    taken: set[str] = set()

    def visit(struct: T.StructType, path: tuple[str, ...]) -> None:
        for f in struct.fields:
            here = (*path, f.name)
            if isinstance(f.dataType, T.StructType):
                visit(f.dataType, here)
            elif isinstance(f.dataType, (T.ArrayType, T.MapType)):
                children.append(_nested(f.name.lower(), here, f.dataType, qualify))
            else:
                name = f.name
                if qualify and name.lower() in taken:
                    name = "_".join(here)
                taken.add(name.lower())
                fields.append(Field(name, here, f.dataType))

    visit(schema, ())
    return Node(table, array, tuple(fields), tuple(children))


def _nested(table: str, path: tuple[str, ...], kind: T.DataType, qualify: bool) -> Node:
    """The table of an array or a map."""
    if isinstance(kind, T.MapType):
        if isinstance(kind.valueType, (T.ArrayType, T.MapType)):
            node = _node(table, path, T.StructType([T.StructField("key", kind.keyType)]), qualify)
            return replace(node, children=(*node.children, _nested(f"{table}_{VALUE}", ("value",), kind.valueType, qualify)), entries=True)
        entry = T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])
        node = _node(table, path, entry, qualify)
        fields = tuple(replace(f, name=VALUE) if f.path == ("value",) else f for f in node.fields)
        return replace(node, fields=fields, entries=True)
    assert isinstance(kind, T.ArrayType)
    element = kind.elementType
    if isinstance(element, T.StructType):
        return _node(table, path, element, qualify)
    if isinstance(element, (T.ArrayType, T.MapType)):
        return Node(table, path, children=(_nested(f"{table}_{VALUE}", (), element, qualify),))
    return Node(table, path, (Field(VALUE, (), element),), scalar=True)


_WIDTH = {"boolean": 0, "tinyint": 1, "smallint": 2, "int": 3, "date": 4, "bigint": 5}


def _narrowest(node: Node) -> tuple[str, ...]:
    """Path of the cheapest leaf inside an element of the node's array."""
    if node.scalar:
        return ()
    if node.fields:
        return min(node.fields, key=lambda f: _WIDTH.get(f.data_type.simpleString(), 9)).path
    child = node.children[0]
    return child.array + _narrowest(child)


def with_paths(narrow: T.StructType, schema: T.StructType, paths: Sequence[tuple[str, ...]]) -> T.StructType:
    """A narrow schema with more columns of the whole one, given by their paths."""
    return _prune(schema, [*_leaves(narrow), *paths])


def _leaves(schema: T.StructType) -> list[tuple[str, ...]]:
    found: list[tuple[str, ...]] = []
    for f in schema.fields:
        inner = f.dataType.elementType if isinstance(f.dataType, T.ArrayType) else f.dataType
        below = _leaves(inner) if isinstance(inner, T.StructType) else [()]
        found += [(f.name, *p) for p in below]
    return found


def _prune(schema: T.StructType, wanted: Sequence[tuple[str, ...]]) -> T.StructType:
    kept = []
    for f in schema.fields:
        below = [p[1:] for p in wanted if p and p[0].lower() == f.name.lower()]
        if not below:
            continue
        kept.append(T.StructField(f.name, _prune_type(f.dataType, below), f.nullable))
    return T.StructType(kept)


def _prune_type(data_type: T.DataType, below: Sequence[tuple[str, ...]]) -> T.DataType:
    if any(not p for p in below):
        return data_type
    if isinstance(data_type, T.MapType):
        return data_type
    if isinstance(data_type, T.ArrayType):
        return T.ArrayType(_prune_type(data_type.elementType, below), data_type.containsNull)
    assert isinstance(data_type, T.StructType)
    return _prune(data_type, below)
