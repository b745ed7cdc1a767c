"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib

from arborload.tree import Tree


def md5(*parts) -> str:
    return hashlib.md5("|".join(str(p) for p in parts).encode()).hexdigest()


def _get(value, path):
    for p in path:
        value = None if value is None else value[p]
    return value


def flatten(docs: list[dict], tree: Tree, by_hash: bool = False, batch: str | None = None) -> dict[str, list[dict]]:
    """All tables of all documents, row by row; ``by_hash`` keeps versions of a root apart."""
    out: dict[str, list[dict]] = {t: [] for t in tree.tables}
    key_path = next(f.path for f in tree.root.fields if f.name.lower() == tree.key.lower())

    def emit(node, element, row, own_row, root):
        for f in node.fields:
            row[f.name] = element if node.scalar else _get(element, f.path)
        for child in node.children:
            items = _get(element, child.array)
            if child.entries and items is not None:
                items = [{"key": k, "value": v} for k, v in sorted(items.items())]
            link = md5(child.table, own_row)
            row[f"{child.table}_fk"] = link if items else None
            for pos, item in enumerate(items or []):
                below = {f"{node.table}_id": link, "pos": pos}
                emit(child, item, below, md5(link, pos), root)
        row["root_key"] = root
        if batch is not None:
            row["batch_id"] = batch
        out[node.table].append(row)

    for doc in docs:
        natural = _get(doc, key_path)
        if natural is None:
            continue
        root = md5(tree.root.table, natural)
        own = md5(root, md5(doc["header"]["recordHash"].hex().upper())) if by_hash else root
        emit(tree.root, doc, {}, own, root)
    return out


def rows(frame) -> list[tuple]:
    """Rows of a Spark frame as sorted tuples of (column, value), bytes as hex."""
    return canon([r.asDict() for r in frame.collect()])


def canon(items: list[dict]) -> list[tuple]:
    def plain(v):
        return bytes(v).hex() if isinstance(v, (bytes, bytearray)) else v

    return sorted((tuple(sorted((k, repr(plain(v))) for k, v in i.items())) for i in items))
