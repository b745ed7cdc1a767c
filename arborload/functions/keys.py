"""Deterministic keys that tie parent and child rows together.

Keys are md5 strings of natural values, so they need no shuffle, no row numbering
and no driver state, and the same input gives the same keys on every run.

The functions take and give SQL expressions as text.  A wide tree has hundreds of
columns; as text they reach Spark in one call per table.
"""

from __future__ import annotations

from collections.abc import Sequence

SEPARATOR = "|"


def quoted(name: str) -> str:
    """A string literal."""
    return "'" + name.replace("\\", "\\\\").replace("'", "\\'") + "'"


def digest(*parts: str) -> str:
    """md5 over the parts joined by ``|``."""
    texts = ", ".join(f"CAST({p} AS STRING)" for p in parts)
    return f"md5(concat_ws('{SEPARATOR}', {texts}))"


def root_key(table: str, natural: str) -> str:
    """Key of a whole document tree, carried by every row flattened from it."""
    return digest(quoted(table), natural)


def root_row_key(table: str, natural: str, version: Sequence[str] = ()) -> str:
    """Key of one root row.

    Without ``version`` it is the tree key.  With version columns, two versions of
    a root in one batch keep separate subtrees while exact copies still collapse.
    Version values are hashed one by one, so neither NULLs nor separators inside
    values can make two versions look alike.
    """
    base = root_key(table, natural)
    if not version:
        return base
    return digest(base, *[f"coalesce(md5(CAST({v} AS STRING)), 'null')" for v in version])


def link_key(child: str, parent_row: str) -> str:
    """Value shared by ``parent.<child>_fk`` and ``child.<parent>_id``."""
    return digest(quoted(child), parent_row)


def row_key(link: str, pos: str) -> str:
    """Key of one child row: its link plus its position in the array."""
    return digest(link, pos)


def bucket(key: str, buckets: int) -> str:
    """Stable bucket number of a key, used to lay tables out on disk; NULL has one too."""
    return f"CAST(pmod(crc32(coalesce(CAST({key} AS STRING), '')), {int(buckets)}) AS INT)"
