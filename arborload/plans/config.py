"""Configuration of a feed."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from enum import Enum

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from arborload.operators.project import Projections
from arborload.tree import Tree


class Mode(str, Enum):
    """What a run does with its batch."""

    BULK = "bulk"
    UPSERT = "upsert"
    DELETE = "delete"


class Versions(str, Enum):
    """What a run does with several documents of one root."""

    KEEP_ALL = "keep_all"
    LATEST = "latest"
    NEWEST = "newest"


@dataclass(frozen=True)
class Feed:
    """One feed of one source.

    ``tree`` makes the run flatten its documents; without it the projected
    documents go to a single table.  ``projections`` are looked up under
    ``<source>_<name>`` or ``<source>_<name>_<table>``; tables without one keep
    their columns.  ``where`` filters documents at the scan, ``transform`` changes
    them before anything else.  ``delete_path`` is the key inside a delete feed.

    ``on_duplicate_root`` says what becomes of documents that share a natural key.
    ``keep_all`` keeps each with its own subtree; exact copies count as one.  They are
    told apart by the tree's version columns, else by ``recordHash``, or by a digest of
    the whole document where that is NULL, absent or shared by differing documents.
    ``latest`` keeps the one of a batch that is largest by the paths in ``latest_by``
    (those that the schema has), then by its digest.  ``newest`` does so across batches
    too: the root table keeps the order of its documents in ``root_version``, and an
    upsert passes by roots that are older than what is loaded, so batches may arrive in
    any order.  ``digest_first`` removes repeated rows of a tree by
    ``quality.dedupe_by_digest``, for feeds with wide rows and few copies.
    """

    source: str
    name: str
    landing: str
    schema: T.StructType
    tree: Tree | None = None
    key: str | None = None
    projections: Projections = field(default_factory=lambda: Projections({}))
    header: bool = True
    where: str | None = None
    transform: Callable[[DataFrame], DataFrame] | None = None
    delete_path: str | None = None
    on_duplicate_root: Versions | str = Versions.KEEP_ALL
    digest_first: bool = False
    latest_by: tuple[str, ...] = ("header.ingestDateTime", "header.collectionDate")

    def __post_init__(self) -> None:
        for name in ("source", "name", "landing"):
            if not getattr(self, name):
                raise ValueError(f"missing {name}")
        if not self.schema.fields:
            raise ValueError("missing schema")
        if Versions(self.on_duplicate_root) is Versions.NEWEST and self.tree is None:
            raise ValueError("newest needs a tree")

    @property
    def entity(self) -> str:
        return f"{self.source}_{self.name}"

    def table(self, name: str) -> str:
        """Catalog name of a flattened table."""
        return f"{self.entity}_{name}"

    @property
    def natural_key(self) -> str:
        key = self.tree.key if self.tree is not None else self.key
        if not key:
            raise ValueError(f"{self.entity} has no key; only bulk loads are possible")
        return key
