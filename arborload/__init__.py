"""Load nested, time-partitioned batches into linked relational tables with Spark.

The package is a set of ``DataFrame -> DataFrame`` functions; nothing runs until a
sink writes.  The hierarchy, its keys and the per-table projections are
configuration (:mod:`arborload.tree`, :mod:`arborload.plans.config`).
"""

from arborload.tree import Field, Node, Tree

__all__ = ["Field", "Node", "Tree"]
