"""Column-level shaping: back-fill, alignment to a target, strip of path prefixes."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def strip_prefixes(frame: DataFrame) -> DataFrame:
    """Rename every ``a.b.c`` column to ``c``; names that collide are an error."""
    names = [c.rsplit(".", 1)[-1] for c in frame.columns]
    lowered = [n.lower() for n in names]
    repeated = sorted({n for n in lowered if lowered.count(n) > 1})
    if repeated:
        raise ValueError(f"stripping prefixes repeats the columns: {', '.join(repeated)}")
    return frame.toDF(*names)


def backfill(frame: DataFrame, declared: T.StructType) -> DataFrame:
    """Add the declared columns that are absent, as NULLs of the declared type.

    Names are compared the way Spark resolves them, without regard to case, so a
    column that differs only in case is kept rather than added a second time.
    """
    present = {c.lower() for c in frame.columns}
    missing = [f for f in declared.fields if f.name.lower() not in present]
    return frame.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])


def align(frame: DataFrame, target: T.StructType, drop: Collection[str] = ()) -> DataFrame:
    """Columns of ``frame`` by name, in the order and with the types of ``target``.

    Missing columns become NULL.  Columns the target lacks are an error unless
    they are listed in ``drop``.
    """
    present = {c.lower(): c for c in frame.columns}
    extra = set(present) - {f.name.lower() for f in target.fields} - {d.lower() for d in drop}
    if extra:
        raise ValueError(f"target has no column {', '.join(sorted(extra))}")
    columns = []
    for f in target.fields:
        name = present.get(f.name.lower())
        value = F.lit(None) if name is None else F.col(f"`{name}`")
        columns.append(value.cast(f.dataType).alias(f.name))
    return frame.select(*columns)
