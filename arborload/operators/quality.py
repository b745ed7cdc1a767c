"""Duplicates and latest versions."""

from __future__ import annotations

from collections.abc import Callable, Collection, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

COPIES = "dup_count"
_ROW = "__row"
_DIGEST = "__digest"


def _reject_maps(frame: DataFrame) -> None:
    maps = [f.name for f in frame.schema.fields if isinstance(f.dataType, T.MapType)]
    if maps:
        raise ValueError(f"map columns cannot be compared, use to_json: {', '.join(maps)}")


def _whole(columns: Sequence[str]) -> Column:
    """The given columns as one grouping value.

    Grouping by several columns lets Spark reuse a partitioning by just one of them,
    for instance that of a join below, and a hot value of that column would then
    stay in one task.  Grouping by the whole row always spreads the rows anew,
    after counting copies within each task.
    """
    return F.struct(*[F.col(f"`{c}`") for c in columns]).alias(_ROW)


def distinct_rows(frame: DataFrame) -> DataFrame:
    """One copy of every row."""
    _reject_maps(frame)
    return frame.select(_whole(frame.columns)).distinct().select(f"{_ROW}.*")


def duplicate_groups(frame: DataFrame) -> DataFrame:
    """Each row that occurs more than once, with the number of its copies.

    Copies are counted before the shuffle, so a row with very many copies costs
    one partial count per task.
    """
    _reject_maps(frame)
    counted = frame.groupBy(_whole(frame.columns)).agg(F.count(F.lit(1)).alias(COPIES))
    return counted.where(F.col(COPIES) > 1).select(f"{_ROW}.*", COPIES)


def duplicate_rows(frame: DataFrame) -> DataFrame:
    """All copies of the rows that occur more than once.

    Rows are matched back to the repeated groups instead of being counted in a
    window over all columns: no group is ever held or sorted in one task, and if
    the repeated groups are few they are broadcast.
    """
    groups = duplicate_groups(frame).select(*[F.col(f"`{c}`").alias(f"__{c}") for c in frame.columns])
    same = reduce(and_, [F.col(f"`{c}`").eqNullSafe(F.col(f"`__{c}`")) for c in frame.columns])
    return frame.join(groups, same, "left_semi")


def dedupe(
    frame: DataFrame, volatile: Collection[str] = (), observe: Observation | None = None, copies: str | None = None
) -> DataFrame:
    """One row per distinct combination of the columns outside ``volatile``.

    Volatile columns, such as the load time or the source file, keep their
    smallest value.  With ``observe``, the same pass reports the rows read, the
    rows kept and the number of rows that had copies; the observation sits after
    the last shuffle, where a retried task is not counted twice.  ``copies`` names a
    column with the number of copies that a row stands for; it is left out of the result.
    """
    _reject_maps(frame)
    skip = {v.lower() for v in volatile}
    columns = [c for c in frame.columns if c != copies]
    business = [c for c in columns if c.lower() not in skip]
    keeping = [c for c in columns if c.lower() in skip]
    if observe is None and not keeping:
        return distinct_rows(frame.select(*[F.col(f"`{c}`") for c in columns]))
    smallest = [F.min(F.col(f"`{c}`")).alias(c) for c in keeping]
    number = F.count(F.lit(1)) if copies is None else F.sum(F.col(f"`{copies}`"))
    unique = frame.groupBy(_whole(business)).agg(number.alias(COPIES), *smallest)
    if observe is not None:
        unique = unique.observe(observe, *counts_of_copies(COPIES))
    shown = [F.col(f"`{c}`") if c in keeping else F.col(_ROW).getField(c).alias(c) for c in columns]
    return unique.select(*shown)


def counts_of_copies(copies: str) -> list[Column]:
    """Rows read, kept and repeated, of rows with the number of copies that each stands for."""
    return [
        F.sum(copies).alias("rows_read"),
        F.count(F.lit(1)).alias("rows_kept"),
        F.count(F.when(F.col(copies) > 1, 1)).alias("rows_repeated"),
    ]


def dedupe_by_digest(
    frame: DataFrame,
    keep: Callable[[DataFrame], DataFrame],
    volatile: Collection[str] = (),
    observe: Observation | None = None,
    digest: Callable[[Sequence[str]], Column] | None = None,
    copies: str | None = None,
) -> DataFrame:
    """The rows of :func:`dedupe`, with whole rows shuffled only where a digest repeats.

    First only digests of 64 bits are counted.  Those that repeat are written with
    ``keep`` and read back, so Spark knows their true size: below its limit for
    broadcasts the other rows pass without an exchange, above it the join shuffles.
    Rows under a repeated digest are compared in full, so digests may collide.  The
    frame is read twice, which pays where rows are wide and copies are few.
    """
    _reject_maps(frame)
    skip = {v.lower() for v in volatile}
    columns = [c for c in frame.columns if c != copies]
    business = [c for c in columns if c.lower() not in skip]
    stands = F.lit(1).cast("long") if copies is None else F.col(f"`{copies}`")
    marked = frame.withColumn(_DIGEST, row_digest(frame, business) if digest is None else digest(business))
    counts = marked.groupBy(_DIGEST).agg(F.count(F.lit(1)).alias(COPIES)).where(f"{COPIES} > 1")
    repeated = keep(counts.select(_DIGEST))
    single = marked.join(repeated, _DIGEST, "left_anti").select(*columns, stands.alias(COPIES))
    several = marked.join(repeated, _DIGEST, "left_semi").select(*frame.columns)
    smallest = [F.min(F.col(f"`{c}`")).alias(c) for c in columns if c not in business]
    groups = several.groupBy(_whole(business)).agg(F.sum(stands).alias(COPIES), *smallest)
    shown = [F.col(_ROW).getField(c).alias(c) if c in business else F.col(f"`{c}`") for c in columns]
    unique = single.unionByName(groups.select(*shown, COPIES))
    if observe is not None:
        unique = unique.observe(observe, *counts_of_copies(COPIES))
    return unique.drop(COPIES)


def row_digest(frame: DataFrame, columns: Sequence[str]) -> Column:
    """64 bits over the given columns; NULLs and empty values differ, the two zeros don't."""
    kinds = dict(frame.dtypes)
    values = [(F.col(f"`{c}`") + 0 if kinds[c] in ("float", "double") else F.col(f"`{c}`")).alias(c) for c in columns]
    return F.xxhash64(F.to_json(F.struct(*values), {"ignoreNullFields": "false"}))


def latest_per_key(frame: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The row of each key that is largest by ``order``.

    Ranking with a filter on rank 1 makes Spark keep only the top row of each key
    per task before the shuffle, so a hot key does not gather in one task.
    ``order`` must end in a tie-breaker for the result to be determined.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(c).desc_nulls_last() for c in order])
    ranked = frame.withColumn("__rank", F.row_number().over(newest))
    return ranked.where(F.col("__rank") == 1).drop("__rank")
