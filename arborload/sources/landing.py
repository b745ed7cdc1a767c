"""Time slices of a landing area laid out as year=/month=/day=/hour=/minute=."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from enum import Enum

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborload.functions.header import SOURCE_FILE
from arborload.operators.metrics import Metrics
from arborload.sources.scratch import exists

PARTITIONS = ("year", "month", "day", "hour", "minute")


class Granularity(str, Enum):
    """Which part of the landing area a batch covers."""

    YESTERDAY = "yesterday"
    TODAY = "today"
    HOUR = "hour"
    ALL = "all"
    NEW = "new"


def slice_of(granularity: Granularity | str, as_of: datetime | None = None) -> dict[str, int]:
    """Partition values that bound the slice; ``hour`` is the hour before ``as_of``.

    Times are UTC.  ``new`` has no bounds: a run finds its files by what earlier runs
    have seen.  An unknown granularity raises ``ValueError``.
    """
    granularity = Granularity(granularity)
    now = as_of or datetime.now(timezone.utc)
    if granularity in (Granularity.ALL, Granularity.NEW):
        return {}
    if granularity is Granularity.HOUR:
        then = now - timedelta(hours=1)
        return {"year": then.year, "month": then.month, "day": then.day, "hour": then.hour}
    then = now - timedelta(days=1) if granularity is Granularity.YESTERDAY else now
    return {"year": then.year, "month": then.month, "day": then.day}


def slice_path(root: str, bounds: dict[str, int]) -> str:
    """Directory of the slice; values are zero-padded to two digits."""
    return "/".join([root.rstrip("/"), *[f"{k}={v:02d}" for k, v in bounds.items()]])


def slice_filter(bounds: dict[str, int]) -> Column | None:
    """The same slice as a predicate on the partition columns."""
    condition = None
    for name, value in bounds.items():
        equal = F.col(name) == F.lit(value)
        condition = equal if condition is None else condition & equal
    return condition


def cover(start: datetime, end: datetime) -> list[dict[str, int]]:
    """The fewest year, month, day and hour directories that hold every minute from ``start`` up to ``end``."""
    at = start.replace(minute=0, second=0, microsecond=0)
    end = _next(end.replace(minute=0, second=0, microsecond=0), 3) if (end.minute, end.second, end.microsecond) != (0, 0, 0) else end
    found = []
    while at < end:
        depth = next(d for d in range(4) if at == _floor(at, d) and (_next(at, d) <= end or d == 3))
        found.append(dict(zip(PARTITIONS, (at.year, at.month, at.day, at.hour)[: depth + 1])))
        at = _next(at, depth)
    return found


def in_utc(*moments: datetime) -> tuple[datetime, ...]:
    """Moments without a time zone, in UTC; those that have none are taken to be."""
    return tuple(t.astimezone(timezone.utc).replace(tzinfo=None) if t.tzinfo else t for t in moments)


def _floor(at: datetime, depth: int) -> datetime:
    """Beginning of the year, month, day or hour (depth 0 to 3) of a moment."""
    values = (at.year, at.month, at.day, at.hour)[: depth + 1]
    return datetime(*values, *(1,) * max(0, 3 - len(values)), tzinfo=at.tzinfo)


def _next(at: datetime, depth: int) -> datetime:
    if depth == 0:
        return at.replace(year=at.year + 1)
    if depth == 1:
        return (at.replace(day=28) + timedelta(days=4)).replace(day=1)
    return at + (timedelta(days=1) if depth == 2 else timedelta(hours=1))


def scan_range(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    start: datetime,
    end: datetime,
    source_file: bool = False,
    metrics: Metrics | None = None,
    entity: str = "",
    until: float | None = None,
) -> DataFrame:
    """Documents landed from ``start`` up to, but not at, ``end``; both in UTC, to the minute.

    Only directories of :func:`cover` are listed, and the bounds stay as a predicate on
    the partition columns, which prunes the minutes.  A range without any directory is
    missing input, as in :func:`scan`.
    """
    start, end = in_utc(start, end)
    if end <= start:
        raise ValueError(f"empty range: {start} to {end}")
    wanted = [slice_path(root, bounds) for bounds in cover(start, end)]
    paths = [p for p in wanted if exists(spark, p)]
    frame = _read(spark, root, schema, paths, source_file, until)
    if frame is None:
        if metrics is not None:
            missing(metrics, entity)
        return _nothing(spark, schema, source_file)
    landed = F.expr("make_timestamp_ntz(year, month, day, hour, minute, 0)")
    return frame.where((landed >= F.lit(start).cast("timestamp_ntz")) & (landed < F.lit(end).cast("timestamp_ntz")))


def _read(spark, root: str, schema: T.StructType, paths: list[str], source_file: bool, until: float | None) -> DataFrame | None:
    """The files below some directories of the landing area; ``None`` if one is missing or there are none."""
    reader = spark.read.schema(with_partitions(schema)).option("basePath", root)
    if until is not None:
        moment = datetime.fromtimestamp(until, timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%f")
        reader = reader.option("modifiedBefore", moment).option("timeZone", "UTC")
    try:
        frame = reader.parquet(*paths) if paths else None
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        frame = None
    if frame is not None and source_file:
        frame = frame.select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))
    return frame


def _nothing(spark: SparkSession, schema: T.StructType, source_file: bool) -> DataFrame:
    frame = spark.createDataFrame([], with_partitions(schema))
    return frame.withColumn(SOURCE_FILE, F.lit(None).cast("string")) if source_file else frame


def scan(
    spark: SparkSession,
    root: str,
    schema: T.StructType,
    granularity: Granularity | str = Granularity.ALL,
    as_of: datetime | None = None,
    where: str | Column | None = None,
    source_file: bool = False,
    metrics: Metrics | None = None,
    entity: str = "",
    until: float | None = None,
) -> DataFrame:
    """Documents of one slice, with all partition columns whatever the granularity.

    Only the directory of the slice is listed, so an hourly batch does not pay for
    the age of the landing area; the partition predicate is kept on top.  The
    schema is declared: columns and arrays that files lack are NULL.  A slice
    that does not exist gives no rows, and two metrics if a ``Metrics`` is passed;
    any other failure is raised.  ``until`` (seconds since 1970) leaves out files that
    were modified at that moment or later: scans with the same ``until`` read the same
    files, whatever lands between them, and no file name reaches the driver's program.
    """
    bounds = slice_of(granularity, as_of)
    frame = _read(spark, root, schema, [slice_path(root, bounds)], source_file, until)
    if frame is None:
        if metrics is not None:
            missing(metrics, entity)
        return _nothing(spark, schema, source_file)
    condition = slice_filter(bounds)
    if condition is not None:
        frame = frame.where(condition)
    if where is not None:
        frame = frame.where(where)
    return frame


def with_partitions(schema: T.StructType) -> T.StructType:
    """A schema with the partition columns of the landing area."""
    names = {f.name.lower() for f in schema.fields}
    return T.StructType(schema.fields + [T.StructField(p, T.IntegerType()) for p in PARTITIONS if p not in names])


def missing(metrics: Metrics, entity: str) -> None:
    """The metrics of a slice or an area that is not there."""
    metrics.put("read_count", entity, 0)
    metrics.put("nop_read_error", entity, 1)


def delete_keys(docs: DataFrame, path: str, alias: str) -> DataFrame:
    """Natural keys of a delete feed, as they came: NULLs and copies included."""
    return docs.select(F.col(path).alias(alias))
