"""Helpers of the corpus operators: shared scratch tables, columns, gapless numbers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"
SPACE = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see, from ``spark.checkpoint.dir``.

    A local session without the setting gets a folder of its own; on a cluster the
    setting is required.
    """
    context = spark.sparkContext
    base = context.getCheckpointDir() or context.getConf().get(CHECKPOINT_DIR)
    if base is None:
        if not context.master.startswith("local["):
            raise ValueError(f"{CHECKPOINT_DIR} must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="corpus-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(base)
    return base.rstrip("/")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors the library, for the operators that run Python in tasks."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = Path(__file__).parent.parent
    archive = os.path.join(tempfile.mkdtemp(prefix="corpus-"), "corpus_operators.zip")
    with zipfile.ZipFile(archive, "w") as file:
        for source in sorted(package.rglob("*.py")):
            file.write(source, source.relative_to(package.parent))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def settle(frame: DataFrame) -> DataFrame:
    """Compute a frame once and cut its lineage with a reliable checkpoint."""
    shared_dir(frame.sparkSession)
    return frame.checkpoint()


def shared_table(frame: DataFrame, name: str) -> DataFrame:
    """Write a small frame as Parquet below the shared folder and read it back.

    Spark then knows its true size: it broadcasts the table only where that size is
    below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles otherwise.
    """
    spark = frame.sparkSession
    path = f"{shared_dir(spark)}/corpus/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def require(frame: DataFrame, *columns: str) -> None:
    """Raise ``ValueError`` where a needed column is absent."""
    missing = [c for c in columns if c not in frame.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def without(frame: DataFrame, added: Iterable[str]) -> list[str]:
    """Columns of a frame that don't clash with added ones; Spark compares names without case."""
    taken = {c.lower() for c in added}
    return [c for c in frame.columns if c.lower() not in taken]


def text_key(text: Column) -> Column:
    """128 bits that stand for a text; NULL counts as its own text."""
    return F.md5(F.coalesce(F.concat(F.lit("t"), text), F.lit("n")))


def numbered(frame: DataFrame, by: list[str], order: list[str], buckets: int, name: str) -> DataFrame:
    """Number the rows of every group from 0 without gaps, no group in one task.

    A group is dealt by the hash of its ``order`` columns to ``buckets`` buckets; rows
    are numbered inside a bucket and moved by the sizes of the buckets before.  Rows
    that agree in ``order`` must be interchangeable.
    """
    part = "__bucket"
    dealt = frame.withColumn(part, F.pmod(F.xxhash64(*order), F.lit(buckets)))
    sizes = dealt.groupBy(*by, part).agg(F.count(F.lit(1)).alias("__size"))
    before = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("__start", F.coalesce(F.sum("__size").over(before), F.lit(0))).drop("__size")
    inside = Window.partitionBy(*by, part).orderBy(*order)
    rows = dealt.withColumn("__inside", F.row_number().over(inside) - 1)
    same = F.lit(True)
    for c in [*by, part]:
        same = same & rows[c].eqNullSafe(starts[c])
    joined = rows.join(starts, same, "inner")
    keep = [rows[c] for c in frame.columns]
    return joined.select(*keep, (rows["__inside"] + starts["__start"]).cast("long").alias(name))
