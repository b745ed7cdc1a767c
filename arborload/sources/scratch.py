"""Intermediate results of a run, kept next to the tables it loads."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Codec of all Parquet files: keys repeat along child rows, which it shrinks far more than Spark's default.
CODEC = "zstd"

_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
WRITERS = "spark.sql.maxConcurrentOutputFileWriters"
#: Buckets that a task writes side by side before it sorts the rest of its rows by bucket.
OPEN_FILES = 4
#: Tables of up to so many buckets are written without a shuffle by bucket: a task writes them all side by side.
FEW_BUCKETS = 8


@contextmanager
def tidy(spark: SparkSession, ordered: bool = False, buckets: int = 0) -> Iterator[None]:
    """Settings of a run, during which every write removes its shuffle files when it is done.

    A task that holds rows of few buckets, as after a shuffle by bucket, writes them without
    sorting them by bucket first, unless files are ``ordered``.  ``buckets`` is the largest
    number of buckets of the tables that are written.
    """
    writers = buckets if OPEN_FILES < buckets <= FEW_BUCKETS else OPEN_FILES
    settings = {_TIDY: "true"} | ({} if ordered else {WRITERS: str(writers)})
    before = {name: spark.conf.get(name, None) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def materialise(frame: DataFrame, folder: str, name: str) -> tuple[DataFrame, str]:
    """Write a frame that is used several times; returns it as read back, and its path.

    Reading it back cuts the lineage, survives lost executors and gives Spark a real
    size to choose joins by.  ``folder`` must be one that all executors see.
    """
    path = f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    frame.write.parquet(path, compression=CODEC)
    return frame.sparkSession.read.schema(frame.schema).parquet(path), path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a directory with the file system of its path."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or directory is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def directories(spark: SparkSession, path: str) -> dict[str, int]:
    """Directories below a path, with the time of their last change in milliseconds."""
    parent = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = parent.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(parent):
        return {}
    return {s.getPath().toString(): s.getModificationTime() for s in system.listStatus(parent) if s.isDirectory()}
