"""CSV feeds and their conversion to Parquet."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborload.functions.header import SOURCE_FILE
from arborload.operators.metrics import Metrics

DAMAGED = "damaged_line"
CsvTransform = Callable[[DataFrame, str], DataFrame]


def read_csv(spark: SparkSession, path: str, columns: Sequence[str] | T.StructType | None = None) -> DataFrame:
    """Comma-separated file with a header line; every column is a string.

    With ``columns`` no job is needed to look at the header, and the header is
    checked against them.
    """
    reader = spark.read.option("header", True).option("delimiter", ",")
    if columns is not None:
        if not isinstance(columns, T.StructType):
            columns = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        reader = reader.schema(columns).option("enforceSchema", False)
    return reader.csv(path)


def parsed_csv(spark: SparkSession, path: str, columns: Sequence[str] | T.StructType | None = None) -> DataFrame:
    """The file with a column ``damaged_line``: lines that don't fit the header, NULL for the others.

    A line is damaged if it has more or fewer fields than the header, or a field that is
    not of its declared type.  Without ``columns`` they are taken from the header.
    """
    declared = read_csv(spark, path, columns).schema
    reader = (
        spark.read.option("header", True)
        .option("delimiter", ",")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", DAMAGED)
        .option("columnPruning", False)
        .option("enforceSchema", False)
    )
    return reader.schema(T.StructType([*declared.fields, T.StructField(DAMAGED, T.StringType())])).csv(path)


def csv_to_parquet(
    spark: SparkSession,
    source: str,
    target: str,
    feed: str,
    run_id: str,
    transforms: Mapping[str, CsvTransform] | None = None,
    columns: Sequence[str] | T.StructType | None = None,
    metrics: Metrics | None = None,
    rejects: str | None = None,
) -> DataFrame:
    """Convert one feed and return the rows written.

    A feed without a transform passes through unchanged.  An empty result raises
    before anything at ``target`` is replaced.  Damaged lines are left out; they go to
    ``rejects`` (``<target>-rejects`` if not given) with what could be read of them, and
    are counted as ``rejected_rows`` if there are any.
    """
    lines = parsed_csv(spark, source, columns)
    frame = lines.where(f"{DAMAGED} IS NULL").drop(DAMAGED)
    change = (transforms or {}).get(feed)
    if change is not None:
        frame = change(frame, run_id)
    if not frame.take(1):  # Spark refuses to read the damaged lines alone, as isEmpty would
        raise ValueError(f"no rows for {feed}")
    damaged = lines.where(f"{DAMAGED} IS NOT NULL")
    if damaged.take(1):
        seen = Observation()
        lost = damaged.withColumn(SOURCE_FILE, F.col("_metadata.file_path")).observe(seen, F.count(F.lit(1)).alias("n"))
        lost.write.mode("overwrite").parquet(rejects or f"{target.rstrip('/')}-rejects")
        if metrics is not None:
            metrics.put("rejected_rows", feed, seen.get["n"])
    frame.write.mode("overwrite").parquet(target)
    return spark.read.schema(frame.schema).parquet(target)
