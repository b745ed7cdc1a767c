"""New files only: a file stream that runs until the landing area is exhausted."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborload.functions.header import SOURCE_FILE
from arborload.operators.flatten import flatten_all
from arborload.sources.scratch import exists
from arborload.tree import Tree

Apply = Callable[[DataFrame, int], None]


def load_new_files(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    checkpoint: str,
    apply: Apply,
    files_per_batch: int | None = None,
) -> int:
    """Hand all files that earlier runs have not seen to ``apply``; returns the rows seen.

    The checkpoint remembers the files.  A batch that failed half-way is repeated
    with the same id, so ``apply`` has to replace what it wrote for that id.  The rows
    are counted batch by batch from the footers of the files.
    """
    counts: dict[int, int] = {}

    def counted(batch: DataFrame, batch_id: int) -> None:
        apply(batch, batch_id)
        counts[batch_id] = batch.count()

    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    query = (
        reader.parquet(landing)
        .writeStream.foreachBatch(counted)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(counts.values())


def load_batches(
    spark: SparkSession,
    landing: str,
    schema: T.StructType,
    checkpoint: str,
    apply: Apply,
    files_per_batch: int = 1000,
) -> bool:
    """Hand the rows of all files that earlier runs have not seen to ``apply``, batch by batch.

    The rows carry the name of their file in ``source_file``; no list of names reaches the
    program.  A batch that failed is repeated with the same files and number.  Returns
    whether the landing area exists.
    """
    if not exists(spark, landing):
        return False
    query = (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(landing)
        .select("*", F.col("_metadata.file_path").alias(SOURCE_FILE))
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return True


def append_batches(target: str) -> Apply:
    """Write each batch to its own ``batch=<id>`` directory, replacing it when repeated."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return apply


def flatten_batches(target: str, tree: Tree) -> Apply:
    """Flatten each batch into ``<target>/<table>/batch=<id>``."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        for table, rows in flatten_all(batch, tree).items():
            rows.write.mode("overwrite").parquet(f"{target}/{table}/batch={batch_id}")

    return apply
