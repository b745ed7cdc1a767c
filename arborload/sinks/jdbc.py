"""JDBC append and parallel read."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def write_jdbc(
    frame: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str] | None = None,
    connections: int = 16,
    batch_rows: int = 10_000,
) -> None:
    """Append rows to a database table over at most ``connections`` connections."""
    options = {"batchsize": str(batch_rows), "numPartitions": str(connections), **(properties or {})}
    frame.write.mode("append").jdbc(url, table, properties=options)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    lower: int | str,
    upper: int | str,
    partitions: int = 64,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """Read a whole table in parallel, split on a numeric or date column.

    The bounds only shape the ranges; rows outside them are read as well.
    """
    return spark.read.jdbc(
        url,
        table,
        column=column,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties={"fetchsize": "10000", **(properties or {})},
    )
