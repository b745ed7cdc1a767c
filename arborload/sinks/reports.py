"""Report files, one directory per run."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame


def report_path(base: str, kind: str, name: str, as_of: datetime | None = None) -> str:
    """``<base>/report_summary/<kind>/<name>_<yyyymmdd_HHMM>.csv`` (fixed values of the report layout)."""
    stamp = (as_of or datetime.now(timezone.utc)).strftime("%Y%m%d_%H%M")
    return f"{base.rstrip('/')}/report_summary/{kind}/{name}_{stamp}.csv"


def write_summary(counts: DataFrame, path: str) -> None:
    """One CSV file with a header; for aggregated counts, which have a row per table."""
    counts.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_rows(rows: DataFrame, path: str) -> None:
    """CSV files with a header for row-level reports; the partitions are kept."""
    rows.write.mode("overwrite").option("header", True).csv(path)
