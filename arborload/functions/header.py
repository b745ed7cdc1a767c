"""Audit header placed in front of a projected root table."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

SOURCE_FILE = "source_file"

# Output column -> header field.
HEADER_FIELDS = {
    "cdlz_header_record_hash_b64": "recordHash",
    "cdlz_header_data_feed_id": "dataFeedId",
    "cdlz_header_collect_data_feed_task_id": "collectDataFeedTaskId",
    "cdlz_header_ingest_data_feed_task_id": "ingestDataFeedTaskId",
    "cdlz_header_collection_date": "collectionDate",
    "cdlz_header_ingest_date_time": "ingestDateTime",
    "cdlz_header_data_format": "dataFormat",
    "cdlz_header_source_filename": "sourceFilename",
    "cdlz_header_source_zip_archive": "sourceZipArchive",
}
LOAD_TIME = "glue_timestamp"
INPUT_FILE = "input_filename"

VOLATILE = (LOAD_TIME, INPUT_FILE)


def base64_line(value: Column) -> Column:
    """base64 without the line breaks Spark inserts into long values."""
    return F.regexp_replace(F.base64(value), "[\r\n]", "")


def _load_time(as_of: datetime | None) -> Column:
    if as_of is None:
        return F.current_timestamp()
    return F.lit(as_of if as_of.tzinfo else as_of.replace(tzinfo=timezone.utc))


def audit_header(flattened: bool, as_of: datetime | None = None, file: Column | None = None) -> list[Column]:
    """Header columns, read from ``header.*`` or from top-level columns if ``flattened``.

    An empty archive name is NULL only in the flattened form.  ``as_of`` fixes the
    load time (UTC if it has no zone); without it the start of the query is used.  The input file is the
    path captured by the scan, which unlike ``input_file_name()`` survives
    explodes and shuffles.
    """
    out = []
    for name, source in HEADER_FIELDS.items():
        value = F.col(source if flattened else f"header.{source}")
        if source == "recordHash":
            value = base64_line(value)
        elif source == "sourceZipArchive" and flattened:
            value = F.nullif(value, F.lit(""))
        out.append(value.alias(name))
    out.append(_load_time(as_of).alias(LOAD_TIME))
    out.append((F.col(SOURCE_FILE) if file is None else file).alias(INPUT_FILE))
    return out
