"""Time slices, missing input, delete feed, CSV, new files only."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborload.operators.metrics import Metrics
from arborload.queries import fixtures as X
from arborload.queries.registry import query
from arborload.sources.csv import csv_to_parquet
from arborload.sources.landing import Granularity, delete_keys, scan, scan_range
from arborload.streaming.incremental import append_batches, load_new_files

EVENT_COLUMNS = "event_id, ts, user_id, event_type, value, props"


def _slice(spark: SparkSession, sf: str, granularity: Granularity, where: str | None = None) -> DataFrame:
    path, schema = X.landed_events(spark, sf)
    rows = scan(spark, path, schema, granularity, X.AS_OF, where)
    return rows.select("year", "month", "day", "hour", "minute", *schema.fieldNames())


def _slice_sql(condition: str) -> str:
    return f"""
        WITH timed AS (
            SELECT *, TIMESTAMP '2024-01-30' + to_minutes(CAST(floor((
                date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) * 1440 + hour(ts) * 60 + minute(ts)
            ) / 10) AS BIGINT)) AS moment FROM events
        ),
        landed AS (
            SELECT *, CAST(year(moment) AS INT) AS year, CAST(month(moment) AS INT) AS month,
                   CAST(day(moment) AS INT) AS day, CAST(hour(moment) // 3 * 3 + 2 AS INT) AS hour,
                   CAST(minute(moment) // 20 * 20 AS INT) AS minute
            FROM timed
        )
        SELECT year, month, day, hour, minute, {EVENT_COLUMNS} FROM landed WHERE {condition}"""


@query("scan_yesterday", _slice_sql("month = 1 AND day = 31"))
def scan_yesterday(spark: SparkSession, sf: str) -> DataFrame:
    return _slice(spark, sf, Granularity.YESTERDAY)


@query("scan_today", _slice_sql("month = 2 AND day = 1"))
def scan_today(spark: SparkSession, sf: str) -> DataFrame:
    return _slice(spark, sf, Granularity.TODAY)


@query("scan_hour", _slice_sql("month = 1 AND day = 31 AND hour = 23"))
def scan_hour(spark: SparkSession, sf: str) -> DataFrame:
    return _slice(spark, sf, Granularity.HOUR)


@query("scan_all", _slice_sql("true"))
def scan_all(spark: SparkSession, sf: str) -> DataFrame:
    return _slice(spark, sf, Granularity.ALL)


@query(
    "scan_range",
    _slice_sql(
        "make_timestamp(year, month, day, hour, minute, 0) >= TIMESTAMP '2024-01-30 14:20:00' "
        "AND make_timestamp(year, month, day, hour, minute, 0) < TIMESTAMP '2024-02-01 02:40:00'"
    ),
)
def scan_range_query(spark: SparkSession, sf: str) -> DataFrame:
    """Any range of landing times, here over the end of a month, from few directories."""
    path, schema = X.landed_events(spark, sf)
    rows = scan_range(spark, path, schema, datetime(2024, 1, 30, 14, 20), datetime(2024, 2, 1, 2, 40))
    return rows.select("year", "month", "day", "hour", "minute", *schema.fieldNames())


@query("scan_filter", _slice_sql("event_type = 'error'"))
def scan_filter(spark: SparkSession, sf: str) -> DataFrame:
    return _slice(spark, sf, Granularity.ALL, "event_type = 'error'")


@query(
    "scan_missing",
    """
    SELECT 'read_count' AS metric, CAST(0 AS BIGINT) AS value
    UNION ALL SELECT 'nop_read_error', 1
    UNION ALL SELECT 'late_rows', 0
    UNION ALL SELECT 'rows', count(*) FROM events""",
)
def scan_missing(spark: SparkSession, sf: str) -> DataFrame:
    """A slice that was never landed, next to the whole area: no rows and two metrics."""
    path, schema = X.landed_events(spark, sf)
    metrics = Metrics(X.RUN_ID)
    never = datetime(2031, 1, 1)
    late = scan(spark, path, schema, Granularity.TODAY, never, metrics=metrics, entity="events")

    def total(rows: DataFrame, name: str) -> DataFrame:
        return rows.agg(F.count(F.lit(1)).alias("value")).select(F.lit(name).alias("metric"), "value")

    seen = metrics.to_df(spark).select("metric", "value")
    return seen.unionByName(total(late, "late_rows")).unionByName(total(scan(spark, path, schema), "rows"))


DELETE_KEYS_SQL = f"""
    SELECT c_custkey AS pncid FROM customer WHERE c_mktsegment = '{X.DELETED}'
    UNION ALL
    SELECT c_custkey FROM customer WHERE c_mktsegment = '{X.DELETED}' AND c_acctbal < 0
    UNION ALL SELECT -1 - s_suppkey FROM supplier
    UNION ALL SELECT CAST(NULL AS BIGINT) FROM region"""


@query("delete_feed", f"SELECT CAST(pncid AS VARCHAR) AS pncid FROM ({DELETE_KEYS_SQL})")
def delete_feed(spark: SparkSession, sf: str) -> DataFrame:
    docs = X.delete_feed(spark, sf)
    path = X.scratch_dir(spark, "deletes")
    X.land(docs, X.AS_OF, path)
    feed = scan(spark, path, docs.schema, Granularity.TODAY, X.AS_OF)
    return delete_keys(feed, "body.PNCID", "pncid").select(F.col("pncid").cast("string"))


@query(
    "csv_to_parquet",
    """
    SELECT 'lookup' AS feed, CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_mktsegment,
           CAST(NULL AS VARCHAR) AS job_run_id FROM customer
    UNION ALL
    SELECT 'person', CAST(c_custkey AS VARCHAR), upper(c_name), c_mktsegment, 'run-1' FROM customer""",
)
def csv_feed(spark: SparkSession, sf: str) -> DataFrame:
    """A feed without a transform passes through; a named one is changed."""
    rows = X.table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    source = X.scratch_dir(spark, "csv")
    rows.write.option("header", True).csv(source)

    def person(frame: DataFrame, run_id: str) -> DataFrame:
        return frame.withColumn("c_name", F.upper("c_name")).withColumn("job_run_id", F.lit(run_id))

    out = []
    for feed in ("lookup", "person"):
        target = X.scratch_dir(spark, f"csv-{feed}")
        done = csv_to_parquet(
            spark, source, target, feed, X.RUN_ID, {"person": person}, columns=rows.columns
        )
        out.append(done.withColumn("feed", F.lit(feed)))
    return out[0].unionByName(out[1], allowMissingColumns=True)


@query(
    "incremental_batch",
    f"""
    SELECT CASE WHEN event_type = 'error' THEN 3 ELSE 1 END AS run, {EVENT_COLUMNS} FROM events""",
)
def incremental_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Three runs over one landing area: the second finds nothing, the third the new files."""
    events = X.table(spark, sf, "events")
    landing, state = X.scratch_dir(spark, "stream-in"), X.scratch_dir(spark, "stream-state")
    target = X.scratch_dir(spark, "stream-out")

    def run(number: int) -> None:
        load_new_files(
            spark, landing, events.schema, state, append_batches(f"{target}/run={number}"), files_per_batch=4
        )

    events.where("event_type <> 'error'").write.mode("append").parquet(landing)
    run(1)
    run(2)
    events.where("event_type = 'error'").write.mode("append").parquet(landing)
    run(3)
    schema = T.StructType(
        [*events.schema.fields, T.StructField("run", T.IntegerType()), T.StructField("batch", T.IntegerType())]
    )
    return spark.read.schema(schema).parquet(target).select("run", *events.columns)
