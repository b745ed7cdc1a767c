from __future__ import annotations

import random
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arborload.operators.metrics import Metrics
from arborload.sources.landing import Granularity, cover, delete_keys, scan, scan_range, slice_of, slice_path

SCHEMA = T.StructType([T.StructField("v", T.LongType()), T.StructField("late", T.StringType())])


@pytest.fixture()
def area(spark, scratch):
    """Three hours around the turn of a year, in directories as they are landed."""
    for when, v in [
        ("year=2023/month=12/day=31/hour=22/minute=40", 1),
        ("year=2023/month=12/day=31/hour=23/minute=00", 2),
        ("year=2023/month=12/day=31/hour=23/minute=20", 3),
        ("year=2024/month=01/day=01/hour=00/minute=00", 4),
    ]:
        spark.range(1).select(F.lit(v).cast("long").alias("v")).write.parquet(f"{scratch}/area/{when}")
    return f"{scratch}/area"


def values(frame):
    return sorted(r["v"] for r in frame.collect())


def test_slices_cross_the_turn_of_the_year(spark, area):
    now = datetime(2024, 1, 1, 0, 10)
    assert values(scan(spark, area, SCHEMA, "yesterday", now)) == [1, 2, 3]
    assert values(scan(spark, area, SCHEMA, "today", now)) == [4]
    assert values(scan(spark, area, SCHEMA, "hour", now)) == [2, 3]
    assert values(scan(spark, area, SCHEMA, "all", now)) == [1, 2, 3, 4]


def test_bounds():
    assert slice_of("hour", datetime(2024, 3, 1, 0, 59)) == {"year": 2024, "month": 2, "day": 29, "hour": 23}
    assert slice_of("yesterday", datetime(2024, 1, 1)) == {"year": 2023, "month": 12, "day": 31}
    assert slice_of("all") == {}
    assert slice_path("x/", {"year": 2024, "month": 2}) == "x/year=2024/month=02"
    with pytest.raises(ValueError):
        slice_of("week")


def test_columns_do_not_depend_on_the_granularity(spark, area):
    now = datetime(2024, 1, 1, 0, 10)
    names = {g: scan(spark, area, SCHEMA, g, now).columns for g in Granularity}
    assert set(map(tuple, names.values())) == {("v", "late", "year", "month", "day", "hour", "minute")}
    row = scan(spark, area, SCHEMA, "today", now).first()
    assert (row["late"], row["month"], row["minute"]) == (None, 1, 0)


def test_a_slice_is_pruned_and_filters_reach_the_scan(spark, area):
    frame = scan(spark, area, SCHEMA, "hour", datetime(2024, 1, 1, 0, 10), where="v > 2")
    assert values(frame) == [3]
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    assert "GreaterThan(v,2)" in plan
    assert all("hour=23" in f for f in frame.inputFiles())


def test_missing_input_is_empty_and_reported(spark, area):
    metrics = Metrics("r")
    never = scan(
        spark, area, SCHEMA, "today", datetime(2030, 1, 1), source_file=True, metrics=metrics, entity="e"
    )
    assert never.count() == 0
    assert "source_file" in never.columns
    assert [r[:2] + r[3:4] for r in metrics.records()] == [("read_count", "e", 0), ("nop_read_error", "e", 1)]


def test_other_failures_are_raised(spark, area):
    with pytest.raises(AnalysisException):
        scan(spark, area, SCHEMA, where="no_such_column = 1").collect()


def test_the_source_file_survives_a_shuffle(spark, area):
    rows = scan(spark, area, SCHEMA, source_file=True).repartition(3).collect()
    assert all(r["source_file"].endswith(".parquet") for r in rows)


def test_delete_keys_keep_nulls_and_copies(spark):
    docs = spark.createDataFrame([((1,),), ((1,),), ((None,),), (None,)], "body struct<PNCID:int>")
    assert [r["pncid"] for r in delete_keys(docs, "body.PNCID", "pncid").collect()] == [1, 1, None, None]


def test_a_range_is_covered_by_the_fewest_directories():
    found = cover(datetime(2022, 11, 30, 22, 15), datetime(2024, 2, 2, 1, 0))
    assert [slice_path("x", b).removeprefix("x/") for b in found] == [
        "year=2022/month=11/day=30/hour=22",
        "year=2022/month=11/day=30/hour=23",
        "year=2022/month=12",
        "year=2023",
        "year=2024/month=01",
        "year=2024/month=02/day=01",
        "year=2024/month=02/day=02/hour=00",
    ]
    assert cover(datetime(2024, 2, 29, 23, 59), datetime(2024, 3, 1, 0, 0)) == [{"year": 2024, "month": 2, "day": 29, "hour": 23}]
    assert cover(datetime(2024, 1, 1), datetime(2025, 1, 1)) == [{"year": 2024}]
    assert cover(datetime(2024, 1, 1, 5, 10), datetime(2024, 1, 1, 5, 20)) == [{"year": 2024, "month": 1, "day": 1, "hour": 5}]
    rng = random.Random(1)
    for _ in range(50):
        start = datetime(2023, 1, 1) + timedelta(minutes=rng.randrange(800_000))
        end = start + timedelta(minutes=rng.randrange(1, 200_000))
        hours = set()
        for b in cover(start, end):
            first = datetime(*[*b.values(), 1, 1][: max(3, len(b))])
            last = {1: lambda t: t.replace(year=t.year + 1), 2: lambda t: (t + timedelta(days=32)).replace(day=1)}
            stop = last.get(len(b), lambda t, n=len(b): t + (timedelta(days=1) if n == 3 else timedelta(hours=1)))(first)
            span = {first + timedelta(hours=h) for h in range(int((stop - first).total_seconds()) // 3600)}
            assert not span & hours
            hours |= span
        first = start.replace(minute=0)
        assert min(hours) == first and max(hours) < end <= max(hours) + timedelta(hours=1)
        assert len(hours) == (max(hours) - first).total_seconds() // 3600 + 1


def test_ranges(spark, area):
    def between(start, end, **more):
        return scan_range(spark, area, SCHEMA, datetime(*start), datetime(*end), **more)

    assert values(between((2023, 12, 31, 23, 0), (2024, 1, 1, 0, 1))) == [2, 3, 4]
    assert values(between((2023, 12, 31, 22, 41), (2023, 12, 31, 23, 20))) == [2]
    assert values(between((2023, 1, 1), (2025, 1, 1))) == [1, 2, 3, 4]
    frame = between((2023, 12, 31, 23, 10), (2024, 1, 1), source_file=True)
    assert values(frame) == [3] and all("day=31/hour=23" in f for f in frame.inputFiles())
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "make_timestamp" in plan.split("PartitionFilters: ")[1].split("]")[0]
    aware = scan_range(spark, area, SCHEMA, datetime(2024, 1, 1, 1, tzinfo=timezone(timedelta(hours=1))), datetime(2024, 1, 2))
    assert values(aware) == [4]
    metrics = Metrics("r")
    assert between((2030, 1, 1), (2030, 2, 1), metrics=metrics, entity="e").count() == 0
    assert [r[0] for r in metrics.records()] == ["read_count", "nop_read_error"]
    with pytest.raises(ValueError, match="empty range"):
        between((2024, 1, 1), (2024, 1, 1))


def test_files_that_land_later_are_left_out(spark, area):
    moment = time.time() + 0.2
    time.sleep(0.4)
    spark.range(1).select(F.lit(9).cast("long").alias("v")).write.mode("append").parquet(
        f"{area}/year=2024/month=01/day=01/hour=00/minute=00"
    )
    now = datetime(2024, 1, 1, 0, 10)
    for found in (
        scan(spark, area, SCHEMA, "today", now, until=moment),
        scan_range(spark, area, SCHEMA, datetime(2024, 1, 1), datetime(2024, 1, 2), until=moment),
    ):
        assert values(found) == [4]
    assert values(scan(spark, area, SCHEMA, "today", now)) == [4, 9]
