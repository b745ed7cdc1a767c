from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from arborload.operators import quality

ROWS = [(1, "a", None)] * 5 + [(1, "a", 2.0), (1, "a", 2.0), (2, "b", None), (None, None, None), (None, None, None)]


@pytest.fixture()
def frame(spark):
    return spark.createDataFrame(ROWS, "k int, s string, d double").repartition(4)


def test_duplicates_match_a_window(frame):
    from pyspark.sql import Window

    whole = Window.partitionBy("k", "s", "d")
    wanted = frame.withColumn("n", F.count("*").over(whole)).where("n > 1").drop("n")
    key = lambda rows: sorted(map(repr, rows))
    assert key(quality.duplicate_rows(frame).collect()) == key(wanted.collect())
    assert sorted(r["dup_count"] for r in quality.duplicate_groups(frame).collect()) == [2, 2, 5]


def test_dedupe(frame):
    assert quality.dedupe(frame).count() == 4
    assert quality.dedupe(frame).columns == frame.columns


def test_volatile_columns_keep_their_smallest_value(frame):
    stamped = frame.withColumn("file", F.concat(F.lit("f"), F.monotonically_increasing_id()))
    rows = quality.dedupe(stamped, ["FILE"])
    assert rows.count() == 4
    assert rows.columns == stamped.columns


def test_dedupe_observes(frame):
    seen = Observation()
    quality.dedupe(frame, observe=seen).write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows_read": 10, "rows_kept": 4, "rows_repeated": 3}


def test_grouping_does_not_inherit_a_partitioning(spark, frame):
    """Rows already gathered by one column are spread again by the whole row."""
    gathered = frame.repartition(4, "k")
    plan = quality.distinct_rows(gathered)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_maps_are_rejected(spark):
    frame = spark.sql("SELECT map('a', 1) AS m")
    for operator in (quality.dedupe, quality.duplicate_rows, quality.distinct_rows):
        with pytest.raises(ValueError, match="to_json"):
            operator(frame)


def test_latest_per_key(spark):
    frame = spark.createDataFrame(
        [(1, 5, "a"), (1, 7, "b"), (1, 7, "c"), (2, None, "d"), (2, 1, "e"), (None, 1, "f")],
        "k int, ts int, id string",
    )
    latest = quality.latest_per_key(frame, ["k"], ["ts", "id"])
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert sorted((r["k"] or 0, r["id"]) for r in latest.collect()) == [(0, "f"), (1, "c"), (2, "e")]


def _kept(scratch):
    from arborload.sources.scratch import materialise

    return lambda frame: materialise(frame, scratch, "digests")[0]


def _wide(spark, copies=300):
    rows = [(i, f"v{i % 7}", None if i % 5 else 0.5, f"file{i}") for i in range(400)]
    rows += [(i, f"v{i % 7}", None if i % 5 else 0.5, f"again{i}") for i in range(0, 400, 40)]
    rows += [(3, "v3", None, f"hot{i}") for i in range(copies)] + [(None, "", -0.0, "a"), (None, "", 0.0, "b"), (None, None, 0.0, "c")]
    return spark.createDataFrame(rows, "k int, v string, x double, File string").repartition(4)


@pytest.mark.parametrize("collide", [False, True])
def test_digest_first_equals_whole_rows(spark, scratch, collide):
    """Also if all rows of a key modulo three share one digest."""
    frame = _wide(spark)
    forced = (lambda columns: (F.coalesce("k", F.lit(0)) % 3).cast("string").cast("binary")) if collide else None
    for volatile in ((), ("file",)):
        first, second = Observation(), Observation()
        plain = quality.dedupe(frame, volatile, first)
        quick = quality.dedupe_by_digest(frame, _kept(scratch), volatile, second, forced)
        assert quick.columns == frame.columns
        assert Counter(map(tuple, quick.collect())) == Counter(map(tuple, plain.collect()))
        assert first.get == second.get


def test_rows_without_a_copy_are_not_exchanged(spark, scratch):
    frame = spark.createDataFrame([(i % 990, "x" * 50) for i in range(1000)], "k int, v string")
    kept = quality.dedupe_by_digest(frame, _kept(scratch))
    assert kept.count() == 990
    plan = kept._jdf.queryExecution().executedPlan().toString()
    single, several = plan.split("LeftAnti")[1].split("LeftSemi")
    assert "BroadcastExchange" in single and "hashpartitioning" not in single.split("HashAggregate")[0]
    assert plan.count("Exchange hashpartitioning") == 1, "only rows under a repeated digest"
