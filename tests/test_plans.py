"""Plans of the registered queries: what must not be in them, and what must."""

from __future__ import annotations

import pytest

import __spark_entry__  # noqa: F401  (registers the queries)
from arborload.functions import keys as K
from arborload.operators import changes
from arborload.queries import fixtures
from arborload.queries.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
# These only read back tables that the query has already written.
WRITING = {"csv_to_parquet", "incremental_batch", "table_read", "table_append", "table_replace"}
LAZY = sorted(n for n in QUERIES if not n.startswith(("load_", "batch_")) and n not in WRITING)


def plan(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas", "CollectLimit"):
        assert word not in text, word


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


def test_two_columns_of_a_wide_table_are_read(spark):
    text = plan(QUERIES["keys_child"](spark, SF))
    assert "o_totalprice" not in text and "l_shipdate" not in text


def test_a_hot_key_is_split_between_tasks(spark, scratch):
    """With a shuffled join, the partition that holds a third of the rows is divided."""
    n = 200_000
    owner = "CASE WHEN id % 3 = 0 THEN 0 ELSE id END"
    rows = f"{scratch}/rows"
    spark.range(0, n, 1, 8).selectExpr(
        "id", f"{K.root_key('a', owner)} AS root_key", "repeat(md5(CAST(id AS STRING)), 2) AS fill"
    ).write.parquet(rows)
    target = spark.read.parquet(rows)
    gone = spark.range(n).where("id % 7 = 1").selectExpr(f"{K.root_key('a', 'id')} AS root_key")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        left = changes.delete_by_key(target, gone, "root_key")
        assert len(left.collect()) == sum(1 for i in range(n) if i % 3 == 0 or i % 7 != 1)
        assert "skew=true" in plan(left)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", ["report_updates", "report_deletes", "delete_links_deep", "keys_deep"])
def test_a_level_of_links_is_walked_once(spark, name):
    text = plan(QUERIES[name](spark, SF))
    for table in ("customer", "orders", "lineitem"):
        if not (name == "delete_links_deep" and table == "lineitem"):
            assert text.count(f"{table}.parquet") == 0, "only the written levels are read"


def test_children_are_counted_before_they_are_joined(spark):
    """A row per link is joined with the parents, and no joined row is sorted to be counted."""
    text = QUERIES["flatten_links"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    lines = [line.lstrip(" :+-") for line in text.splitlines()]
    joins = [i for i, line in enumerate(lines) if line.startswith("Join LeftOuter")]
    assert len(joins) == 3 and all(lines[i + 1].startswith("Aggregate") for i in joins)


def test_rows_of_one_moment_land_unsorted(spark, scratch):
    """They go straight into the directory, so no partition column has to be sorted by."""
    frame = spark.range(10).toDF("id")
    fixtures.land(frame.unionByName(frame), fixtures.AS_OF, f"{scratch}/area")
    found = spark.read.parquet(f"{scratch}/area")
    assert {tuple(r) for r in found.select("year", "month", "day", "hour", "minute").distinct().collect()} == {(2024, 2, 1, 2, 0)}
    assert found.count() == 20 and not [f for f in found.inputFiles() if "hour=02/minute=00" not in f]
