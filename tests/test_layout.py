"""Layouts that let a lookup skip row groups, and a join leave the target where it is."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from arborload.functions import keys as K
from arborload.operators.changes import delete_by_key, upsert_by_key
from arborload.operators.links import matched
from arborload.sinks import tables as module
from arborload.sinks.tables import Tables


def rows(spark, n):
    return spark.range(n).withColumn("root_key", F.expr(K.root_key("a", "id"))).withColumn("v", F.sha2("root_key", 512))


def keys_of(spark, ids):
    return spark.createDataFrame([(i,) for i in ids], "id long").select(F.expr(K.root_key("a", "id")).alias("root_key"))


def scanned(frame):
    """Rows that the scans of a frame give, after row groups are skipped."""
    plan = frame._jdf.queryExecution().executedPlan()
    frame.collect()

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        total = int(node.metrics().get("numOutputRows").get().value()) if name.startswith("Scan parquet") else 0
        children = node.children()
        return total + sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(frame._jdf.queryExecution().executedPlan() if plan is None else plan)


@pytest.fixture()
def small_groups(spark):
    """Row groups of a few hundred rows."""
    hadoop = spark._jsc.hadoopConfiguration()
    names = {"parquet.block.size": "32768", "parquet.page.size": "4096", "parquet.block.size.row.check.min": "100"}
    for name, value in names.items():
        hadoop.set(name, value)
    yield
    for name in names:
        hadoop.unset(name)


def make(spark, scratch, indexed):
    tables = Tables(spark, f"x_{uuid.uuid4().hex[:8]}", f"{scratch}/{indexed}", buckets=2, indexed=indexed)
    tables.append(rows(spark, 20_000).repartition(4, "v"), "t")
    return tables


def test_lookups_skip_row_groups(spark, scratch, small_groups):
    wanted = keys_of(spark, [3, 4_000, 19_999, 50_000])
    read = {}
    for indexed in (False, True):
        found = make(spark, scratch, indexed).lookup("t", wanted)
        assert sorted(r["id"] for r in found.collect()) == [3, 4_000, 19_999]
        read[indexed] = scanned(found)
    assert read[False] > 5_000 and read[False] > 10 * read[True] > 0, read


def test_bloom_filters_are_written_and_survive_changes(spark, scratch, small_groups):
    tables = make(spark, scratch, True)
    for wanted in ([5, 6], [30_000]):
        keys = keys_of(spark, wanted).selectExpr("root_key", f"{K.bucket('root_key', 2)} AS {module.BUCKET}")
        fresh = rows(spark, 30_001).where(F.col("id").isin(wanted)).withColumn("v", F.lit("new"))
        with tables.changing("t") as folder:
            tables.apply(folder, [tables.prepare(folder, "t", keys, range(2), fresh)])
    found = tables.lookup("t", keys_of(spark, [5, 7, 30_000]))
    assert sorted((r["id"], r["v"] == "new") for r in found.collect()) == [(5, True), (7, False), (30_000, True)]
    assert scanned(found) < 4_000
    assert tables.read("t").count() == 20_001
    absent = tables.read("t").where(F.col("root_key").isin([f"{i:032x}" for i in range(5)]))
    assert scanned(absent) == 0, "the filters rule out keys between the bounds of a row group"


def test_many_keys_are_joined(spark, scratch, monkeypatch):
    tables = make(spark, scratch, True)
    monkeypatch.setattr(module, "LOOKUP_KEYS", 2)
    keys = keys_of(spark, [1, 2, 3, 3]).union(spark.createDataFrame([(None,)], "root_key string"))
    assert sorted(r["id"] for r in tables.lookup("t", keys).collect()) == [1, 2, 3]
    assert tables.lookup("t", keys.where("false")).count() == 0


def exchanges_above_scan(frame, table):
    """Exchanges between the scan of a table and the top of the plan."""
    plan = frame._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    at = next(i for i, line in enumerate(lines) if "FileScan" in line and f".{table}[" in line)
    depth, found = lines[at].index("FileScan"), []
    for line in reversed(lines[:at]):
        begin = next((i for i, c in enumerate(line) if c.isalpha() or c in "*("), len(line))
        if begin < depth:
            depth = begin
            if "Exchange" in line:
                found.append(line.strip())
    return found


def test_a_clustered_target_is_not_exchanged(spark, scratch):
    tables = Tables(spark, f"x_{uuid.uuid4().hex[:8]}", scratch)
    whole = rows(spark, 5_000)
    target = tables.cluster("t", whole, "root_key", 4)
    keys, stage = keys_of(spark, range(0, 5_000, 2)), whole.where("id % 2 = 0").withColumn("v", F.lit("n"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for frame in (delete_by_key(target, keys, "root_key"), matched(target, keys, "root_key")):
            assert exchanges_above_scan(frame, "t") == []
            plan = frame._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Bucketed: true" in plan
            assert plan.count("Exchange") == plan.split("Bucketed: true")[1].count("Exchange") > 0, "only on the key side"
        plain = delete_by_key(whole, keys, "root_key")
        assert plain.count() == delete_by_key(target, keys, "root_key").count() == 2_500
        assert upsert_by_key(target, stage, keys, "root_key").where("v = 'n'").count() == 2_500
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_large_tables_are_clustered_into_more_buckets(spark, scratch, monkeypatch):
    monkeypatch.setattr("arborload.sinks.tables.CLUSTER_ROWS", 1_000)
    tables = Tables(spark, f"x_{uuid.uuid4().hex[:8]}", scratch)
    target = tables.cluster("t", rows(spark, 5_500), "root_key", 4)
    found = spark.sql(f"DESCRIBE EXTENDED {tables.name('t')}").where("col_name = 'Num Buckets'").first()
    assert found["data_type"] == "6" and target.count() == 5_500
