from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from arborload.functions import keys as K
from arborload.sinks.tables import BUCKET, Tables
from arborload.sources.scratch import directories


@pytest.fixture()
def tables(spark, scratch):
    return Tables(spark, f"t_{uuid.uuid4().hex[:8]}", f"{scratch}/tables", buckets=4)


def tree_rows(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "k bigint").coalesce(1)
    return rows.withColumn("root_key", F.expr(K.root_key("a", "k")))


def ks(frame):
    return sorted(r["k"] for r in frame.collect())


def test_append_by_name(spark, tables):
    tables.append(spark.createDataFrame([(1, "a")], "k int, v string"), "t")
    tables.append(spark.createDataFrame([("b", 2)], "V string, K int"), "t")
    tables.append(spark.createDataFrame([(3,)], "k int"), "t")
    assert sorted(map(tuple, tables.read("t").collect())) == [(1, "a"), (2, "b"), (3, None)]
    with pytest.raises(ValueError):
        tables.append(spark.createDataFrame([(4, 1)], "k int, z int"), "t")


def test_stage_has_the_columns_of_the_target(spark, tables):
    tables.append(spark.createDataFrame([(1, "a")], "k bigint, v string"), "t")
    for _ in range(2):
        name = tables.stage(spark.createDataFrame([("x", 2), ("x", 2)], "v string, k int"), "t")
    assert name == "stage_t"
    assert tables.read(name).dtypes == tables.read("t").dtypes
    assert tables.read(name).count() == 2
    tables.drop(name)
    tables.drop(name)
    assert not tables.exists(name)


def test_replace_reads_what_it_replaces(spark, tables):
    tables.append(spark.range(10).withColumnRenamed("id", "k"), "t")
    tables.replace("t", tables.read("t").where("k < 3"))
    assert ks(tables.read("t")) == [0, 1, 2]
    tables.replace("t", tables.read("t").where("false"))
    assert ks(tables.read("t")) == []


def test_tree_tables_are_partitioned_by_bucket(spark, tables):
    tables.append(tree_rows(spark, range(100)), "t")
    rows = tables.read("t")
    assert rows.where(F.col(BUCKET) != F.expr(K.bucket("root_key", 4))).isEmpty()
    plan = tables.in_buckets("t", [2])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(root_bucket" in plan


def keys_of(spark, values):
    rows = tree_rows(spark, values).select("root_key")
    return rows.selectExpr("root_key", f"{K.bucket('root_key', 4)} AS {BUCKET}")


def touched(keys):
    return [r[0] for r in keys.select(BUCKET).distinct().collect()]


def change(tables, spark, gone, fresh=None):
    """Prepare and apply; returns the buckets that were written anew."""
    keys = keys_of(spark, gone)
    with tables.changing("t") as folder:
        done = tables.prepare(folder, "t", keys, touched(keys), fresh)
        before = ks(tables.read("t"))
        tables.apply(folder, [done])
    return done.buckets, before


def test_only_buckets_with_a_row_to_remove_change(spark, tables):
    tables.append(tree_rows(spark, range(100)), "t")
    files = set(tables.read("t").inputFiles())
    home = {r["k"]: r[BUCKET] for r in tables.read("t").collect()}
    gone = [k for k in range(100) if home[k] in (1, 3)][:7]
    fresh = tree_rows(spark, [*gone[:2], *range(1000, 1020)])
    buckets, before = change(tables, spark, [*gone, 5000, 5001], fresh)
    assert before == list(range(100)), "not visible before it is applied"
    assert set(buckets) == {home[k] for k in gone}
    wanted = sorted(set(range(100)) - set(gone) | set(gone[:2]) | set(range(1000, 1020)))
    assert ks(tables.read("t")) == wanted
    same = {f for f in tables.read("t").inputFiles() if f in files}
    assert same == {f for f in files if not any(f"root_bucket={b}/" in f for b in buckets)}
    assert directories(spark, f"{tables.work}/changes/t") == {}


def test_unknown_keys_write_nothing_and_new_rows_are_appended(spark, tables):
    tables.append(tree_rows(spark, range(40)), "t")
    files = set(tables.read("t").inputFiles())
    assert change(tables, spark, range(500, 520))[0] == []
    assert set(tables.read("t").inputFiles()) == files
    change(tables, spark, range(500, 520), tree_rows(spark, range(500, 520)))
    assert files < set(tables.read("t").inputFiles())
    assert ks(tables.read("t")) == [*range(40), *range(500, 520)]


def test_a_bucket_that_becomes_empty_can_be_filled_again(spark, tables):
    tables.append(tree_rows(spark, range(40)), "t")
    gone = ks(tables.in_buckets("t", [2]))
    assert gone
    for _ in range(2):
        change(tables, spark, gone)
        assert ks(tables.read("t")) == [k for k in range(40) if k not in gone]
    assert 2 not in {r[BUCKET] for r in tables.read("t").collect()}
    change(tables, spark, gone, tree_rows(spark, gone))
    assert ks(tables.read("t")) == list(range(40))


def test_only_some_buckets_become_empty(spark, tables):
    tables.append(tree_rows(spark, range(40)), "t")
    gone = ks(tables.in_buckets("t", [2])) + ks(tables.in_buckets("t", [0]))[:1]
    change(tables, spark, gone)
    assert ks(tables.read("t")) == [k for k in range(40) if k not in gone]


@pytest.mark.parametrize("at", ["before", "while", "after"])
def test_a_change_that_dies_is_finished_or_forgotten(spark, tables, monkeypatch, at):
    """Killed before, while and after the buckets are overwritten, one of which becomes empty."""
    tables.append(tree_rows(spark, range(40)), "t")
    gone = ks(tables.in_buckets("t", [2])) + [k for k in ks(tables.in_buckets("t", [0]))][:2]
    fresh = tree_rows(spark, [gone[0], 900, 901])
    real = Tables._overwrite

    def dying(self, folder):
        if at == "while":
            name = self.name("t")
            self.spark.sql(f"ALTER TABLE {name} DROP PARTITION ({BUCKET}=0)")
        if at == "after":
            real(self, folder)
        raise KeyboardInterrupt

    if at == "before":
        monkeypatch.setattr(Tables, "_manifest", dying)
    monkeypatch.setattr(Tables, "_overwrite", dying)
    with pytest.raises(KeyboardInterrupt):
        change(tables, spark, [*gone, 900, 901], fresh)
    monkeypatch.undo()
    assert tables.recover("u") == [], "changes of other tables are left alone"
    assert len(tables.recover("t")) == 1 and tables.recover("t") == []
    rest = [k for k in range(40) if k not in gone]
    if at == "before":
        assert ks(tables.read("t")) == list(range(40))
    else:
        assert set(rest) <= set(ks(tables.read("t"))), "no row of another root is lost"
    change(tables, spark, [*gone, 900, 901], fresh)
    assert ks(tables.read("t")) == sorted([*rest, gone[0], 900, 901])


def test_rows_of_a_batch_are_purged(spark, tables):
    tables.append(tree_rows(spark, range(40)).selectExpr("*", "if(k < 5, 'x', if(k > 30, NULL, 'y')) AS batch_id"), "t")
    tables.append(spark.range(4).selectExpr("id AS k", "if(id = 1, 'x', 'y') AS batch_id"), "u")
    for _ in range(2):
        tables.purge("t", ["t", "u"], "batch_id = 'x'")
        assert ks(tables.read("t")) == list(range(5, 40)) and ks(tables.read("u")) == [0, 2, 3]


def test_tables_with_a_key_of_their_own_are_bucketed_by_it(spark, tables):
    rows = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k int, v string")
    tables.append(rows, "t", key="k")
    assert tables.bucketed_by("t") == "k" and tables.read("t").count() == 3
    keys = spark.createDataFrame([(1,), (None,)], "k int").selectExpr("k", f"{K.bucket('k', 4)} AS {BUCKET}")
    with tables.changing("t") as folder:
        tables.apply(folder, [tables.prepare(folder, "t", keys, range(4))])
    assert sorted(r["v"] for r in tables.read("t").collect()) == ["b", "c"], "a NULL key removes nothing"


def test_tables_keep_their_number_of_buckets(spark, scratch):
    database = f"t_{uuid.uuid4().hex[:8]}"
    few = Tables(spark, database, f"{scratch}/tables", buckets=2)
    few.append(tree_rows(spark, range(10)), "t")
    many = Tables(spark, database, f"{scratch}/tables", buckets=8)
    many.append(tree_rows(spark, range(10, 20)), "t")
    assert {r[0] for r in many.read("t").select(BUCKET).distinct().collect()} <= {0, 1}
    many.append(tree_rows(spark, range(10)), "u")
    with pytest.raises(ValueError, match="differ"):
        many.bucket_count("t", "u")
