from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import brute
import data
from arborload.functions import keys as K
from arborload.operators import changes, links, reports
from arborload.operators.flatten import flatten_all
from arborload.plans import nominal
from arborload.tree import Tree, id_column, link_column

TREE = data.small_tree()
SCHEMA = data.small_schema()
KEYS = [f"k{i}" for i in range(10)]
STAGED = ["k1", "k3", "k5", "k7", "n1", "n2"]


def tables(spark, keys, seed=1):
    flat = flatten_all(data.frame(spark, data.documents(keys, seed, SCHEMA), schema=SCHEMA), TREE)
    return {t: f.cache() for t, f in flat.items()}


def keys(spark, values):
    return spark.createDataFrame([(v,) for v in values], "PNCID string").coalesce(1)


def content(frames):
    return {t: brute.rows(f) for t, f in frames.items()}


def wanted(docs):
    return {t: brute.canon(rows) for t, rows in brute.flatten(docs, TREE).items()}


def assert_no_orphans(frames):
    for table in TREE.tables[1:]:
        parent = TREE.parent(table)
        known = frames[parent].select(F.col(link_column(table)).alias(id_column(parent)))
        assert frames[table].join(known, id_column(parent), "left_anti").isEmpty(), table


@pytest.fixture(scope="module")
def target(spark):
    return tables(spark, KEYS)


@pytest.fixture(scope="module")
def stage(spark):
    """Four known roots with new content and two new ones, each row twice."""
    flat = tables(spark, STAGED, seed=2)
    return {t: f.unionByName(f) for t, f in flat.items()}


@pytest.mark.parametrize("by", ["root_key", "links"])
def test_delete_removes_the_subtrees(spark, target, by):
    gone = ["k2", "k2", "k4", "unknown", None]
    left = changes.delete_tree(target, keys(spark, gone), TREE, by)
    docs = [d for d in data.documents(KEYS, 1, SCHEMA) if d["body"]["PNCID"] not in gone]
    assert content(left) == wanted(docs)
    assert_no_orphans(left)


@pytest.mark.parametrize("by", ["root_key", "links"])
def test_upsert_replaces_and_adds(spark, target, stage, by):
    done = changes.upsert_tree(target, stage, TREE, by)
    old = [d for d in data.documents(KEYS, 1, SCHEMA) if d["body"]["PNCID"] not in STAGED]
    assert content(done) == wanted(old + data.documents(STAGED, 2, SCHEMA))
    assert_no_orphans(done)


def test_upsert_twice_is_upsert_once(target, stage):
    once = {t: f.cache() for t, f in changes.upsert_tree(target, stage, TREE).items()}
    assert content(changes.upsert_tree(once, stage, TREE)) == content(once)


def test_delete_then_upsert_is_upsert(spark, target, stage):
    known = stage["person"].select("PNCID")
    after = changes.upsert_tree(changes.delete_tree(target, known, TREE), stage, TREE)
    assert content(after) == content(changes.upsert_tree(target, stage, TREE))


def test_root_key_and_links_find_the_same_link_rows(spark, target):
    gone = keys(spark, ["k1", "k9", None])
    walked = links.propagate(target, gone, TREE)
    direct = links.links_by_root(target, links.root_keys(gone, TREE), TREE)
    assert content(walked) == content(direct)


def test_reports_count_links_and_name_every_table(spark, target):
    found = links.propagate(target, keys(spark, ["k1", "k2", "k3"]), TREE)
    updates = {r["table"]: r["update_count"] for r in reports.update_counts(found, TREE).collect()}
    deletes = {r["table"]: r["delete_count"] for r in reports.delete_counts(found, TREE).collect()}
    assert set(updates) == set(deletes) == set(TREE.tables)
    assert updates["person"] == deletes["person"] == deletes["offence"] == deletes["note"] == 3
    rows = found["offence"].collect()
    assert updates["disposal"] == sum(r["disposal_fk"] is not None for r in rows)
    assert deletes["disposal"] == len(rows)


def test_reports_of_nothing_are_zero(spark, target):
    found = links.propagate(target, keys(spark, ["nobody"]), TREE)
    for report in (reports.update_counts(found, TREE), reports.delete_counts(found, TREE)):
        assert {r[1] for r in report.collect()} == {0}
        assert report.count() == len(TREE.tables)


def test_an_empty_leaf_table(spark, target, stage):
    empty = dict(target, disposal=target["disposal"].where("false"))
    done = changes.upsert_tree(empty, stage, TREE)
    staged = {tuple(r) for r in stage["disposal"].collect()}
    assert {tuple(r) for r in done["disposal"].collect()} == staged


def test_keys_that_match_nothing(spark, target):
    lost = links.unmatched_keys(keys(spark, ["k1", "zz", "zz", None]), target["person"], "PNCID")
    assert sorted(r[0] or "" for r in lost.collect()) == ["", "zz", "zz"]


def test_rows_without_key_survive_a_delete(spark):
    target = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k int, v string")
    gone = spark.createDataFrame([(1,), (None,)], "k int")
    assert sorted(r["v"] for r in changes.delete_by_key(target, gone, "k").collect()) == ["b", "c"]


def test_merge_keeps_copies_and_upsert_drops_them(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    stage = spark.createDataFrame([("x", 2), ("x", 2), ("y", 3)], "v string, K int")
    merged = sorted(tuple(r) for r in changes.merge_by_key(target, stage, "k").collect())
    assert merged == [(1, "a"), (2, "x"), (2, "x"), (3, "y")]
    upserted = sorted(tuple(r) for r in changes.upsert_by_key(target, stage, stage, "k").collect())
    assert upserted == [(1, "a"), (2, "x"), (3, "y")]


def test_one_root_holds_a_third_of_all_rows(spark):
    """A hot root among many, on both ways, with joins that really shuffle."""
    tree = Tree.of("a", "k", {"a": ["b"], "b": ["c"]})
    n = 3000
    owner = "CASE WHEN id % 3 = 0 THEN 0 ELSE id END"
    own, owned = K.digest("'a'", "id"), K.digest("'a'", owner)
    root = spark.range(n).selectExpr("id AS k", f"{K.link_key('b', own)} AS b_fk", f"{own} AS root_key")
    b = spark.range(n).selectExpr(
        f"{K.link_key('b', owned)} AS a_id",
        "id AS v",
        f"{K.link_key('c', 'id')} AS c_fk",
        f"{owned} AS root_key",
    )
    c = spark.range(n).selectExpr(
        f"{K.link_key('c', owner)} AS b_id", "id AS w", f"{owned} AS root_key"
    )
    targets = {"a": root, "b": b, "c": c}
    gone = spark.createDataFrame([(0,), (1,)], "k bigint")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        left = changes.delete_tree(targets, gone, tree)
        assert left["a"].count() == n - 2
        kept = {r["v"] for r in left["b"].collect()}
        assert kept == {i for i in range(n) if i % 3 and i != 1}
        assert left["c"].count() == n - 1000 - 1
        walked = changes.delete_tree(targets, gone, tree, "links")
        assert {r["v"] for r in walked["b"].collect()} == kept
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_unknown_way(spark, target):
    with pytest.raises(ValueError):
        changes.delete_tree(target, keys(spark, ["k1"]), TREE, "magic")


def test_the_second_branch_of_the_nominal_tree_takes_part(spark):
    tree = nominal.tree()
    docs = data.documents(["a", "b", "c"], 5)
    flat = flatten_all(data.frame(spark, docs), tree)
    left = changes.delete_tree(flat, keys(spark, ["b"]), tree, "links")
    rest = brute.flatten([d for d in docs if d["body"]["PNCID"] != "b"], tree)
    for table in ("oiconditions", "releasedetails", "mokeywordvictim", "occupation", "nominal"):
        assert brute.rows(left[table]) == brute.canon(rest[table]), table


def test_rows_whose_key_is_surely_kept_are_not_exchanged(spark, scratch, monkeypatch):
    """Of a large target only rows whose key may be in a key set, that is too large to broadcast, are shuffled."""
    keyed = "CASE WHEN id % 50 = 0 THEN NULL ELSE concat('k', id % 4000) END AS root_key"
    spark.range(40_000).selectExpr("id", keyed).write.parquet(f"{scratch}/rows")
    target = spark.read.parquet(f"{scratch}/rows")
    keys = spark.range(0, 8000, 4).selectExpr("concat('k', id) AS root_key").unionByName(spark.sql("SELECT NULL AS root_key"))
    settings = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = [spark.conf.get(s, None) for s in settings]
    for s in settings:
        spark.conf.set(s, "-1")
    try:
        left = changes.delete_by_many_keys(target, keys.unionByName(keys), "root_key")
        found = sorted(r["id"] for r in left.collect())
        assert found == [i for i in range(40_000) if i % 50 == 0 or i % 4]
        final = left._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        sure, checked = final.split("SortMergeJoin")
        assert "BroadcastHashJoin" in sure and "Exchange hashpartitioning(root_key" in checked
    finally:
        for s, value in zip(settings, before):
            spark.conf.unset(s) if value is None else spark.conf.set(s, value)
    monkeypatch.setattr(changes, "FILTER_WORDS", 1)
    assert sorted(r["id"] for r in changes.delete_by_many_keys(target, keys, "root_key").collect()) == found, "a full table"
