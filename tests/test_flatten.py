from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import brute
import data
from arborload.operators.flatten import flatten, flatten_all, flatten_from, rejects
from arborload.plans import nominal
from arborload.tree import Tree


def test_nominal_matches_brute_force(spark):
    docs = data.documents([f"k{i}" for i in range(12)] + [None])
    tree = nominal.tree()
    wanted = brute.flatten(docs, tree)
    got = flatten_all(data.frame(spark, docs), tree)
    for table in tree.tables:
        assert wanted[table], table
        assert brute.rows(got[table]) == brute.canon(wanted[table]), table


def test_documents_without_key_are_set_apart(spark):
    docs = data.documents(["a", None, None])
    frame = data.frame(spark, docs)
    tree = nominal.tree()
    assert rejects(frame, tree).count() == 2
    assert flatten(frame, tree, "nominal").count() == 1


def test_narrow_scans_give_the_same_tables_and_read_less(spark, scratch):
    docs = data.documents([f"k{i}" for i in range(8)])
    data.frame(spark, docs).write.parquet(f"{scratch}/docs")
    tree, schema = nominal.tree(), nominal.document_schema()
    got = flatten_from(lambda s, root: spark.read.schema(s).parquet(f"{scratch}/docs"), tree, schema)
    wanted = brute.flatten(docs, tree)
    for table in ("nominal", "caseheader", "offence", "releasedetails"):
        assert brute.rows(got[table]) == brute.canon(wanted[table]), table
    plan = got["releasedetails"]._jdf.queryExecution().executedPlan().toString()
    read = plan[plan.index("ReadSchema") :]
    assert "ReleaseDate" in read and "PNCID" in read
    assert "DisposalType" not in read and "CourtName" not in read and "recordHash" not in read


def test_nested_arrays_and_maps_match_brute_force(spark, scratch):
    full = T._parse_datatype_string(
        "id int, x array<array<int>>, y array<array<array<struct<v:string>>>>, m map<string,int>, "
        "n map<int,struct<a:int,z:array<string>>>, o array<map<string,array<int>>>"
    )
    docs = [
        dict(id=1, x=[[1, 2], [], None, [3, None]], y=[[[{"v": "a"}, {"v": None}], []], [[{"v": "b"}]]], m={"k": 1, "l": None},
             n={7: {"a": 1, "z": ["p", "q"]}, 8: None, 9: {"a": None, "z": []}}, o=[{"s": [1, 2], "t": None}, {}, None]),
        dict(id=2, x=[], y=None, m={}, n=None, o=[]),
        dict(id=3, x=None, y=[None, [None, [None]]], m=None, n={}, o=[{"u": [5]}]),
        dict(id=None, x=[[1]], y=[], m={"k": 1}, n=None, o=None),
    ]
    tree = Tree.from_schema("doc", "id", full)
    spark.createDataFrame(docs, full).write.parquet(f"{scratch}/docs")
    wanted = brute.flatten(docs, tree)
    got = flatten_from(lambda s, root: spark.read.schema(s).parquet(f"{scratch}/docs"), tree, full)
    for table in tree.tables:
        assert wanted[table], table
        assert brute.rows(got[table]) == brute.canon(wanted[table]), table


def test_columns_and_arrays_absent_from_the_files(spark, scratch):
    full = T._parse_datatype_string(
        "body struct<id:bigint, name:string, x array<struct<v:string, n:int, y array<struct<z:int>>>>, w array<struct<q:string>>>"
    )
    old = T._parse_datatype_string("body struct<ID:bigint, x array<struct<v:string>>>")
    spark.createDataFrame([((1, [("a",), ("b",)]),), ((2, None),), ((3, []),)], old).coalesce(1).write.parquet(
        f"{scratch}/old"
    )
    tree = Tree.from_schema("doc", "id", full)
    got = flatten_from(lambda s, root: spark.read.schema(s).parquet(f"{scratch}/old"), tree, full)
    root = {r["id"]: r for r in got["doc"].collect()}
    assert set(root) == {1, 2, 3}
    assert root[1]["name"] is None and root[1]["w_fk"] is None
    assert root[1]["x_fk"] is not None and root[2]["x_fk"] is None and root[3]["x_fk"] is None
    assert [(r["pos"], r["v"], r["n"], r["y_fk"]) for r in got["x"].orderBy("pos").collect()] == [
        (0, "a", None, None),
        (1, "b", None, None),
    ]
    assert got["y"].count() == 0 and got["w"].count() == 0


def test_arrays_of_values(spark):
    schema = T._parse_datatype_string("id int, tags array<string>")
    tree = Tree.from_schema("doc", "id", schema)
    frame = spark.createDataFrame([(1, ["a", None]), (2, [])], schema)
    rows = flatten(frame, tree, "tags").orderBy("pos").collect()
    assert [(r["pos"], r["val"]) for r in rows] == [(0, "a"), (1, None)]
    root = {r["id"]: r["tags_fk"] for r in flatten(frame, tree, "doc").collect()}
    assert root[1] == rows[0]["doc_id"] and root[2] is None


def test_versions_of_a_root_keep_their_own_subtrees(spark):
    schema = T._parse_datatype_string("id int, v string, x array<struct<a:int>>")
    docs = spark.createDataFrame([(1, "one", [(1,)]), (1, "two", [(2,)]), (1, None, [(3,)])], schema)
    mixed = Tree.from_schema("doc", "id", schema)
    apart = Tree.from_schema("doc", "id", schema, version=["v"])
    assert flatten(docs, mixed, "x").select("doc_id").distinct().count() == 1
    rows = flatten(docs, apart, "x")
    assert rows.select("doc_id").distinct().count() == 3
    assert rows.select("root_key").distinct().count() == 1
    links = flatten(docs, apart, "doc").select(F.col("x_fk").alias("doc_id"))
    assert rows.join(links, "doc_id", "left_anti").count() == 0


def test_keys_do_not_depend_on_partitioning(spark):
    frame = data.frame(spark, data.documents([f"k{i}" for i in range(6)]))
    one, many = (flatten(frame.repartition(n), nominal.tree(), "offence") for n in (1, 5))
    assert brute.rows(one) == brute.rows(many)


def test_flattening_needs_no_shuffle(spark, scratch):
    data.frame(spark, data.documents(["a"])).write.parquet(f"{scratch}/docs")
    docs = spark.read.schema(nominal.document_schema()).parquet(f"{scratch}/docs")
    for rows in flatten_all(docs, nominal.tree()).values():
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Python" not in plan


def test_unknown_table(spark):
    with pytest.raises(KeyError):
        flatten(data.frame(spark, data.documents(["a"])), nominal.tree(), "nope")
