from __future__ import annotations

import base64
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import data
from arborload.functions.header import HEADER_FIELDS, SOURCE_FILE, audit_header
from arborload.operators import columns
from arborload.operators.flatten import flatten_all
from arborload.operators.project import Projections, project, project_tree
from arborload.plans import nominal

AS_OF = datetime(2024, 2, 1, 0, 10)


def test_headers_of_both_forms(spark):
    docs = data.documents(["a", "b", "c", "d"])
    frame = data.frame(spark, docs).withColumn(SOURCE_FILE, F.lit("f"))
    nested = project(frame, ["body.PNCID AS pncid"], header="nested", as_of=AS_OF)
    assert nested.columns == [*HEADER_FIELDS, "glue_timestamp", "input_filename", "pncid"]
    for row in nested.collect():
        header = next(d["header"] for d in docs if d["body"]["PNCID"] == row["pncid"])
        assert row["cdlz_header_record_hash_b64"] == base64.b64encode(header["recordHash"]).decode()
        assert row["cdlz_header_source_zip_archive"] == header["sourceZipArchive"]
        assert row["glue_timestamp"] == AS_OF and row["input_filename"] == "f"
    flat = flatten_all(frame, nominal.tree(), ())["nominal"].withColumn(SOURCE_FILE, F.lit("f"))
    for row in flat.select(*audit_header(True, AS_OF), "PNCID").collect():
        header = next(d["header"] for d in docs if d["body"]["PNCID"] == row["PNCID"])
        assert row["cdlz_header_source_zip_archive"] == (header["sourceZipArchive"] or None)


def test_load_time_defaults_to_now(spark):
    frame = data.frame(spark, data.documents(["a"])).withColumn(SOURCE_FILE, F.lit("f"))
    assert project(frame, ["1 AS x"], header="nested").first()["glue_timestamp"] is not None


def test_projections_are_lazy_and_aliased():
    called = []

    def offence(run_id):
        called.append(run_id)
        return ["a"]

    registry = Projections({"old_offence": offence, "old_other": ["b"]}, aliases={"new_": "old_"})
    assert "new_offence" in registry and not called
    assert registry.select_list("new_offence", "r9") == ["a"]
    assert called == ["r9"]
    with pytest.raises(KeyError):
        registry.select_list("nothing", "r")


def test_header_on_the_root_only_and_keys_kept(spark):
    frame = data.frame(spark, data.documents(["a", "b"])).withColumn(SOURCE_FILE, F.lit("f"))
    tree = nominal.tree()
    tables = {"nominal": frame}
    flat = flatten_all(frame, tree)
    flat["nominal"] = flat["nominal"].withColumn(SOURCE_FILE, F.lit("f"))
    tables = {t: flat[t] for t in ("nominal", "custody")}
    registry = Projections({"e_nominal": ["PNCID AS pncid"], "e_custody": ["CustodyDate AS d", "pos"]})
    shaped = project_tree(tables, tree, registry, "e", "r", AS_OF)
    assert shaped["nominal"].columns[:2] == list(HEADER_FIELDS)[:2]
    assert shaped["nominal"].columns[-5:] == [*tree.links("nominal"), "root_key"]
    assert shaped["custody"].columns == ["d", "pos", "periodininstitution_fk", "root_key", "caseheader_id"]


def test_backfill_is_typed_and_ignores_case(spark):
    frame = spark.createDataFrame([(1, "x")], "Id int, s string")
    declared = T._parse_datatype_string("id int, n bigint, t timestamp")
    filled = columns.backfill(frame, declared)
    assert filled.dtypes == [("Id", "int"), ("s", "string"), ("n", "bigint"), ("t", "timestamp")]


def test_strip_prefixes(spark):
    frame = spark.createDataFrame([(1, 2)], "x int, y int").toDF("a.b.x", "y")
    assert columns.strip_prefixes(frame).columns == ["x", "y"]
    with pytest.raises(ValueError, match="repeats"):
        columns.strip_prefixes(frame.toDF("a.X", "b.x"))


def test_align(spark):
    target = T._parse_datatype_string("a bigint, b string, c double")
    frame = spark.createDataFrame([("f", 1)], "B string, A int")
    assert columns.align(frame, target).dtypes == [("a", "bigint"), ("b", "string"), ("c", "double")]
    with pytest.raises(ValueError, match="no column"):
        columns.align(frame.withColumn("z", F.lit(1)), target)
    assert columns.align(frame.withColumn("z", F.lit(1)), target, drop=["Z"]).columns == ["a", "b", "c"]
