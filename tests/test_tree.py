from __future__ import annotations

import pytest
from pyspark.sql import types as T

from arborload.plans import nominal
from arborload.tree import Tree


def schema(text: str) -> T.StructType:
    return T._parse_datatype_string(text)


@pytest.fixture(autouse=True)
def _session(spark):
    """Schema strings are parsed by Spark."""


def test_arrays_become_tables_and_structs_fold():
    tree = Tree.from_schema(
        "Doc", "id", schema("h struct<a:int>, b struct<id:string, X array<struct<v:int, Y array<string>>>>")
    )
    assert tree.tables == ["doc", "x", "y"]
    assert [f.name for f in tree.root.fields] == ["a", "id"]
    assert tree.node("x").array == ("b", "X")
    assert tree.links("x") == ["y_fk"]
    assert tree.node("y").scalar
    assert tree.parent("y") == "x" and tree.parent("doc") is None
    assert tree.leaf_first() == ["y", "x", "doc"]


def test_colliding_columns_are_rejected_or_qualified():
    text = "h struct<a:int>, b struct<id:string, A:int>"
    with pytest.raises(ValueError, match="two columns named"):
        Tree.from_schema("doc", "id", schema(text))
    tree = Tree.from_schema("doc", "id", schema(text), qualify=True)
    assert [f.name for f in tree.root.fields] == ["a", "id", "b_A"]


def test_colliding_tables_are_rejected():
    with pytest.raises(ValueError, match="same table name"):
        Tree.from_schema("doc", "id", schema("id int, x array<struct<a:int, X array<struct<b:int>>>>"))


def test_generated_names_are_reserved():
    with pytest.raises(ValueError, match="pos"):
        Tree.from_schema("doc", "id", schema("id int, x array<struct<pos:int>>"))


def test_nested_arrays_and_maps_become_tables():
    full = schema("id int, x array<array<int>>, y array<array<struct<v:int, big:string>>>, m map<string,int>, n map<int,struct<a:int,z:array<string>>>, o map<string,array<int>>")
    tree = Tree.from_schema("doc", "id", full)
    assert tree.tables == ["doc", "x", "x_val", "y", "y_val", "m", "n", "z", "o", "o_val"]
    assert tree.links("x") == ["x_val_fk"] and not tree.node("x").fields and tree.node("x_val").scalar
    assert tree.node("y_val").array == () and [f.name for f in tree.node("y_val").fields] == ["v", "big"]
    assert [f.name for f in tree.node("m").fields] == ["key", "val"] and tree.node("m").entries
    assert [f.name for f in tree.node("n").fields] == ["key", "a"] and tree.links("n") == ["z_fk"]
    assert tree.parent("o_val") == "o" and [f.name for f in tree.node("o").fields] == ["key"]
    assert tree.read_schema("y", full) == schema("id int, y array<array<struct<v:int>>>")
    assert tree.read_schema("m", full) == schema("id int, m map<string,int>")


def test_the_key_has_to_exist():
    with pytest.raises(ValueError, match="natural key"):
        Tree.from_schema("doc", "nope", schema("id int"))


def test_unknown_table():
    with pytest.raises(KeyError):
        Tree.of("a", "k", {"a": ["b"]}).lineage("c")


def test_read_schema_holds_only_what_a_table_needs():
    text = "h struct<a:string>, b struct<id:bigint, big:string, x array<struct<v:string, w:int, y array<struct<z:string, n:int>>>>>"
    full = schema(text)
    tree = Tree.from_schema("doc", "id", full)
    assert tree.read_schema("y", full) == schema(
        "b struct<id:bigint, x array<struct<y array<struct<z:string, n:int>>>>>"
    )
    assert tree.read_schema("x", full) == schema(
        "b struct<id:bigint, x array<struct<v:string, w:int, y array<struct<n:int>>>>>"
    )
    assert tree.read_schema("doc", full) == schema(
        "h struct<a:string>, b struct<id:bigint, big:string, x array<struct<w:int>>>"
    )


def test_nominal_tree():
    tree = nominal.tree()
    assert len(tree.tables) == 19
    assert max(len(tree.lineage(t)) for t in tree.tables) == 5
    assert [n.table for n in tree.lineage("releasedetails")] == [
        "nominal",
        "caseheader",
        "custody",
        "periodininstitution",
        "releasedetails",
    ]
    assert tree.parent("oiconditions") == "operationalinformation"
    assert tree.links("nominal") == [
        "occupation_fk",
        "informationmarker_fk",
        "caseheader_fk",
        "operationalinformation_fk",
    ]
