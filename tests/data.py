"""Small nested documents with NULLs, empty arrays and awkward values."""

from __future__ import annotations

import random

from pyspark.sql import types as T

from arborload.plans import nominal
from arborload.tree import Tree

KEY = nominal.KEY


def small_schema() -> T.StructType:
    """Five tables on two branches, three levels deep, with the header of the real feed."""

    def rows(*fields):
        return T.ArrayType(T.StructType(list(fields)))

    def text(name):
        return T.StructField(name, T.StringType())

    disposal = T.StructField("Disposal", rows(text("DisposalType")))
    offence = T.StructField("Offence", rows(text("Plea"), disposal))
    condition = T.StructField("Condition", rows(text("ConditionText")))
    note = T.StructField("Note", rows(text("NoteText"), condition))
    body = T.StructType([text(KEY), text("Sex"), offence, note])
    return T.StructType([T.StructField("header", nominal.HEADER), T.StructField("body", body)])


def small_tree() -> Tree:
    return Tree.from_schema("person", KEY, small_schema(), keep_repeats=["offence"])


def _struct(rng: random.Random, schema: T.StructType, fan: int = 3) -> dict:
    row = {}
    for f in schema.fields:
        if isinstance(f.dataType, T.StructType):
            row[f.name] = _struct(rng, f.dataType)
        elif isinstance(f.dataType, T.ArrayType):
            n = rng.choice([None, 0, 1, 2, fan])
            element = f.dataType.elementType
            row[f.name] = None if n is None else [_struct(rng, element, fan=2) for _ in range(n)]
        elif isinstance(f.dataType, T.BinaryType):
            row[f.name] = bytes(rng.randrange(256) for _ in range(80))
        else:
            row[f.name] = rng.choice([None, "", "y|z", f"v{rng.randrange(1000)}"])
    return row


def documents(keys, seed: int = 1, schema: T.StructType | None = None) -> list[dict]:
    """One document per key; a NULL key gives a document that cannot be linked."""
    rng = random.Random(seed)
    docs = []
    for k in keys:
        doc = _struct(rng, schema or nominal.document_schema())
        doc["body"][KEY] = k
        docs.append(doc)
    return docs


def frame(spark, docs, partitions: int = 2, schema: T.StructType | None = None):
    return spark.createDataFrame(docs, schema or nominal.document_schema()).coalesce(partitions)
