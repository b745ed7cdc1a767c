"""From raw documents to packed sequences: the corpus operators, one after the other.

Each stage is a function of the session, the documents that the stage before it kept
and the folder of the tables.  ``run`` writes the result of each as Parquet below the
cluster's shared folder and reads it back, so a stage starts from files and a lost
executor never sends it back to the beginning.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborload.llm import lines, mixing, packing, quality, simhash
from arborload.llm.queries import query, tokenizer_path
from arborload.llm.shared import shared_dir
from arborload.sources.scratch import remove


def _beside(docs: DataFrame, added: Iterable[str], stage: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The columns of ``docs`` after a stage that adds columns; own columns named like them stay as they are."""
    taken = {c.lower() for c in added}
    held = {c: f"__own_{i}" if c.lower() in taken else c for i, c in enumerate(docs.columns)}
    renamed = docs.select(*[F.col(f"`{c}`").alias(new) for c, new in held.items()])
    done = stage(renamed)
    return done.select(*[F.col(f"`{new}`").alias(c) for c, new in held.items()])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that keep the base rules and look like the documents labelled good."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return _beside(docs, quality.ADDED, lambda rows: quality.scored(rows, labels).where("kept"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents without lines of templates that an earlier document has."""
    return _beside(docs, lines.ADDED, lines.drop_recurring)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies."""
    return simhash.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the target weights of the sources have drawn it."""
    return _beside(docs, mixing.ADDED, mixing.replicate)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 tokens, with their ids."""
    return packing.packed(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", simhash_near_dedup),
    ("mixing sources to target weights", mix_sources),
    ("packing", pack_sequences),
]

#: SQL has neither the tokenizer nor XXH64; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the pieces of the packed sequences.

    The files of a stage go once the next one has been written.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = f"{shared_dir(spark)}/corpus/pipeline-{uuid.uuid4().hex}"
    for number, (_, stage) in enumerate(STAGES):
        path = f"{base}/{number}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if number:
            remove(spark, f"{base}/{number - 1}")
    return docs


query("pipeline", ORACLE_SQL)(run)
