"""Queries of the corpus operators and the SQL that checks those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arborload.llm import audit, chat, codes, counting, lines, mixing, packing, pieces
from arborload.llm import quality, sharding, simhash, sketches, toxicity

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with its SQL if there is one."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_quality_rules")
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "ratio"
    )


@query("op2_packing")
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer_path()).drop("ids")


@query("op3_line_dedup", lines.ORACLE)
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_recurring(table(spark, sf_dir, "documents"))


@query("op4_mixing", mixing.ORACLE)
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.replicate(table(spark, sf_dir, "documents")).withColumn("rate", F.round("rate", 9))


@query("op5_simhash_near_dedup")
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.grouped(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "fingerprint", "component_id")


@query("op8_toxicity")
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels)
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == toxicity.HELD_OUT
    return toxicity.scored(docs.select("doc_id", "text"), model, limit=0.3).select(
        "doc_id",
        held_out.alias("held_out"),
        "score",
        "predicted",
        F.size("passages").alias("n_passages"),
    )


@query("op9_chat_formatting")
def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return chat.digests(chat.formatted(rows.unionByName(extra)))


@query("op10_document_fingerprints")
def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.compared(table(spark, sf_dir, "documents"))


@query("op6_sharding")
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assigned(table(spark, sf_dir, "documents"))


@query("op7_token_counts")
def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return counting.counted(docs, tokenizer_path(), limit=1024).drop("text")


@query("op11_filter_interaction_audit", audit.ORACLE)
def op11_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audited(spark, f"{sf_dir}/documents.parquet", table(spark, sf_dir, "labels"))


@query("op12_sentencepiece")
def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pieces.digests(pieces.encoded(docs, tokenizer_path("piece_bpe_32k.model")))


@query("op13_vector_code_compression", codes.ORACLE)
def op13_vector_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.compressed(table(spark, sf_dir, "embeddings"))
