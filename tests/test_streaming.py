from __future__ import annotations

import brute
import data
from arborload.streaming.incremental import append_batches, flatten_batches, load_new_files

SCHEMA = data.small_schema()
TREE = data.small_tree()


def test_new_files_only(spark, scratch):
    seen = []

    def apply(batch, batch_id):
        append_batches(f"{scratch}/out")(batch, batch_id)
        seen.append(batch_id)

    def run():
        return load_new_files(spark, f"{scratch}/in", spark.range(1).schema, f"{scratch}/state", apply)

    spark.range(5).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    assert run() == 5
    assert run() == 0
    spark.range(5, 7).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
    assert run() == 2
    assert sorted(r["id"] for r in spark.read.parquet(f"{scratch}/out").collect()) == list(range(7))
    assert seen == [0, 1]


def test_the_count_is_whole_beyond_the_kept_progress(spark, scratch):
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", "100")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        for i in range(5):
            spark.range(i, i + 2).coalesce(1).write.mode("append").parquet(f"{scratch}/in")
        seen = load_new_files(
            spark, f"{scratch}/in", spark.range(1).schema, f"{scratch}/state", append_batches(f"{scratch}/out"), 1
        )
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    assert seen == 10 == spark.read.parquet(f"{scratch}/out").count()


def test_a_repeated_batch_replaces_itself(spark, scratch):
    apply = append_batches(f"{scratch}/out")
    apply(spark.range(3), 0)
    apply(spark.range(3), 0)
    assert spark.read.parquet(f"{scratch}/out").count() == 3


def test_flattened_batches(spark, scratch):
    docs = data.documents(["a", "b", "c"], 1, SCHEMA)
    for i, part in enumerate((docs[:2], docs[2:])):
        data.frame(spark, part, 1, SCHEMA).write.mode("append").parquet(f"{scratch}/in")
        load_new_files(
            spark, f"{scratch}/in", SCHEMA, f"{scratch}/state", flatten_batches(f"{scratch}/out", TREE), 1
        )
    expected = brute.flatten(docs, TREE)
    for table in ("person", "offence", "disposal"):
        rows = spark.read.parquet(f"{scratch}/out/{table}").drop("batch")
        assert brute.rows(rows) == brute.canon(expected[table]), table
