from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import brute_llm as brute
from arborload.llm import quality
from arborload.llm.words import WordHasher
from conftest_llm import LABELS


@settings(deadline=None, max_examples=200)
@given(st.text(alphabet="ab #|\n\t\x0b é日", max_size=60))
def test_statistics(text):
    assert quality.statistics(text) == brute.base_statistics(text)


def test_word_hashes_do_not_depend_on_place_or_block(monkeypatch):
    data = b" hello  world hello\n\x0bfoo hello"
    whole = WordHasher().hashes(data)
    assert len(whole) == 5 and whole[0] == whole[2] == whole[4] and len(set(whole.tolist())) == 3
    monkeypatch.setattr("arborload.llm.words.BLOCK", 7)
    assert (WordHasher().hashes(data) == whole).all()


def test_odd_rows(spark, make, odd):
    labels = spark.createDataFrame([(1, 1, 0), (5, 1, 0), (None, 1, 0), (3, 0, 0)], LABELS)
    docs = make(odd).withColumnRenamed("lang", "kept")
    rows = quality.scored(docs, labels).collect()
    assert len(rows) == len(odd)
    for row in rows:
        stats = (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words)
        assert stats == brute.base_statistics(row.text)
        assert row.base_failed == (stats[0] < 50 or 100 * stats[4] > 50 * stats[0])
        assert not (row.kept and row.base_failed)
    empty = quality.scored(make([]), labels.limit(0))
    assert empty.count() == 0 and "ratio" in empty.columns


def test_ratio_equals_a_plain_version(spark, make):
    draw = random.Random(5)
    good = [" ".join(draw.choices(["red", "grün", "blue", "tree"], k=60)) for _ in range(30)]
    junk = [" ".join(draw.choices(["buy!!", "now!!", "$$$", "click"], k=60)) for _ in range(10)]
    docs = make([(i, t, "s") for i, t in enumerate(good + junk)])
    labels = spark.createDataFrame([(i, int(i < 30), 0) for i in range(0, 40, 2)], LABELS)
    rows = {r.doc_id: r for r in quality.scored(docs, labels).collect()}
    expected = brute.log_ratios(good + junk, set(range(0, 30, 2)), quality.LEAST_BUCKETS, quality.PRIOR)
    for i, ratio in enumerate(expected):
        assert rows[i].ratio == pytest.approx(ratio, abs=1e-6)
        assert rows[i].kept == (i < 30 and not rows[i].base_failed)


def test_buckets_grow_with_the_documents():
    sizes = [quality.bucket_count(10**k) for k in range(0, 12)]
    assert sizes[0] == quality.LEAST_BUCKETS and sizes[-1] == quality.MOST_BUCKETS and sizes == sorted(sizes)
    assert quality.bucket_count(256_410) == 1 << 18


def test_a_corpus_with_more_buckets(spark, make):
    texts = [f"word{i % 7} other{i % 5} third word{i % 3}" * 20 for i in range(20)]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 20, 3)], LABELS)
    rows = quality.scored(make([(i, t, "s") for i, t in enumerate(texts)]), labels, buckets=1 << 18).collect()
    expected = brute.log_ratios(texts, set(range(0, 20, 3)), 1 << 18, quality.PRIOR)
    assert all(r.ratio == pytest.approx(expected[r.doc_id], abs=1e-6) for r in rows)


def test_query(spark):
    from arborload.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").collect()}
    rows = QUERIES["op1_quality_rules"](spark, sf).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    trusted = {i for i, d in enumerate(texts) if d in good}
    ratios = dict(zip(texts, brute.log_ratios(list(texts.values()), trusted, quality.LEAST_BUCKETS, quality.PRIOR)))
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == brute.base_statistics(texts[r.doc_id])
        assert r.ratio == pytest.approx(ratios[r.doc_id], abs=1e-6)
        if abs(r.ratio - quality.THRESHOLD) > 1e-6:
            assert r.kept == (not r.base_failed and ratios[r.doc_id] >= quality.THRESHOLD)
