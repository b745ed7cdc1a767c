from __future__ import annotations

import random
import sys
import unicodedata

import pytest
from tokenizers import Tokenizer

from arborload.llm import counting
from arborload.llm.queries import QUERIES, tokenizer_path

LIBRARY = Tokenizer.from_file(tokenizer_path())


def library_counts(texts):
    return [len(e.ids) for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


@pytest.fixture(scope="module")
def counter():
    return counting.counter(tokenizer_path())


def test_random_texts(counter):
    draw = random.Random(7)
    alphabet = "' s t re ve ll m d r l e a Z é 1 ٣ ! # 日 ing the == <|endoftext|>".split() + [" ", "  ", "\n", "\t", "\xa0", "\u3000", "\x00"]
    texts = ["".join(draw.choices(alphabet, k=draw.randint(0, 40))) for _ in range(20_000)]
    assert counter.counts(texts) == library_counts(texts)


def test_characters_of_every_script(counter):
    draw = random.Random(8)
    codes = [c for c in range(1, sys.maxunicode) if unicodedata.category(chr(c)) not in ("Cs", "Cn", "Co")]
    texts = ["".join(chr(draw.choice(codes)) + draw.choice(["", " ", "a", "'s"]) for _ in range(40)) for _ in range(3000)]
    found, expected = counter.counts(texts), library_counts(texts)
    assert found == expected


def test_long_texts(counter):
    texts = ["ab" * 150_000, "word " * 300_000, "=" * 100_000, " " * 50_000 + "x", "é" * 40_000, "<|endoftext|>" * 3]
    assert counter.counts(texts) == library_counts(texts)


def test_forgotten_states_are_found_again(counter, monkeypatch):
    monkeypatch.setattr(counting, "MOST_STATES", 50)
    texts = [f"some words number {i} and their ends" for i in range(200)]
    counter.compiler.clear()
    assert [counter.counts([t])[0] for t in texts] == library_counts(texts)
    counter.compiler.clear()


def test_scan_is_the_composition_of_the_maps_before():
    draw = random.Random(1)
    import numpy as np

    maps = np.array([[draw.randrange(8) for _ in range(8)] for _ in range(37)], dtype=np.uint8)
    state, found = list(range(8)), counting.scan(maps)
    for one, total in zip(maps, found):
        state = [int(one[s]) for s in state]
        assert total.tolist() == state


def test_odd_rows(spark, make, odd):
    docs = make(odd).withColumnRenamed("n_chars", "n_tokens")
    rows = counting.counted(docs, tokenizer_path(), limit=6).collect()
    assert len(rows) == len(odd)
    for r in rows:
        n = library_counts([r.text or ""])[0]
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((r.text or "").encode()), n, n > 6)
    assert counting.counted(make([]), tokenizer_path()).count() == 0


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op7_token_counts"](spark, sf).collect()
    assert len(rows) == len(docs)
    expected = dict(zip(docs, library_counts(list(docs.values()))))
    assert {r.doc_id: r.n_tokens for r in rows} == expected
