from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from arborload.llm import packing, tokens
from arborload.llm.queries import QUERIES, tokenizer_path

LIBRARY = Tokenizer.from_file(tokenizer_path())


def expected_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [0]


def test_encoder_gives_the_library_ids():
    draw = random.Random(2)
    alphabet = ["'s", "'", " ", "  ", "\n", "a", "é", "日", "9", "!", "<|endoftext|>", " the", "re", "\x00", "\u3000"]
    for _ in range(2000):
        text = "".join(draw.choices(alphabet, k=draw.randint(0, 25)))
        assert tokens.encoder(tokenizer_path()).ids(text).tolist() == expected_ids(text)[:-1]


def test_long_runs_of_white_space():
    for text in (" " * 2_000_000, "a" + "\n" * 1_100_000 + " b", "x " * 60_000 + "\t" * 200_000 + "end <|endoftext|>"):
        assert tokens.encoder(tokenizer_path()).ids(text).tolist() == expected_ids(text)[:-1]


@pytest.mark.parametrize("seed", range(3))
def test_places_are_those_of_deficit_round_robin(spark, seed):
    draw = random.Random(seed)
    sizes = {f"s{i:02d}": draw.randint(1, 4000) for i in range(draw.randint(1, 6))}
    weights = {s: draw.choice([0.0, 0.001, 1.0, 2.5]) for s in sizes}
    rows = [(s, 0, n) for s, n in sizes.items()]
    parts = spark.createDataFrame(rows, "source string, part long, n long")
    queued = packing.queues(parts, 100, 0.7, weights if seed else None)
    quanta = {r.source: (r.quantum, r.first_round) for r in queued.collect()}
    found = {(r.window, r.source): (r.begin, r.size) for r in packing.slices(queued).collect()}
    shift = {(r["__window"], r["__source"]): r["shift"] for r in packing.shifts(packing.slices(queued)).collect()}
    left, deficit, place, k, seen = dict(sizes), dict.fromkeys(sizes, 0), 0, 0, 0
    while any(left.values()):
        for s in sorted(sizes):
            quantum, first = quanta[s]
            if k < first:
                continue
            deficit[s] += quantum
            send = min(left[s], deficit[s] // 65536)
            deficit[s] -= send * 65536
            if send:
                begin = sizes[s] - left[s]
                assert found[k, s] == (begin, send) and shift[k, s] + begin == place
                assert packing.round_of(begin, quantum) + first == k
                left[s] -= send
                place += send
                seen += 1
        k += 1
    assert seen == len(found) == len(shift)
    if seed:
        first = {s: quanta[s][1] for s in sizes}
        assert all((first[s] > 0) == (weights[s] == 0) for s in sizes) or not any(weights.values())


def test_many_sources_and_sources_without_weight(spark, make):
    """All weight on one of 300 sources: it fills the windows, the others come after it."""
    rows = [(i, "word " * 40, f"s{i % 300:03d}") for i in range(600)] + [(1000 + i, "word " * 500, "s007") for i in range(20)]
    docs = make(rows).repartition(4)
    pieces = packing.packed(docs, tokenizer_path(), 128, 2048, proportions={"s007": 1.0}).collect()
    check(pieces, rows, 128)
    by_window = defaultdict(lambda: defaultdict(int))
    for p in pieces:
        by_window[p.window_id][p.source] += p.length
    alone = [w for w in by_window if "s007" in by_window[w]]
    assert all(set(by_window[w]) == {"s007"} for w in alone) and by_window[0]["s007"] == 2048
    assert max(alone) < min(w for w in by_window if w not in alone)
    two = [(i, "word " * 60, "ab"[i % 2]) for i in range(100)]
    pieces = packing.packed(make(two), tokenizer_path(), 128, 2048, proportions={"a": 1.0, "b": 0.0}).collect()
    check(pieces, two, 128)
    assert {p.source for p in pieces if p.window_id == 0} == {"a"}


def check(pieces, docs, sequence):
    """Every id in exactly one piece, all sequences full but the last."""
    wanted = defaultdict(int)
    for doc, text, source in docs:
        wanted[doc, source, tuple(expected_ids(text))] += 1
    by_sequence, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(bytes(p.ids), dtype="<u4")
        assert len(ids) == p.length and zlib.crc32(ids.tobytes()) == p.ids_crc32
        by_sequence[p.sequence_id].append((p.offset, p.length))
        by_doc[p.doc_id, p.source].append((p.start, p.doc_tokens, tuple(ids.tolist())))
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for number, parts in by_sequence.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == sequence if number < len(by_sequence) - 1 else 0 < at <= sequence
    for (doc, source), parts in by_doc.items():
        texts = [list(k[2]) for k, n in wanted.items() if k[:2] == (doc, source) for _ in range(n)]
        assert sum(len(p[2]) for p in parts) == sum(map(len, texts))
        for text in texts:
            for start, size, ids in parts:
                if len(texts) == 1:
                    assert size == len(text) and tuple(text[start : start + len(ids)]) == ids


def test_odd_rows(spark, make, odd):
    docs = make(odd).repartition(3)
    pieces = packing.packed(docs, tokenizer_path(), sequence=64, window=256).collect()
    check(pieces, odd, 64)
    assert packing.packed(make([]), tokenizer_path()).count() == 0


def test_windows_hold_the_target_proportions(spark, make):
    draw = random.Random(9)
    rows = [(i, " ".join(["word"] * draw.randint(1, 300)), draw.choice("aaaab")) for i in range(300)]
    docs = make(rows).repartition(5)
    pieces = packing.packed(docs, tokenizer_path(), 128, 2048, proportions={"a": 0.7, "b": 0.3}).collect()
    check(pieces, rows, 128)
    shares = defaultdict(lambda: defaultdict(int))
    for p in pieces:
        shares[p.window_id][p.source] += p.length
    ends = {s: max(w for w in shares if shares[w][s]) for s in "ab"}
    whole = [w for w in shares if w < min(ends.values())]
    assert len(whole) > 5
    for w in whole:
        assert abs(shares[w]["a"] - 0.7 * 2048) <= 1 and abs(shares[w]["b"] - 0.3 * 2048) <= 1


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: expected_ids(r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    covered = defaultdict(list)
    for p in QUERIES["op2_packing"](spark, sf).collect():
        ids = docs[p.doc_id][p.start : p.start + p.length]
        assert p.ids_crc32 == zlib.crc32(np.array(ids, dtype="<u4").tobytes()) and p.doc_tokens == len(docs[p.doc_id])
        covered[p.doc_id].append((p.start, p.length))
    for doc, ids in docs.items():
        at = 0
        for start, length in sorted(covered[doc]):
            assert start == at
            at += length
        assert at == len(ids)
