from __future__ import annotations

import random

import numpy as np
import pytest

import brute_llm as brute
from arborload.llm import simhash
from arborload.llm.graph import components


def test_fingerprint():
    draw = random.Random(3)
    texts = ["", None, " \n", "One", "a b c", "a b c d", "É É", "Ünï cödé " * 9]
    texts += [" ".join(draw.choices(["x", "Yy", "zé", "W"], k=draw.randint(1, 40))) for _ in range(200)]
    for text in texts:
        assert simhash.fingerprint(text) == brute.simhash(text)


@pytest.mark.parametrize("distance", [0, 1, 3, 4])
def test_chains_keep_every_near_pair(distance):
    draw = np.random.default_rng(distance)
    flips = [sum(1 << int(b) for b in draw.choice(64, n, replace=False)) for n in draw.integers(0, distance + 1, 3000)]
    x = np.array(flips, dtype=np.uint64)
    assert simhash.chained(x, distance).all() and simhash.near(x, distance).all()
    far = draw.integers(0, 1 << 64, 3000, dtype=np.uint64)
    assert (simhash.near(far, distance) == (np.bitwise_count(far) <= distance)).all()
    assert simhash.chained(far, distance).mean() < 0.01


def family(draw, centres, members, flips):
    prints = set()
    for _ in range(centres):
        centre = draw.getrandbits(64)
        for _ in range(members):
            one = centre
            for b in draw.sample(range(64), draw.randint(0, flips)):
                one ^= 1 << b
            prints.add(one)
    return sorted(prints)


@pytest.mark.parametrize("distance,dense", [(4, 16384), (4, 3), (3, 2), (1, 4)])
def test_links_have_the_components_of_all_pairs(spark, distance, dense):
    prints = family(random.Random(distance), 12, 14, 3)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "print long")
    found = {r.node: r.root for r in components(simhash.links(frame, distance, dense=dense)).collect()}
    expected = brute.components(prints, distance)
    groups, wanted = {}, {}
    for i, p in enumerate(signed):
        groups.setdefault(found.get(p, p), set()).add(i)
        wanted.setdefault(expected[i], set()).add(i)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, wanted.values()))


def test_odd_rows(spark, make, odd):
    docs = make(odd)
    rows = simhash.grouped(docs).collect()
    assert len(rows) == len(odd)
    by_text = {r.key: r for r in rows}
    assert {r.fingerprint for r in rows if r.doc_id in (2, 3, 4)} == {"0" * 16}
    assert {r.component_id for r in rows if r.doc_id in (2, 3, 4)} == {2}
    assert {r.component_id for r in rows if r.doc_id in (1, None)} == {1} and by_text
    kept = simhash.deduplicated(docs).collect()
    assert sorted(r.doc_id for r in kept) == [1, 2, 5, 6, 7]
    assert kept[0].__fields__ == docs.columns
    assert simhash.grouped(make([])).count() == 0 and simhash.deduplicated(make([])).count() == 0


def test_query(spark):
    from arborload.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    docs = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect())
    prints = [brute.simhash(t) for _, t in docs]
    roots = brute.components(prints, 4)
    expected = [(d, f"{p:016x}", docs[r][0]) for (d, _), p, r in zip(docs, prints, roots)]
    assert sorted(map(tuple, QUERIES["op5_simhash_near_dedup"](spark, sf).collect())) == expected


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(7, 7), (300, 200)]
    found = {r.node: r.root for r in components(spark.createDataFrame(path, "u long, v long")).collect()}
    assert found == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 150)} | {300: 200}
