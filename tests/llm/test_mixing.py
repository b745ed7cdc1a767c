from __future__ import annotations

import math
from collections import Counter

import pytest

from arborload.llm import mixing


def test_rates_reach_the_targets(spark, make):
    docs = make([(i, "x" * 10, "a" if i % 4 else "b") for i in range(4000)])
    rates = {r.source: r.rate for r in mixing.source_rates(docs, weights={"a": 1, "b": 1}).collect()}
    assert rates == pytest.approx({"a": 2 / 3, "b": 2.0})
    chars = Counter()
    for r in mixing.replicate(docs, weights={"a": 1, "b": 1}).select("source", "n_chars").collect():
        chars[r.source] += r.n_chars
    assert chars["a"] == pytest.approx(20_000, rel=0.05) and chars["b"] == pytest.approx(20_000, rel=0.05)


@pytest.mark.parametrize("rate", [0.3, 2.0, 21.0])
def test_counts_follow_the_poisson_distribution(spark, make, rate):
    n = 4000
    docs = make([(i, "x", "a") for i in range(n)])
    counts = Counter(r.doc_id for r in mixing.replicate(docs, epochs=rate).select("doc_id").collect())
    found = Counter(counts.get(i, 0) for i in range(n))
    cdf = seen = 0.0
    for k in range(int(3 * rate) + 6):
        cdf += math.exp(-rate + k * math.log(rate) - math.lgamma(k + 1))
        seen += found[k] / n
        assert abs(cdf - seen) < 1.63 / math.sqrt(n)


def test_copies_are_numbered_and_the_same_again(spark, make, odd):
    docs = make(odd).withColumnRenamed("lang", "copy")
    first = mixing.replicate(docs, epochs=4.0).collect()
    assert [c for c in docs.columns if c != "copy"] + list(mixing.ADDED) == first[0].__fields__
    again = mixing.replicate(docs.repartition(5), epochs=4.0).collect()
    assert Counter(map(str, first)) == Counter(map(str, again))
    numbers = {}
    for r in first:
        numbers.setdefault((r.doc_id, r.text, r.source), []).append(r.copy)
    rows = Counter(odd)
    for key, copies in numbers.items():
        n = len(copies) // rows[key]
        assert sorted(copies) == sorted(list(range(n)) * rows[key])
    assert mixing.replicate(make([])).count() == 0


def test_sources_without_weight_or_text(spark, make):
    docs = make([(1, "x", "a"), (2, "y", "b"), (3, None, "c"), (4, "", None)])
    rates = {r.source: r.rate for r in mixing.source_rates(docs, weights={"a": 1}).collect()}
    assert rates == {"a": 2.0, "b": 0.0, "c": 0.0, None: 0.0}
    rates = {r.source: r.rate for r in mixing.source_rates(docs, epochs=1.5).collect()}
    assert rates["c"] == rates[None] == 1.5
