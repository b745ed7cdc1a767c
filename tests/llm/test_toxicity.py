from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from arborload.llm import toxicity
from arborload.llm.queries import QUERIES
from conftest_llm import LABELS


def all_segments(x):
    """The maximal segments by their definition: the best one, then both sides of it."""
    found = []

    def inside(a, b):
        best = None
        for i in range(a, b):
            total = 0.0
            for j in range(i, b):
                total += x[j]
                if total > 0 and (best is None or total > best[2] + 1e-12):
                    best = (i, j + 1, total)
        if best:
            found.append(best)
            inside(a, best[0])
            inside(best[1], b)

    inside(0, len(x))
    return sorted(found)


def test_maximal_segments():
    draw = np.random.default_rng(4)
    for _ in range(400):
        x = draw.normal(-0.2, 1, draw.integers(0, 22))
        found = toxicity.maximal_segments(x, 0.0)
        assert [f[:2] for f in found] == [e[:2] for e in all_segments(x)]
        assert toxicity.best_segment(x) == pytest.approx(max((f[2] for f in found), default=0.0))


def test_scan_is_linear_on_a_staircase():
    x = np.tile([1.0, -0.999], 100_000)
    assert len(toxicity.maximal_segments(x, 0.5)) >= 1


def test_tail_finds_the_law_it_is_drawn_from():
    draw = np.random.default_rng(0)
    sizes = draw.integers(50, 900, 20_000).astype(float)
    best = -np.log(-np.log(draw.random(20_000)) / (0.3 * sizes)) / 1.7
    rate, scale = toxicity.tail(sizes, best)
    assert rate == pytest.approx(1.7, rel=0.03) and scale == pytest.approx(0.3, rel=0.1)


def corpus(spark, make, n=600):
    draw = random.Random(6)
    plain = [f"w{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(n):
        words = draw.choices(plain, k=draw.randint(20, 120))
        toxic = i % 6 == 0
        if toxic:
            at = draw.randrange(len(words))
            words[at:at] = draw.choices(["idiot,", "moron!", "scummy", "scums"], k=5)
        rows.append((i, " ".join(words), "s"))
        labels.append((i, 1, int(toxic)))
    return make(rows), spark.createDataFrame(labels, LABELS)


def test_held_out_accuracy_and_passages(spark, make):
    docs, labels = corpus(spark, make)
    rows = toxicity.scored(docs, toxicity.fit(docs, labels)).collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == toxicity.HELD_OUT]
    assert len(held) > 100 and sum(r.predicted == (r.doc_id % 6 == 0) for r in held) >= 0.98 * len(held)
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    found = [r for r in rows if r.doc_id % 6 == 0 and r.passages]
    assert len(found) > 90
    words = found[0].text.split()
    best = max(found[0].passages, key=lambda p: p.sum)
    assert any(w[:4] in ("idio", "moro", "scum") for w in words[best.start : best.end])


def test_held_out_labels_are_not_seen(spark, make):
    docs, labels = corpus(spark, make, 200)
    fold = "crc32(cast(doc_id AS string)) % 4 = 2"
    turned = labels.selectExpr("doc_id", "quality", f"CASE WHEN {fold} THEN 1 - toxic ELSE toxic END AS toxic")
    a, b = toxicity.fit(docs, labels), toxicity.fit(docs, turned)
    assert (a.scores == b.scores).all() and (a.intercept, a.slope, a.rate) == (b.intercept, b.slope, b.rate)


def test_odd_rows(spark, make, odd):
    docs, labels = corpus(spark, make, 120)
    model = toxicity.fit(docs, labels.unionByName(labels.limit(5)))
    rows = toxicity.scored(make(odd).withColumnRenamed("lang", "score"), model).collect()
    assert len(rows) == len(odd)
    blank = {r.score for r in rows if r.doc_id in (2, 3, 4)}
    assert len(blank) == 1 and blank.pop() == min(r.score for r in rows)
    assert toxicity.scored(make([]), model).count() == 0
    nothing = toxicity.fit(make([]), labels.limit(0))
    assert all(r.predicted == 0 for r in toxicity.scored(make(odd), nothing).collect())


def test_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = {r.doc_id: r for r in QUERIES["op8_toxicity"](spark, sf).collect()}
    assert len(rows) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in rows.items())
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    for held in (True, False):
        ones = [rows[i].score for i, t in toxic.items() if t and rows[i].held_out == held]
        zeros = [rows[i].score for i, t in toxic.items() if not t and rows[i].held_out == held]
        assert np.mean([a > b for a in ones for b in zeros]) > 0.8


def plain_tokens(text):
    """Buckets of the words of a text and of their first 5 and 7 bytes, in Python's own integers."""
    limit = (1 << 64) - 1
    found = []
    for word in re.findall(rb"[a-z0-9'\x80-\xff]+", text.lower().encode()):
        row = []
        for column, size in enumerate((len(word), 5, 7)):
            value, factor = 0, 1
            for byte in word[:size]:
                value = (value + (byte + 1) * factor) & limit
                factor = factor * 0x9E3779B97F4A7C15 & limit
            value = (value + column * 0xA0761D6478BD642F) & limit
            value = (value ^ value >> 32) * 0xD6E8FEB86659FD93 & limit
            row.append((value ^ value >> 32) % toxicity.BUCKETS)
        found.append(row)
    return found


def plain_evidence(scores, rate, scale):
    if not scores:
        return 0.0
    segments = [s for _, _, s in all_segments(scores)]
    base = math.log(scale * len(scores))
    tops = sorted((rate * s - base for s in segments), reverse=True) or [-base]
    alone = -math.log(1 - math.exp(-math.exp(-tops[0]))) if tops[0] < 30 else tops[0]
    best, together = alone, 0.0
    if tops[0] >= -math.log(0.01):
        for r, top in enumerate([t for t in tops if t >= -math.log(0.01)], start=1):
            together += top
            if r > 1:
                best = max(best, together - (r - 1) * math.log(together) + math.log(math.factorial(r)) + math.log(math.factorial(r - 1)))
    return max(best, 0.0)


def test_scores_equal_a_plain_version(spark, make):
    """Counts, log-odds, segments, the extreme-value law and the calibration, each done plainly."""
    docs, labels = corpus(spark, make, 90)
    model = toxicity.fit(docs, labels)
    texts = {r.doc_id: r.text for r in docs.collect()}
    toxic = {r.doc_id: r.toxic for r in labels.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2}
    tokens = {d: plain_tokens(t) for d, t in texts.items()}
    counts = [Counter(), Counter(), Counter()]
    for d, rows in tokens.items():
        for own in [0] + ([1 if toxic[d] else 2] if d in toxic else []):
            counts[own].update(b for row in rows for b in row)
    whole = sum(counts[0].values()) + 0.01 * toxicity.BUCKETS
    totals = [sum(c.values()) + 2000.0 for c in counts]
    score = {}
    for b in counts[0]:
        shape = 2000.0 * (counts[0][b] + 0.01) / whole
        odds = [math.log(counts[k][b] + shape) - math.log(totals[k] - counts[k][b] - shape) for k in (1, 2)]
        error = math.sqrt(sum(1 / (counts[k][b] + shape) for k in (1, 2)))
        raw = odds[0] - odds[1]
        score[b] = math.copysign(max(abs(raw) - error, 0.0), raw) - 0.25
    assert all(model.scores[b] == pytest.approx(s, abs=1e-9) for b, s in score.items())

    sums = {d: [sum(score[b] for b in row) / 3 for row in rows] for d, rows in tokens.items()}
    law = [(len(x), max((s for _, _, s in all_segments(x)), default=0.0)) for d, x in sums.items() if toxic.get(d) == 0]

    def likelihood(rate):
        scale = len(law) / sum(n * math.exp(-rate * s) for n, s in law)
        return sum(math.log(rate * scale * n) - rate * s - scale * n * math.exp(-rate * s) for n, s in law), scale

    assert model.scale == pytest.approx(likelihood(model.rate)[1], rel=1e-6)
    assert all(likelihood(model.rate)[0] >= likelihood(model.rate * f)[0] for f in (0.9, 0.99, 1.01, 1.1))

    evidence = {d: plain_evidence(x, model.rate, model.scale) for d, x in sums.items()}
    chance = {d: 1 / (1 + math.exp(-(model.intercept + model.slope * math.log1p(e)))) for d, e in evidence.items()}
    pull = sum(toxic[d] - chance[d] for d in toxic), sum((toxic[d] - chance[d]) * math.log1p(evidence[d]) for d in toxic)
    assert abs(pull[0] - 1e-3 * model.intercept) < 1e-3 and abs(pull[1] - 1e-3 * model.slope) < 1e-3
    for r in toxicity.scored(docs, model).collect():
        assert r.score == pytest.approx(chance[r.doc_id], abs=1e-6) and r.evidence == pytest.approx(evidence[r.doc_id], abs=1e-6)
