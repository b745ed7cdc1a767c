from __future__ import annotations

import itertools
import random

import pytest

from arborload.llm import audit
from brute_llm import words
from conftest_llm import LABELS


def failed(rows):
    """The filters each of the (doc_id, text, part) rows fails."""
    out = []
    for doc, text, _ in rows:
        text = text or ""
        found = words(text)
        out.append(
            {
                f
                for f, bad in {
                    "A": len(found) < 200,
                    "B": 100 * len(set(found)) < 50 * len(found),
                    "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text),
                    "D": any(c in "#$%&*|" for c in text),
                    "E": any(doc is not None and d is not None and d < doc and (t or "") == text for d, t, _ in rows),
                }.items()
                if bad
            }
        )
    return out


def plain(rows, labels):
    fails = failed(rows)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    out = set()
    for part in {p or "" for _, _, p in rows}:
        own = [(r[0], f) for r, f in zip(rows, fails) if (r[2] or "") == part]
        lines, shares = [], dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shares[f] += len(gone)
                lines.append(
                    (
                        part, "".join(order), step, len(left), len(gone),
                        sum(f in s for _, s in own) - len(gone),
                        sum(s == {f} for _, s in own),
                        sum(d in good for d, _ in gone),
                        sum(d in toxic for d, _ in gone), f,
                    )
                )
        out |= {(*line[:-1], shares[line[-1]]) for line in lines}
    return out


def table(rows):
    return {tuple(r) for r in rows}


@pytest.fixture()
def land(spark, scratch):
    """Write batches of (doc_id, text, part) rows, one file each, oldest first."""
    path = f"{scratch}/documents.parquet"
    schema = "doc_id long, text string, lang string, source string, Part long"

    def write(rows):
        full = [(d, t, p, "s", 0) for d, t, p in rows]
        spark.createDataFrame(full, schema).coalesce(1).write.mode("append").parquet(path)

    return path, write


def labelled(spark, rows):
    return spark.createDataFrame(rows, LABELS)


LABELLED = [(1, 1, 0), (2, 0, 1), (3, 1, 1), (3, 0, 0), (900, 1, 0), (None, 1, 1), (7, None, None)]


def test_smaller_ids_that_arrive_later_retract(spark, land, scratch):
    path, write = land
    draw = random.Random(1)
    texts = ["a b c", "A # shout", "", None, " ".join(f"w{i}" for i in range(250)), "same " * 300]
    batches = [
        [(draw.randrange(1, 60), draw.choice(texts), draw.choice(["en", "de", None])) for _ in range(25)] for _ in range(6)
    ]
    batches.append([(None, "a b c", "en"), (1, "a b c", "en"), (1, "a b c", "en"), (1, "a b c", "xx")])
    for batch in batches:
        write(batch)
    found = audit.audited(spark, path, labelled(spark, LABELLED), f"{scratch}/state", batches=7).collect()
    assert table(found) == plain([r for b in batches for r in b], LABELLED)
    assert spark.read.parquet(f"{scratch}/state/counters").select("batch").distinct().count() > 3


def test_files_that_come_later_are_added(spark, land, scratch):
    path, write = land
    first = [(5, "a b", "en"), (6, "a b", "en"), (7, "x", "en")]
    second = [(4, "a b", "de"), (8, "x", "en")]
    write(first)
    labels = labelled(spark, LABELLED)
    assert table(audit.audited(spark, path, labels, f"{scratch}/state").collect()) == plain(first, LABELLED)
    write(second)
    assert table(audit.audited(spark, path, labels, f"{scratch}/state").collect()) == plain(first + second, LABELLED)
    # Without new files nothing changes.
    assert table(audit.audited(spark, path, labels, f"{scratch}/state").collect()) == plain(first + second, LABELLED)


def test_odd_rows(spark, land, scratch, odd):
    path, write = land
    rows = [(d, t, s) for d, t, s in odd]
    write(rows)
    found = audit.audited(spark, path, labelled(spark, []), f"{scratch}/state").collect()
    assert table(found) == plain(rows, [])


def test_empty_table(spark, land, scratch):
    path, write = land
    write([])
    found = audit.audited(spark, path, labelled(spark, LABELLED), f"{scratch}/state")
    assert found.count() == 0 and found.columns[0] == "part"


def test_settings_are_put_back(spark, land, scratch):
    path, write = land
    write([(1, "a", "en")])
    before = {name: spark.conf.get(name, None) for name in audit.STATE}
    audit.audited(spark, path, labelled(spark, []), f"{scratch}/state").count()
    assert {name: spark.conf.get(name, None) for name in audit.STATE} == before


def test_string_ids(spark, scratch):
    path = f"{scratch}/named"
    rows = [("b", "x", "en"), ("a", "x", "en"), (None, "x", "en")]
    spark.createDataFrame(rows, "doc_id string, text string, lang string").write.parquet(path)
    labels = spark.createDataFrame([("a", 1, 0)], "doc_id string, quality int, toxic int")
    found = audit.audited(spark, path, labels, f"{scratch}/state")
    row = found.where("filter_order = 'EABCD' AND step = 1").first()
    assert (row.removed, row.kept, row.good_lost) == (1, 2, 0)
