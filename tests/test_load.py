from __future__ import annotations

import itertools
import pathlib
import re
import uuid
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import brute
import data
from arborload.operators.flatten import flatten
from arborload.operators.project import Projections
from arborload.plans import load as load_plan
from arborload.plans import nominal
from arborload.plans.config import Feed, Mode
from arborload.plans.load import _documents, load_csv, run
from arborload.queries import fixtures, loading
from arborload.sinks.ledger import Ledger
from arborload.sinks.tables import BUCKET, Tables
from arborload.sources.landing import scan
from arborload.sources.scratch import directories, exists
from arborload.tree import Tree

SCHEMA = data.small_schema()
TREE = data.small_tree()
NOW = datetime(2024, 2, 1, 12, 0)


@pytest.fixture()
def tables(spark, scratch):
    return Tables(spark, f"l_{uuid.uuid4().hex[:8]}", f"{scratch}/tables", buckets=3)


def land(spark, path, docs, day="01"):
    where = f"{path}/year=2024/month=02/day={day}/hour=02/minute=00"
    data.frame(spark, docs, 1, SCHEMA).write.mode("append").parquet(where)
    return path


def feed(landing, **changes):
    settings = dict(
        source="s", name="f", landing=landing, schema=SCHEMA, tree=TREE, header=False, delete_path="body.PNCID"
    )
    return Feed(**{**settings, **changes})


def content(tables):
    return {t: brute.rows(tables.read(f"s_f_{t}").drop(BUCKET)) for t in TREE.tables}


def wanted(docs):
    return {t: brute.canon(rows) for t, rows in brute.flatten(docs, TREE, by_hash=True, batch="r1").items()}


def files(tables):
    return {t: set(tables.read(f"s_f_{t}").inputFiles()) for t in TREE.tables}


def metrics(outcome):
    return [(m, e, v) for m, e, _, v, _ in outcome.metrics.records()]


def go(spark, tables, landing, mode, scratch, **changes):
    return run(spark, feed(landing, **changes), mode, tables, "r1", "today", NOW, f"{scratch}/reports")


def test_bulk_upsert_delete(spark, tables, scratch):
    old = data.documents(["a", "b", "c", "d", None], 1, SCHEMA)
    done = go(spark, tables, land(spark, f"{scratch}/1", old + old), Mode.BULK, scratch)
    assert content(tables) == wanted(old)
    counts = {(m, e): v for m, e, _, v, _ in done.metrics.records()}
    assert counts[("read_count", "person")] == 4 and counts[("repeated_rows", "person")] == 4
    assert spark.read.parquet(done.rejected).count() == 2 and counts[("rejected_rows", "s_f")] == 2

    new = data.documents(["b", "d", "x"], 2, SCHEMA)
    batch = land(spark, f"{scratch}/2", new)
    after = [d for d in old if d["body"]["PNCID"] not in ("b", "d")] + new
    for _ in range(2):
        done = go(spark, tables, batch, Mode.UPSERT, scratch)
        assert content(tables) == wanted(after)
    report = spark.read.option("header", True).csv(done.report)
    assert {r["table"] for r in report.collect()} == set(TREE.tables)
    assert not tables.exists("stage_s_f_person")

    gone = land(spark, f"{scratch}/3", data.documents(["a", "a", "x", "nobody", None], 3, SCHEMA))
    left = [d for d in after if d["body"]["PNCID"] not in ("a", "x")]
    for expected in (1, 4):
        done = go(spark, tables, gone, Mode.DELETE, scratch)
        assert content(tables) == wanted(left), "a delete inserts nothing"
        lost = spark.read.option("header", True).csv(done.unmatched).collect()
        assert sum(r["PNCID"] is not None for r in lost) == expected


def test_a_missing_slice_changes_nothing(spark, tables, scratch):
    docs = data.documents(["a", "b"], 1, SCHEMA)
    landing = land(spark, f"{scratch}/1", docs)
    go(spark, tables, landing, Mode.BULK, scratch)
    for mode in Mode:
        late = run(spark, feed(landing), mode, tables, "r2", "today", datetime(2030, 1, 1), f"{scratch}/reports")
        missing = [r[:2] for r in late.metrics.records() if r[1] == "s_f" and r[0] != "rejected_rows"]
        assert sorted(missing) == [("nop_read_error", "s_f"), ("read_count", "s_f")], "once, also with reports"
        assert content(tables) == wanted(docs)


def test_filter_and_transform(spark, tables, scratch):
    docs = data.documents(["a", "b", "c"], 1, SCHEMA)

    def upper(frame):
        return frame.withColumn("body", F.col("body").withField("PNCID", F.upper("body.PNCID")))

    go(
        spark,
        tables,
        land(spark, f"{scratch}/1", docs),
        "bulk",
        scratch,
        where="body.PNCID <> 'b'",
        transform=upper,
    )
    assert sorted(r["PNCID"] for r in tables.read("s_f_person").collect()) == ["A", "C"]


def test_versions_of_a_root_stay_apart(spark, tables, scratch):
    docs = data.documents(["a", "a", "b"], 5, SCHEMA)
    go(spark, tables, land(spark, f"{scratch}/1", docs + docs[:1]), "bulk", scratch)
    assert content(tables) == wanted(docs)


def without_hash(schema):
    return T.StructType([f if f.name != "header" else T.StructField("header", T.StructType(f.dataType.fields[1:])) for f in schema])


def test_versions_without_a_record_hash_are_told_apart_by_their_content(spark, tables, scratch):
    docs = data.documents(["a", "a"], 6, SCHEMA)
    docs[0]["body"]["Offence"] = [{"Plea": "p", "Disposal": [{"DisposalType": "d"}]}]
    docs[1]["body"]["Offence"] = [{"Plea": "q", "Disposal": [{"DisposalType": "e"}]}]
    schema = without_hash(SCHEMA)
    tree = Tree.from_schema("person", data.KEY, schema)
    go(spark, tables, land(spark, f"{scratch}/1", docs + docs), "bulk", scratch, schema=schema, tree=tree)
    parent, child = tables.read("s_f_offence"), tables.read("s_f_disposal")
    joined = parent.join(child, parent["disposal_fk"] == child["offence_id"])
    assert sorted((r["Plea"], r["DisposalType"]) for r in joined.collect()) == [("p", "d"), ("q", "e")]
    assert not tables.spark.catalog.tableExists("x") and "_digest" not in " ".join(parent.columns)


def test_the_latest_version_wins(spark, tables, scratch):
    docs = data.documents(["a", "a", "a", None, None], 7, SCHEMA)
    for doc, at in zip(docs, ("2024-01-02", "2024-01-03", None, "x", "y")):
        doc["header"]["ingestDateTime"] = at
    batch = land(spark, f"{scratch}/1", docs)
    done = run(spark, feed(batch, on_duplicate_root="latest"), "bulk", tables, "r1", "today", NOW)
    assert content(tables) == wanted(docs[1:2])
    assert spark.read.parquet(done.rejected).count() == 2 and ("rejected_rows", "s_f", 2) in metrics(done)
    with pytest.raises(ValueError):
        feed("x", on_duplicate_root="first")


def test_a_header_only_where_it_is_wanted(spark, tables, scratch):
    docs = data.documents(["a"], 1, SCHEMA)
    batch = land(spark, f"{scratch}/1", docs)
    shape = Projections({"s_f_person": ["PNCID", "Sex"]})
    go(spark, tables, batch, "bulk", scratch, projections=shape, header=False)
    assert not [c for c in tables.read("s_f_person").columns if c.startswith(("cdlz_", "input_"))]
    other = Tables(spark, f"l_{uuid.uuid4().hex[:8]}", f"{scratch}/other", buckets=2)
    go(spark, other, batch, "bulk", scratch, header=True)
    columns = other.read("s_f_person").columns
    assert "cdlz_header_record_hash_b64" in columns and "PNCID" in columns and "recordHash" not in columns


def test_changes_rewrite_only_what_they_touch(spark, tables, scratch):
    docs = data.documents([f"k{i}" for i in range(12)], 3, SCHEMA)
    docs[0]["body"].update(Offence=[{"Plea": "p", "Disposal": None}], Note=None)
    go(spark, tables, land(spark, f"{scratch}/1", docs), "bulk", scratch)
    before = files(tables)
    unknown = land(spark, f"{scratch}/2", data.documents(["x", "y", "z"], 3, SCHEMA))
    go(spark, tables, unknown, "delete", scratch)
    assert files(tables) == before, "unknown keys write nothing"

    go(spark, tables, unknown, "upsert", scratch)
    added = files(tables)
    assert all(before[t] <= added[t] for t in TREE.tables), "new roots leave the old files in place"

    one = land(spark, f"{scratch}/3", docs[:1])
    go(spark, tables, one, "delete", scratch)
    after = files(tables)
    assert after["note"] == added["note"] and after["condition"] == added["condition"], "no row of theirs is gone"
    assert after["person"] != added["person"]
    go(spark, tables, one, "delete", scratch)
    assert files(tables) == after, "a repeated delete writes nothing"


def test_one_slice_per_run(spark, tables, scratch, monkeypatch):
    docs = data.documents(["a", "b", "c"], 3, SCHEMA)
    landing = land(spark, f"{scratch}/1", docs[:2])
    clock = iter([datetime(2024, 2, 1, 23, 59), datetime(2024, 2, 2, 0, 0)])

    class Moving(datetime):
        @classmethod
        def now(cls, tz=None):
            return next(clock)

    monkeypatch.setattr("arborload.plans.load.datetime", Moving)
    monkeypatch.setattr("arborload.sources.landing.datetime", Moving)
    late = []

    def landed_meanwhile(run_id):
        if not late:
            late.append(land(spark, f"{scratch}/1", docs[2:]))
        return ["pos", "Plea"]

    shape = Projections({"s_f_offence": landed_meanwhile})
    run(spark, feed(landing, projections=shape), "bulk", tables, "r1", "today")
    assert late
    expected = wanted(docs[:2])
    found = content(tables)
    assert {t: found[t] for t in ("person", "disposal", "note")} == {t: expected[t] for t in ("person", "disposal", "note")}


def test_a_filter_keeps_the_scans_narrow(spark, tables, scratch):
    schema, tree = nominal.document_schema(), nominal.tree()
    landing = f"{scratch}/1"
    data.frame(spark, data.documents(["a"], 1), 1).write.parquet(f"{landing}/year=2024/month=02/day=01/hour=02/minute=00")
    wide = Feed("s", "n", landing, schema, tree, header=False, where="body.Sex IS NOT NULL AND header.dataFormat <> 'Sex'")

    def read(narrow, file):
        return scan(spark, landing, narrow)

    documents = _documents(wide, tree, tables, read)
    rows = flatten(documents.read(documents.tree.read_schema("releasedetails", schema), False), documents.tree, "releasedetails")
    text = rows._jdf.queryExecution().optimizedPlan().toString()
    names = set(re.findall(r"\w+", " ".join(f.simpleString() for f in documents.read(documents.tree.read_schema("releasedetails", schema), False).schema)))
    assert {"Sex", "dataFormat", "ReleaseDate"} <= names and not names & {"Offence", "CRONo", "Occupation"} and text


def test_a_transform_reads_the_documents_once(spark, tables, scratch):
    reads = []

    def read(narrow, file):
        reads.append(narrow)
        return scan(spark, landing, narrow, source_file=file)

    landing = land(spark, f"{scratch}/1", data.documents(["a", "b"], 1, SCHEMA))
    changed = feed(landing, transform=lambda frame: frame.where("body.PNCID = 'a'"))
    documents = _documents(changed, TREE, tables, read)
    for table in TREE.tables:
        documents.read(TREE.read_schema(table, SCHEMA), table == "person").count()
    assert len(reads) == 1 and documents.written


def test_new_files_are_upserted_once(spark, tables, scratch):
    docs = data.documents(["a", "b", "c"], 1, SCHEMA)
    again = data.documents(["b"], 9, SCHEMA)
    landing = land(spark, f"{scratch}/1", docs)

    def load(mode="upsert"):
        return run(spark, feed(landing), mode, tables, "r1", "new", NOW, f"{scratch}/reports", f"{scratch}/state")

    first = load()
    assert ("read_count", "person", 3) in metrics(first) and "/batch-000000/" in first.rejected
    land(spark, landing, again, day="02")
    load()
    assert content(tables) == wanted([docs[0], docs[2], again[0]])
    assert "year" in spark.read.parquet(run(spark, feed(landing), "bulk", tables, "r1", "all", NOW).rejected).columns
    state = content(tables)
    assert load().metrics.records() == [] and content(tables) == state
    with pytest.raises(ValueError, match="state"):
        run(spark, feed(landing), "upsert", tables, "r1", "new", NOW)


def test_versions_with_a_null_or_shared_record_hash(spark, tables, scratch):
    """Two documents of one key whose hash is NULL, or equal: their subtrees stay apart."""
    for number, value in enumerate((None, b"same")):
        docs = data.documents(["a", "a", "b"], 6, SCHEMA)
        for doc, plea in zip(docs, "pqr"):
            doc["header"]["recordHash"] = value
            doc["body"]["Offence"] = [{"Plea": plea, "Disposal": [{"DisposalType": plea.upper()}]}]
        other = Tables(spark, f"l_{uuid.uuid4().hex[:8]}", f"{scratch}/tables{number}", buckets=3)
        batch = land(spark, f"{scratch}/in{number}", docs + docs[:1])
        for mode in ("bulk", "upsert"):
            go(spark, other, batch, mode, scratch)
            parent, child = other.read("s_f_offence"), other.read("s_f_disposal")
            joined = parent.join(child, parent["disposal_fk"] == child["offence_id"])
            assert sorted((r["Plea"], r["DisposalType"]) for r in joined.collect()) == [("p", "P"), ("q", "Q"), ("r", "R")]
            assert other.read("s_f_person").count() == 3
        assert not directories(spark, f"{other.work}/changes/s_f_person")


def test_new_files_are_appended_once(spark, tables, scratch):
    """A batch that breaks off after some tables have their rows is repeated without repeating rows."""
    docs = data.documents(["a", "b", "c", "d", "e"], 1, SCHEMA)
    landing = land(spark, f"{scratch}/1", docs[:2])

    class Failing(Tables):
        def append(self, frame, table, *args, **kwargs):
            if table == "s_f_person":
                raise OSError("no space left")
            super().append(frame, table, *args, **kwargs)

    def load(target, run_id):
        return run(spark, feed(landing), "bulk", target, run_id, "new", NOW, state=f"{scratch}/state")

    def rows():
        found = {t: tables.read(f"s_f_{t}").drop(BUCKET, "batch_id") for t in TREE.tables}
        return {t: brute.rows(f) for t, f in found.items()}

    def expected(docs):
        flat = brute.flatten(docs, TREE, by_hash=True, batch="x")
        return {t: brute.canon([{k: v for k, v in r.items() if k != "batch_id"} for r in own]) for t, own in flat.items()}

    load(tables, "r1")
    land(spark, landing, docs[2:], day="02")
    for attempt in ("r2", "r3"):
        with pytest.raises(Exception, match="no space left"):
            load(Failing(spark, tables.database, tables.location), attempt)
    assert rows() != expected(docs[:2]), "the failed attempt has left rows"
    load(tables, "r4")
    assert rows() == expected(docs)
    load(tables, "r5")
    assert rows() == expected(docs)


def test_a_done_batch_is_not_repeated(spark, tables, scratch, monkeypatch):
    """The program dies after the batch is done, before the stream has noted it."""
    landing = land(spark, f"{scratch}/1", data.documents(["a", "b"], 1, SCHEMA))
    real = Ledger.done

    def dying(self, number, tag):
        real(self, number, tag)
        raise OSError("killed")

    def load():
        return run(spark, feed(landing), "bulk", tables, "r1", "new", NOW, state=f"{scratch}/state")

    monkeypatch.setattr(Ledger, "done", dying)
    with pytest.raises(Exception, match="killed"):
        load()
    monkeypatch.setattr(Ledger, "done", real)
    before = files(tables)
    load()
    assert files(tables) == before and tables.read("s_f_person").count() == 2


def test_new_files_of_an_absent_area(spark, tables, scratch):
    def load(mode):
        return run(spark, feed(f"{scratch}/later"), mode, tables, "r1", "new", NOW, state=f"{scratch}/state")

    for mode in Mode:
        assert metrics(load(mode)) == [("read_count", "s_f", 0), ("nop_read_error", "s_f", 1)]
    land(spark, f"{scratch}/later", data.documents(["a"], 1, SCHEMA))
    load("upsert")
    assert tables.read("s_f_person").count() == 1


@pytest.mark.parametrize("name", ["a[1].parquet", "b{2}.parquet", "c*?.parquet", "d e%20.parquet"])
def test_file_names_of_any_kind(spark, tables, scratch, name):
    docs = data.documents(["a"], 1, SCHEMA)
    path = land(spark, f"{scratch}/1", docs)
    folder = pathlib.Path(f"{path}/year=2024/month=02/day=01/hour=02/minute=00")
    (part,) = folder.glob("part-*.parquet")
    part.rename(folder / name)
    go(spark, tables, path, "bulk", scratch)
    run(spark, feed(path), "upsert", tables, "r1", "new", NOW, state=f"{scratch}/state")
    assert content(tables) == wanted(docs)


def test_older_documents_pass_by(spark, tables, scratch):
    """Batches in any order end alike; a late, older one changes nothing and is counted."""
    versions = []
    for number, at in enumerate(("2024-01-01", "2024-01-02", "2024-01-03")):
        docs = data.documents(["a", "b", None] if number else ["a", "b", "c"], 20 + number, SCHEMA)
        for doc in docs:
            doc["header"]["ingestDateTime"] = at
        versions.append(land(spark, f"{scratch}/v{number}", docs))
    ends = []
    for order in itertools.permutations(range(3)):
        target = Tables(spark, f"l_{uuid.uuid4().hex[:8]}", f"{scratch}/{order}", buckets=2)
        skipped, newest = [], -1
        for number in order:
            done = go(spark, target, versions[number], "upsert", scratch, on_duplicate_root="newest")
            skipped.append({m: v for m, _, v in metrics(done)}["skipped_roots"])
            late = number < newest
            assert skipped[-1] == (2 if late else 0)
            newest = max(newest, number)
        ends.append(content(target))
        before = files_of(target)
        go(spark, target, versions[order[-1]], "upsert", scratch, on_duplicate_root="newest")
        if order[-1] == 1:
            assert files_of(target) == before, "nothing older is written"
    assert all(e == ends[0] for e in ends)
    assert {r["PNCID"] for r in target.read("s_f_person").collect()} == {"a", "b", "c"}
    with pytest.raises(ValueError, match="newest"):
        feed("x", tree=None, key="k", on_duplicate_root="newest")


def files_of(tables):
    return {t: set(tables.read(f"s_f_{t}").inputFiles()) for t in TREE.tables}


FLAT = dict(
    tree=None,
    key="pncid",
    header=False,
    projections=Projections({"s_f": ["body.PNCID AS pncid", "body.Sex AS sex", "header.ingestDateTime AS at"]}),
)


def test_flat_rows_without_a_key_are_rejected(spark, tables, scratch):
    docs = data.documents(["a", None], 1, SCHEMA)
    landing = land(spark, f"{scratch}/1", docs)
    go(spark, tables, landing, "bulk", scratch, **FLAT)
    for _ in range(2):
        done = go(spark, tables, landing, "upsert", scratch, **FLAT)
        assert tables.read("s_f").count() == 2, "repeating an upsert adds nothing"
        assert ("rejected_rows", "s_f", 1) in metrics(done) and ("read_count", "s_f", 1) in metrics(done)
        assert [r["pncid"] for r in spark.read.parquet(done.rejected).collect()] == [None]


@pytest.mark.parametrize("mode", ["bulk", "upsert"])
def test_the_latest_row_of_a_flat_feed(spark, tables, scratch, mode):
    docs = data.documents(["a", "a", "a", "b", None, None], 7, SCHEMA)
    for doc, at in zip(docs, ("2024-01-02", "2024-01-03", None, None, "x", "y")):
        doc["header"]["ingestDateTime"] = at
    batch = land(spark, f"{scratch}/1", docs)
    for _ in range(2 if mode == "upsert" else 1):
        go(spark, tables, batch, mode, scratch, on_duplicate_root="latest", **FLAT)
    found = [(r["pncid"], r["at"]) for r in tables.read("s_f").where("pncid IS NOT NULL").collect()]
    assert sorted(found, key=str) == [("a", "2024-01-03"), ("b", None)]
    assert tables.read("s_f").where("pncid IS NULL").count() == (2 if mode == "bulk" else 0)


def test_flat_feeds(spark, tables, scratch):
    docs = data.documents(["a", "b"], 1, SCHEMA)
    flat = dict(
        tree=None,
        key="pncid",
        header=True,
        projections=Projections({"s_f": lambda run_id: ["body.PNCID AS pncid", f"'{run_id}' AS run_id"]}),
    )
    landing = land(spark, f"{scratch}/1", docs)
    done = go(spark, tables, landing, "bulk", scratch, **flat)
    assert metrics(done) == [("read_count", "s_f", 2)]
    go(spark, tables, landing, "bulk", scratch, **flat)
    assert tables.read("s_f").count() == 4
    go(spark, tables, landing, "upsert", scratch, **flat)
    assert tables.read("s_f").count() == 2
    row = tables.read("s_f").first()
    assert row["input_filename"].endswith(".parquet") and row["run_id"] == "r1"
    gone = land(spark, f"{scratch}/2", data.documents(["a"], 1, SCHEMA))
    go(spark, tables, gone, "delete", scratch, **flat)
    assert [r["pncid"] for r in tables.read("s_f").collect()] == ["b"]


def test_configuration_is_checked(spark, tables, scratch):
    with pytest.raises(ValueError, match="missing source"):
        feed("x", source="")
    with pytest.raises(ValueError, match="missing landing"):
        feed("")
    with pytest.raises(ValueError):
        go(spark, tables, scratch, "replace", scratch)
    with pytest.raises(ValueError, match="delete_path"):
        go(spark, tables, scratch, "delete", scratch, delete_path=None)
    with pytest.raises(ValueError, match="has no key"):
        feed("x", tree=None).natural_key


def test_csv(spark, tables, scratch):
    spark.createDataFrame([("1", "a"), ("2", None)], "id string, v string").coalesce(1).write.option(
        "header", True
    ).csv(f"{scratch}/in")
    for columns in (None, ["id", "v"]):
        done = load_csv(
            spark, f"{scratch}/in", f"{scratch}/out", "lookup", "lookup", tables, "r1", columns=columns
        )
        assert [r[3] for r in done.metrics.records()] == [2]
    assert tables.read("lookup").dtypes == [("id", "string"), ("v", "string")]
    assert tables.read("lookup").count() == 4
    with pytest.raises(ValueError, match="no rows"):
        load_csv(
            spark,
            f"{scratch}/in",
            f"{scratch}/out",
            "empty",
            "lookup",
            tables,
            "r1",
            {"empty": lambda frame, run_id: frame.where("false")},
        )
    assert spark.read.parquet(f"{scratch}/out").count() == 2, "the landed rows are still there"


def test_damaged_csv_lines_are_set_apart(spark, tables, scratch):
    folder = pathlib.Path(f"{scratch}/in")
    folder.mkdir()
    (folder / "a.csv").write_text('a,b\n1,2\n4,5,6\n3\n"x, y",\n,\n7,"8\n')
    for number, columns in enumerate((None, ["a", "b"])):
        done = load_csv(spark, str(folder), f"{scratch}/out{number}", "f", f"t{number}", tables, "r1", columns=columns)
        found = sorted((tuple(r) for r in tables.read(f"t{number}").collect()), key=str)
        assert ("1", "2") in found and ("x, y", None) in found and (None, None) in found
        assert not any(r[0] in ("4", "3") for r in found)
        counts = {m: v for m, _, _, v, _ in done.metrics.records()}
        lost = spark.read.parquet(done.rejected).collect()
        assert {"4,5,6", "3"} <= {r["damaged_line"] for r in lost} and counts["rejected_rows"] == len(lost)
        assert counts["read_count"] == len(found) and all(r["source_file"].endswith("a.csv") for r in lost)
    typed = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    (folder / "a.csv").write_text("a,b\n1,2\nx,2\n")
    done = load_csv(spark, str(folder), f"{scratch}/typed", "f", "typed", tables, "r1", columns=typed)
    assert [tuple(r) for r in tables.read("typed").collect()] == [(1, "2")]
    assert [r["damaged_line"] for r in spark.read.parquet(done.rejected).collect()] == ["x,2"]


def test_a_range_of_landing_times(spark, tables, scratch):
    docs = data.documents(["a", "b", "c"], 1, SCHEMA)
    for day, doc in zip(("01", "02", "03"), docs):
        land(spark, f"{scratch}/1", [doc], day)
    span = (datetime(2024, 2, 1, 2, 0), datetime(2024, 2, 3, 2, 0))
    run(spark, feed(f"{scratch}/1"), "bulk", tables, "r1", between=span)
    assert content(tables) == wanted(docs[:2])
    late = run(spark, feed(f"{scratch}/1"), "upsert", tables, "r1", between=(datetime(2030, 1, 1), datetime(2030, 1, 2)))
    assert ("nop_read_error", "s_f", 1) in metrics(late) and content(tables) == wanted(docs[:2])


def test_digest_first_loads_the_same_tables(spark, tables, scratch):
    docs = data.documents(["a", "b", "c"], 1, SCHEMA)
    batch = land(spark, f"{scratch}/1", docs + docs)
    for mode in ("bulk", "upsert"):
        done = go(spark, tables, batch, mode, scratch, digest_first=True)
        assert content(tables) == wanted(docs)
        assert ("repeated_rows", "person", 3) in metrics(done) and ("read_count", "person", 3) in metrics(done)
    assert [d for d in directories(spark, tables.work) if "changes" not in d] == []


def compared(monkeypatch):
    """Columns of the tables whose rows are compared in full."""
    seen, before = [], load_plan.quality.dedupe

    def dedupe(frame, *args):
        seen.append(frame.columns)
        return before(frame, *args)

    monkeypatch.setattr(load_plan.quality, "dedupe", dedupe)
    return seen


@pytest.mark.parametrize("mode", ["bulk", "upsert"])
def test_copies_are_removed_as_documents(spark, tables, scratch, monkeypatch, mode):
    docs = data.documents(["a", "b", "b", "c", "d", None], 7, SCHEMA)
    batch = land(spark, land(spark, f"{scratch}/1", docs + docs[:2]), docs[1:])
    seen = compared(monkeypatch)
    done = go(spark, tables, batch, mode, scratch, header=True)
    assert len(seen) == 1, "only the root's rows"
    expected = wanted(docs)
    found = content(tables)
    assert {t: found[t] for t in found if t != "person"} == {t: expected[t] for t in found if t != "person"}
    root = tables.read("s_f_person")
    assert root.count() == root.select("input_filename").where("input_filename IS NOT NULL").count() == 5
    counts = {(m, e): v for m, e, v in metrics(done)}
    assert (counts["read_count", "person"], counts["repeated_rows", "person"]) == (5, 5)
    for t in ("offence", "disposal", "note", "condition"):
        assert counts["read_count", t] == counts["repeated_rows", t] == len(expected[t])
    assert [d for d in directories(spark, tables.work) if "changes" not in d] == []


def test_documents_that_come_once_are_not_compared(spark, tables, scratch, monkeypatch):
    docs = data.documents(["a", "b", "b"], 8, SCHEMA)
    seen = compared(monkeypatch)
    done = go(spark, tables, land(spark, f"{scratch}/1", docs), "bulk", scratch)
    assert len(seen) == 1 and content(tables) == wanted(docs)
    assert {v for m, _, v in metrics(done) if m == "repeated_rows"} == {0}


def test_rows_without_a_position_are_compared(spark, tables, scratch):
    """A projection that drops the position lets rows of one document be equal."""
    docs = data.documents(["a"], 1, SCHEMA)
    docs[0]["body"]["Offence"] = [{"Plea": "p", "Disposal": None}, {"Plea": "p", "Disposal": None}, {"Plea": "q", "Disposal": None}]
    for number, select in enumerate((["Plea"], ["Plea", "pos AS n"])):
        projections = Projections({"s_f_offence": select})
        target = Tables(spark, f"l_{uuid.uuid4().hex[:8]}", f"{scratch}/t{number}", buckets=3)
        go(spark, target, land(spark, f"{scratch}/{number}", docs + docs), "bulk", scratch, projections=projections)
        assert target.read("s_f_offence").count() == 2 + number


def test_documents_that_json_takes_for_copies_all_stay(spark, tables, scratch):
    """Times that differ by a microsecond only, under one hash: both roots stay."""
    at = T.StructField("At", T.TimestampType())
    body = T.StructType([*SCHEMA["body"].dataType.fields, at])
    schema = T.StructType([SCHEMA["header"], T.StructField("body", body)])
    docs = data.documents(["a"], 1, SCHEMA) * 2
    docs = [{**d, "body": {**d["body"], "At": datetime(2024, 1, 1, 0, 0, 0, n)}} for n, d in enumerate(docs)]
    where = f"{scratch}/1/year=2024/month=02/day=01/hour=02/minute=00"
    spark.createDataFrame(docs, schema).write.parquet(where)
    go(spark, tables, f"{scratch}/1", "bulk", scratch, schema=schema, tree=Tree.from_schema("person", data.KEY, schema))
    assert tables.read("s_f_person").count() == 2


def test_rows_of_leaf_tables_are_shuffled_in_their_parents_row(spark, tables, scratch, monkeypatch):
    """A bulk load shuffles a row per parent, not one per child, and its files are small."""
    docs = data.documents(["a", "b", "c"], 1, SCHEMA)
    clustered, gathered = [], []
    cluster, gather = Tables._clustered, Tables.gather
    monkeypatch.setattr(Tables, "_clustered", lambda self, rows, table: clustered.append(table) or cluster(self, rows, table))
    monkeypatch.setattr(Tables, "gather", lambda self, rows, table: gathered.append((table, rows)) or gather(self, rows, table))
    go(spark, tables, land(spark, f"{scratch}/1", docs), Mode.BULK, scratch)
    assert content(tables) == wanted(docs)
    leaves = {f"s_f_{t}" for t in TREE.tables if not TREE.children(t)}
    assert {t for t, _ in gathered} == leaves and not leaves & set(clustered)
    for table, rows in gathered:
        parents = tables.read(table).select(f"{TREE.parent(table.removeprefix('s_f_'))}_id").distinct().count()
        assert rows.count() == parents < tables.read(table).count()
    assert all(".zstd." in f for t in TREE.tables for f in tables.read(f"s_f_{t}").inputFiles())


@pytest.mark.parametrize("indexed", [False, True])
def test_settings_of_a_run(spark, scratch, monkeypatch, indexed):
    """Within a run writes remove their shuffle files and don't sort by bucket; the session's own settings come back."""
    names = ["spark.sql.classic.shuffleDependency.fileCleanup.enabled", "spark.sql.maxConcurrentOutputFileWriters"]
    seen, before = [], [spark.conf.get(n) for n in names]
    append, batch = Tables.append, land(spark, f"{scratch}/1", data.documents(["a"], 1, SCHEMA))
    monkeypatch.setattr(Tables, "append", lambda self, *a, **k: seen.append(tuple(map(spark.conf.get, names))) or append(self, *a, **k))
    target = Tables(spark, f"l_{uuid.uuid4().hex[:8]}", f"{scratch}/tables", buckets=3, indexed=indexed)
    go(spark, target, batch, Mode.BULK, scratch)
    assert set(seen) == {("true", before[1] if indexed else "4")} and [spark.conf.get(n) for n in names] == before
    again = Tables(spark, target.database, target.location)
    assert again.ordered(["s_f_person"]) == indexed


def test_digest_first_compares_every_document_once(spark, tables, scratch, monkeypatch):
    """Copies go as documents, so rows of a document that landed three times are digested once and counted thrice."""
    docs = data.documents(["a", "b", "c"], 1, SCHEMA)
    seen, before = [], load_plan.quality.dedupe_by_digest

    def dedupe(frame, *args, **settings):
        seen.append((frame.count(), settings["copies"]))
        return before(frame, *args, **settings)

    monkeypatch.setattr(load_plan.quality, "dedupe_by_digest", dedupe)
    done = go(spark, tables, land(spark, f"{scratch}/1", docs * 3), "bulk", scratch, digest_first=True)
    expected = wanted(docs)
    assert content(tables) == expected
    assert sorted(n for n, _ in seen) == sorted(map(len, expected.values())) and all(c for _, c in seen)
    assert ("repeated_rows", "disposal", len(expected["disposal"])) in metrics(done)


@pytest.mark.parametrize("value", [None, b"same"])
def test_copies_of_versions_without_a_hash_are_removed_as_documents(spark, tables, scratch, monkeypatch, value):
    docs = data.documents(["a", "a", "b"], 6, SCHEMA)
    for doc, plea in zip(docs, "pqr"):
        doc["header"]["recordHash"] = value
        doc["body"]["Offence"] = [{"Plea": plea, "Disposal": None}]
    seen = compared(monkeypatch)
    done = go(spark, tables, land(spark, f"{scratch}/1", docs + docs[1:]), "bulk", scratch)
    assert len(seen) == 1, "only the root's rows"
    assert sorted(r["Plea"] for r in tables.read("s_f_offence").collect()) == ["p", "q", "r"]
    assert ("read_count", "offence", 3) in metrics(done) and ("repeated_rows", "offence", 2) in metrics(done)
    assert [d for d in directories(spark, tables.work) if "changes" not in d] == []


def test_older_versions_and_copies_are_marked_not_written_again(spark, tables, scratch):
    docs = data.documents([f"k{i % 30}" for i in range(90)] + [None], 3, SCHEMA)
    for number, doc in enumerate(docs):
        doc["header"]["ingestDateTime"] = f"2024-01-01T00:00:{number:02}"
    landing = land(spark, land(spark, f"{scratch}/1", docs), docs[:45])

    def read(narrow, file):
        return scan(spark, landing, narrow, source_file=file)

    for mode, count in (("latest", 31), ("keep_all", 91)):
        documents = _documents(feed(landing, on_duplicate_root=mode), TREE, tables, read)
        left = documents.read(SCHEMA, False)
        assert left.count() == count and [pathlib.Path(p).name.split("-")[0] for p in documents.written] == ["marks"]
        assert mode == "keep_all" or {r[0] for r in left.select("header.ingestDateTime").collect()} >= {docs[89]["header"]["ingestDateTime"]}
    assert left.agg(F.sum(documents.copies)).first()[0] == 136, "documents without a key are not compared"


def test_few_buckets_are_written_without_a_shuffle(spark, scratch, monkeypatch):
    """Also by changes; tables of many buckets are shuffled by them."""
    docs = data.documents(["a", "b", "c", "d"], 1, SCHEMA)
    seen, before = [], Tables._by_bucket

    def by_bucket(self, rows, table, *args):
        done = before(self, rows, table, *args)
        seen.append("rebalance" in done._jdf.queryExecution().analyzed().toString().lower())
        return done

    monkeypatch.setattr(Tables, "_by_bucket", by_bucket)
    batch, gone = land(spark, f"{scratch}/1", docs), land(spark, f"{scratch}/2", docs[:2])
    for buckets, shuffled in ((8, False), (9, True)):
        target = Tables(spark, f"l_{uuid.uuid4().hex[:8]}", f"{scratch}/t{buckets}", buckets=buckets)
        for mode in ("bulk", "upsert"):
            go(spark, target, batch, mode, scratch)
            assert content(target) == wanted(docs)
        go(spark, target, gone, "delete", scratch)
        assert content(target) == wanted(docs[2:])
        assert seen and set(seen) == {shuffled}
        seen.clear()


def test_landing_areas_of_queries_go_and_are_zstd(spark, scratch, monkeypatch):
    rows = [(1, "a b\nc, d", "en", "web", 8), (2, "e", "fr", "web", 1)]
    docs = fixtures.documents_of(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"))
    landed, before = [], loading.run

    def spy(spark, feed, *args):
        landed.append((feed.landing, scan(spark, feed.landing, feed.schema).count()))
        return before(spark, feed, *args)

    monkeypatch.setattr(loading, "run", spy)
    target = Tables(spark, f"l_{uuid.uuid4().hex[:8]}", f"{scratch}/tables", buckets=3)
    loading._run(spark, docs, Mode.BULK, target)
    assert [n for _, n in landed] == [2] and not exists(spark, landed[0][0])
    assert target.read("text_feed_words").count() == 5

    monkeypatch.setattr(fixtures, "nominal_documents", lambda spark, sf: docs)
    path = fixtures.landed_nominal(spark, scratch)
    assert all(".zstd." in f for f in spark.read.parquet(path).inputFiles())
