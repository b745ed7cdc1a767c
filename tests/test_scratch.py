from __future__ import annotations

from arborload.sinks.reports import report_path
from arborload.queries.fixtures import scratch_dir
from arborload.sources.scratch import directories, materialise, remove


def test_derived_inputs_are_below_the_configured_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one != two and one.startswith(base)


def test_materialised_rows_lose_their_lineage_and_can_be_removed(spark, scratch):
    rows, path = materialise(spark.range(100).where("id % 3 = 0"), scratch, "t")
    assert rows.count() == 34 and path.startswith(scratch)
    assert "Range" not in rows._jdf.queryExecution().executedPlan().toString()
    empty, other = materialise(spark.range(0), scratch, "t")
    assert empty.count() == 0
    assert {d.rsplit("/", 1)[-1] for d in directories(spark, scratch)} >= {p.rsplit("/", 1)[-1] for p in (path, other)}
    remove(spark, path)
    assert path.rsplit("/", 1)[-1] not in {d.rsplit("/", 1)[-1] for d in directories(spark, scratch)}
    assert directories(spark, f"{scratch}/absent") == {}


def test_report_path():
    from datetime import datetime

    path = report_path("b/", "updates", "x", datetime(2024, 2, 1, 3, 4))
    assert path == "b/report_summary/updates/x_20240201_0304.csv"
