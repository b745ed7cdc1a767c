"""The options handed to Spark's JDBC source; no database is started."""

from __future__ import annotations

from types import SimpleNamespace

from arborload.sinks.jdbc import read_jdbc, write_jdbc


def test_append_options():
    calls = []

    class Writer:
        def mode(self, mode):
            calls.append(mode)
            return self

        def jdbc(self, url, table, properties):
            calls.append((url, table, properties))

    write_jdbc(SimpleNamespace(write=Writer()), "jdbc:x", "s.t", {"user": "u"}, connections=4)
    assert calls == [
        "append",
        ("jdbc:x", "s.t", {"batchsize": "10000", "numPartitions": "4", "user": "u"}),
    ]


def test_parallel_read_options():
    seen = {}

    def jdbc(url, table, **options):
        seen.update(options, url=url, table=table)
        return "frame"

    spark = SimpleNamespace(read=SimpleNamespace(jdbc=jdbc))
    assert read_jdbc(spark, "jdbc:x", "s.t", "id", 0, 1000, 8, {"user": "u"}) == "frame"
    assert seen == {
        "url": "jdbc:x",
        "table": "s.t",
        "column": "id",
        "lowerBound": 0,
        "upperBound": 1000,
        "numPartitions": 8,
        "properties": {"fetchsize": "10000", "user": "u"},
    }
