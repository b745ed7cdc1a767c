"""Every registered query against its SQL."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from arborload.queries.registry import QUERIES
from compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    frame = entry.queries()[name](spark, SF)
    rows, _ = compare(frame, con, entry.oracle_sql()[name])
    assert rows > 0


def test_entry(spark):
    assert entry.entry(spark).count() > 0
