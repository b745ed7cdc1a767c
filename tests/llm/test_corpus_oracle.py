"""Queries that SQL can express, against it."""

from __future__ import annotations

import pytest

from arborload.llm.queries import ORACLES, QUERIES
from compare import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, name):
    rows, _ = compare(QUERIES[name](spark, SF), connect(SF), ORACLES[name])
    assert rows > 0
