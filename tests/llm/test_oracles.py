"""Queries beside their SQL on the smallest tables."""

from __future__ import annotations

import pytest

from daybook.llm.oracles import ORACLES
from daybook.llm.queries import QUERIES
from daybook_checks import compare

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, monkeypatch, name):
    monkeypatch.setattr(compare, "QUERIES", QUERIES)
    monkeypatch.setattr(compare, "ORACLES", ORACLES)
    rows, diff = compare.differences(spark, compare.oracle_connection(SMALL), name, SMALL)
    assert rows and not diff
