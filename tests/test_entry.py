"""The driver contract, and every query against its oracle on the smallest tables."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
from daybook.contracts import DAILY_MODEL
from daybook_checks import queries
from daybook_checks.oracles import ORACLES
from daybook_checks.queries import QUERIES
from daybook_checks.compare import differences, oracle_connection
from tests.conftest import plan_of

SMALL = driver.SMOKE_DIR

pytestmark = pytest.mark.skipif(not os.path.isdir(SMALL), reason="test tables are absent")


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SMALL)


def test_entry(spark):
    frame = driver.entry(spark)
    assert frame.columns == DAILY_MODEL.fieldNames()
    assert frame.count() > 0


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLES.keys()
    assert driver.oracle_sql().keys() <= driver.queries().keys()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    rows, diff = differences(spark, con, name, SMALL)
    assert not diff
    assert rows > 0 or name == "unknown_statuses"


@pytest.mark.parametrize("name", ["money_parse", "timestamp_parse", "dq_report_ads", "ads_clean"])
def test_queries_stay_in_the_jvm(spark, name):
    plan = plan_of(driver.queries()[name](spark, SMALL))
    assert "Python" not in plan and "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_lines_are_summed_once_for_both_exports(spark, monkeypatch):
    read, write = [], queries._write_csv

    def spied(raw, *rest):
        read.extend(raw.inputFiles())
        write(raw, *rest)

    monkeypatch.setattr(queries, "_write_csv", spied)
    assert QUERIES["incremental_model"](spark, SMALL).count() > 0
    assert any("events" in file for file in read)
    assert not any("lineitem" in file for file in read)
