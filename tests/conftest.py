from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import Column, DataFrame, SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from daybook.contracts import AD_FIELDS, ORDER_FIELDS, POSITION  # noqa: E402
from daybook.session import RECOMMENDED_CONF  # noqa: E402
from daybook.sources import TableStore  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    builder = SparkSession.builder.master("local[4]").appName("daybook-tests")
    conf = {
        **RECOMMENDED_CONF,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "4",
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("checkpoints")),
    }
    for key, value in conf.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path) -> TableStore:
    return TableStore(spark, root=str(tmp_path / "store"))


def evaluate(spark: SparkSession, make, inputs: list, kind: str = "string") -> list:
    """Apply a column function to a list of values and return the results in order."""
    rows = spark.createDataFrame(list(enumerate(inputs)), f"i int, v {kind}")
    expression: Column = make(rows["v"])
    return [r.x for r in rows.select("i", expression.alias("x")).orderBy("i").collect()]


def order_rows(spark: SparkSession, *rows: dict) -> DataFrame:
    """Raw order rows with defaults for the columns a test does not care about."""
    usual = {
        "order_id": "1",
        "created_at": "2026-09-01 09:00:00 UTC",
        "financial_status": "paid",
        "gross_amount": "100.00",
        "discount_amount": "0.00",
        "net_amount": "100.00",
        "taxes": "0.00",
        "shipping_fees": "0.00",
        "currency": "ETB",
    }
    return _positioned(spark, [f.name for f in ORDER_FIELDS], [{**usual, **r} for r in rows])


def ad_rows(spark: SparkSession, *rows: dict) -> DataFrame:
    usual = {
        "reporting_start": "2026-09-01",
        "reporting_end": "2026-09-01",
        "campaign_name": "A",
        "spend_amount": "100.00",
        "impressions": "1000",
        "link_clicks": "50",
    }
    return _positioned(spark, [f.name for f in AD_FIELDS], [{**usual, **r} for r in rows])


def _positioned(spark, names, rows) -> DataFrame:
    schema = ", ".join(f"{n} string" for n in names)
    data = [(*(r[n] for n in names), "f", 0, i) for i, r in enumerate(rows)]
    return spark.createDataFrame(
        data, f"{schema}, {POSITION[0]} string, {POSITION[1]} bigint, {POSITION[2]} bigint"
    )


def plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def optimized_plan_of(df: DataFrame) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()
