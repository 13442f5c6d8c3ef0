from __future__ import annotations

from datetime import date, timedelta

import pytest

from daybook import Params
from daybook.contracts import ADS_CLEAN, DAILY_MODEL, ORDERS_CLEAN
from daybook.operators import ads_daily, date_bounds, date_spine, orders_daily
from daybook.plans import daily_model
from tests.conftest import plan_of


def sep(day: int) -> date:
    return date(2026, 9, day)


def orders(spark, *rows):
    """Rows of (id, day, net[, gross[, discount[, currency]]])."""
    data = []
    for order_id, day, net, *rest in rows:
        gross, discount, currency = [*rest, *(None, 0.0, "ETB")[len(rest) :]]
        gross = net if gross is None else gross
        data.append((order_id, day, None, "paid", gross, discount, net, 1.0, 2.0, currency))
    return spark.createDataFrame(data, ORDERS_CLEAN)


def ads(spark, *rows):
    """Rows of (day, spend[, impressions, clicks])."""
    data = []
    for day, spend, *counts in rows:
        impressions, clicks = counts or (1000, 50)
        data.append((day, "A", float(spend), impressions, clicks, "ETB"))
    return spark.createDataFrame(data, ADS_CLEAN)


def model(spark, order_frame, ad_frame, params=None):
    return daily_model(order_frame, ad_frame, params or Params()).collect()


def test_both_sources_on_one_day(spark):
    (row,) = model(
        spark, orders(spark, ("1", sep(1), 900.0, 1000.0, 100.0)), ads(spark, (sep(1), 130))
    )
    assert row.asDict() == {
        "calendar_date": sep(1),
        "gross_revenue": 1000.0,
        "discount_amount": 100.0,
        "net_revenue": 900.0,
        "taxes": 1.0,
        "shipping_fees": 2.0,
        "orders": 1,
        "ad_spend": 130.0,
        "impressions": 1000,
        "link_clicks": 50,
        "cogs_estimate": 400.0,
        "contribution_margin": 370.0,
        "roas": 900 / 130,
        "mer": 130 / 900,
        "profit_margin": 370 / 900,
        "reporting_currency": "ETB",
    }


def test_revenue_without_spend(spark):
    (row,) = model(spark, orders(spark, ("1", sep(1), 100.0)), ads(spark))
    assert (row.net_revenue, row.ad_spend, row.roas, row.mer) == (100.0, 0.0, None, 0.0)
    assert row.impressions is None and row.link_clicks is None
    assert row.reporting_currency == "ETB"


def test_spend_without_revenue(spark):
    (row,) = model(spark, orders(spark), ads(spark, (sep(1), 100)))
    assert (row.net_revenue, row.orders, row.ad_spend) == (0.0, 0, 100.0)
    assert (row.contribution_margin, row.roas, row.mer, row.profit_margin) == (-100, 0.0, None, None)


def test_negative_revenue_has_no_ratios(spark):
    (row,) = model(spark, orders(spark, ("1", sep(1), -5.0)), ads(spark, (sep(1), 10)))
    assert (row.roas, row.mer, row.profit_margin) == (-0.5, None, None)


def test_gaps_are_filled(spark):
    rows = model(
        spark,
        orders(spark, ("1", sep(1), 100.0), ("2", sep(4), 200.0)),
        ads(spark, (sep(4), 50), (sep(6), 5)),
    )
    assert [r.calendar_date for r in rows] == [sep(d) for d in range(1, 7)]
    gap = rows[1]
    assert (gap.net_revenue, gap.ad_spend, gap.orders, gap.cogs_estimate) == (0.0, 0.0, 0, 0.0)
    assert gap.roas is None and gap.impressions is None and gap.reporting_currency is None


def test_unknown_counters_stay_null(spark):
    rows = model(
        spark,
        orders(spark, ("1", sep(1), 100.0)),
        ads(spark, (sep(1), 50, None, None), (sep(2), 1, None, 7), (sep(2), 1, 3, None)),
    )
    assert [(r.impressions, r.link_clicks) for r in rows] == [(None, None), (3, 7)]


def test_cost_share_is_a_parameter(spark):
    (row,) = model(
        spark,
        orders(spark, ("1", sep(1), 900.0, 1000.0)),
        ads(spark, (sep(1), 100)),
        Params(cogs_percentage="0.25"),
    )
    assert (row.cogs_estimate, row.contribution_margin) == (250.0, 550.0)


def test_no_rows_at_all(spark):
    empty = daily_model(orders(spark), ads(spark), Params())
    assert empty.collect() == []
    assert [(f.name, f.dataType) for f in empty.schema] == [
        (f.name, f.dataType) for f in DAILY_MODEL
    ]


def test_orders_are_counted_once_each(spark):
    frame = orders(
        spark,
        ("1", sep(1), 10.0, 12.0, 2.0),
        ("1", sep(1), 10.0, 12.0, 2.0),
        ("2", sep(1), 10.0, 11.0, 1.0, "USD"),
        ("2", sep(2), 10.0),
        (None, sep(3), 10.0, 11.0, 1.0),
    )
    rows = orders_daily(frame).orderBy("calendar_date").collect()
    assert [(r.orders, r.gross_revenue, r.avg_discount_per_order) for r in rows] == [
        (2, 35.0, 2.5),
        (1, 10.0, 0.0),
        (0, 11.0, None),
    ]
    assert rows[0].reporting_currency == "USD"
    unique = orders(spark, ("1", sep(1), 10.0), ("2", sep(1), 20.0), ("3", sep(2), 5.0))
    assert (
        orders_daily(unique, unique_orders=True).orderBy("calendar_date").collect()
        == orders_daily(unique).orderBy("calendar_date").collect()
    )


def test_ad_rows_are_counted(spark):
    rows = ads_daily(ads(spark, (sep(1), 1), (sep(1), 2), (sep(2), 3, None, None)))
    assert [
        (r.ad_spend, r.impressions, r.meta_row_count) for r in rows.orderBy("calendar_date").collect()
    ] == [(3.0, 2000, 2), (3.0, None, 1)]


def test_spine_of_one_or_no_source(spark):
    daily = ads_daily(ads(spark, (sep(3), 1), (sep(1), 1)))
    nothing = ads_daily(ads(spark))
    assert [r[0] for r in date_spine(daily, nothing).collect()] == [sep(1), sep(2), sep(3)]
    assert date_spine(nothing, nothing).collect() == []
    assert tuple(date_bounds(nothing, nothing).head()) == (None, None)


def test_spine_length_and_totals(spark):
    frame = orders(spark, *((str(i), sep(1) + timedelta(days=i * i), 0.1 * i) for i in range(12)))
    rows = model(spark, frame, ads(spark))
    assert len(rows) == 11 * 11 + 1
    assert sum(r.orders for r in rows) == 12
    assert sum(r.net_revenue for r in rows) == pytest.approx(6.6)


def test_daily_sums_use_hash_aggregation_over_the_rows(spark, tmp_path):
    """The currency maximum must not make Spark sort all orders."""
    orders(spark, ("1", sep(1), 1.0)).write.parquet(str(tmp_path / "o"))
    plan = plan_of(orders_daily(spark.read.parquet(str(tmp_path / "o")), unique_orders=True))
    lines = [line for line in plan.splitlines() if "Aggregate" in line or "Scan" in line]
    assert "Scan" in lines[-1]
    assert "HashAggregate" in lines[-2] and "partial_" in lines[-2]
    assert "created_at_utc" not in lines[-1] and "financial_status" not in lines[-1]
    assert "distinct" not in plan
