from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from daybook import CurrencyError, ParamError, Params
from daybook.contracts import ADS_CLEAN, ORDERS_CLEAN, REASON
from daybook.operators import (
    ads_clean,
    check_ads,
    check_orders,
    dq_report,
    flag_ads,
    flag_orders,
    interval_samples,
    orders_clean,
    unknown_statuses,
)
from tests.conftest import ad_rows, order_rows, plan_of


def checked_orders(spark, *rows, params=None):
    return check_orders(flag_orders(order_rows(spark, *rows)), params or Params())


def clean(spark, *rows, params=None):
    params = params or Params()
    return orders_clean(checked_orders(spark, *rows, params=params), params).collect()


def reasons(checked):
    return dict(dq_report(checked, "x").reasons)


def test_order_becomes_typed(spark):
    (row,) = clean(
        spark,
        {
            "order_id": "1001",
            "created_at": "2026-09-01 09:15:00 UTC",
            "gross_amount": "1,500.00",
            "discount_amount": "$100",
            "net_amount": "ETB 1400.00",
            "taxes": "210.00",
            "shipping_fees": "50.00",
        },
    )
    assert row.asDict() == {
        "order_id": "1001",
        "calendar_date": date(2026, 9, 1),
        "created_at_utc": datetime(2026, 9, 1, 9, 15),
        "financial_status": "paid",
        "gross_amount": 1500.0,
        "discount_amount": 100.0,
        "net_amount": 1400.0,
        "taxes": 210.0,
        "shipping_fees": 50.0,
        "reporting_currency": "ETB",
    }


def test_clean_schemas(spark):
    def shape(schema):
        return [(f.name, f.dataType) for f in schema.fields]

    orders = orders_clean(checked_orders(spark, {}), Params())
    ads = ads_clean(check_ads(flag_ads(ad_rows(spark, {}))), Params())
    assert shape(orders.schema) == shape(ORDERS_CLEAN)
    assert shape(ads.schema) == shape(ADS_CLEAN)


def test_evening_orders_belong_to_the_next_business_day(spark):
    rows = clean(
        spark,
        {"order_id": "a", "created_at": "2026-09-01 20:30:00 UTC"},
        {"order_id": "b", "created_at": "2026-09-01 23:30:00 UTC"},
    )
    days = {r.order_id: r.calendar_date for r in rows}
    assert days == {"a": date(2026, 9, 1), "b": date(2026, 9, 2)}


@pytest.mark.parametrize(
    ("statuses", "kept"),
    [
        (("paid", "Paid", "partially_paid", "Partially Refunded"), 4),
        (("pending", "cancelled", "refunded", "voided", "disputed"), 0),
    ],
)
def test_only_recognised_statuses_count(spark, statuses, kept):
    rows = [{"order_id": s, "financial_status": s} for s in statuses]
    checked = checked_orders(spark, *rows)
    assert orders_clean(checked, Params()).count() == kept
    assert reasons(checked).get("excluded_status", 0) == len(statuses) - kept


def test_order_reasons_in_their_order(spark):
    checked = checked_orders(
        spark,
        {"order_id": "1", "created_at": "not-a-date", "gross_amount": "x"},
        {"order_id": "2", "gross_amount": "x", "financial_status": "voided"},
        {"order_id": "3", "net_amount": "n/a"},
        {"order_id": "4", "financial_status": "voided"},
        {"order_id": "5", "currency": None, "created_at": "not-a-date"},
        {"order_id": "6"},
    )
    assert {r.order_id: r[REASON] for r in checked.collect()} == {
        "1": "invalid_created_at",
        "2": "invalid_money",
        "3": "invalid_money",
        "4": "excluded_status",
        "5": "missing_required_value",
        "6": None,
    }


def test_unreadable_optional_money_is_zero(spark):
    (row,) = clean(spark, {"discount_amount": "n/a", "taxes": "?", "shipping_fees": "-"})
    assert (row.discount_amount, row.taxes, row.shipping_fees) == (0.0, 0.0, 0.0)


def test_order_money_is_converted(spark):
    usd = {"gross_amount": "100.00", "discount_amount": "10", "net_amount": "90.00", "taxes": "13.5"}
    (row,) = clean(spark, usd, params=Params(orders_currency="USD"))
    assert (row.gross_amount, row.discount_amount, row.net_amount) == (13000.0, 1300.0, 11700.0)
    assert (row.taxes, row.reporting_currency) == (1755.0, "ETB")
    (same,) = clean(spark, usd)
    assert same.gross_amount == 100.0


def test_unknown_currency_fails_before_any_job(spark):
    with pytest.raises(CurrencyError):
        orders_clean(checked_orders(spark, {}), Params(orders_currency="GBP"))


def test_a_zoned_input_is_taken_as_it_is(spark):
    rows = flag_orders(order_rows(spark, {})).withColumn(
        "created_at", F.lit(datetime(2026, 9, 1, 22, 30)).cast("timestamp")
    )
    (row,) = orders_clean(check_orders(rows, Params()), Params()).collect()
    assert row.created_at_utc == datetime(2026, 9, 1, 22, 30)
    assert row.calendar_date == date(2026, 9, 2)


def test_other_session_zones_are_refused(spark):
    rows = flag_orders(order_rows(spark, {}))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        with pytest.raises(ParamError, match="UTC"):
            check_orders(rows, Params())
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_unknown_statuses_are_reported_sorted(spark):
    statuses = ["Under Review", "disputed", "under-review", "voided", "paid"]
    rows = [{"order_id": str(i), "financial_status": s} for i, s in enumerate(statuses)]
    rows.append({"order_id": "9", "financial_status": "disputed", "gross_amount": "x"})
    report = unknown_statuses(checked_orders(spark, *rows), Params())
    assert [tuple(r) for r in report.collect()] == [("disputed", 1), ("under_review", 2)]


def checked_ads(spark, *rows):
    return check_ads(flag_ads(ad_rows(spark, *rows)))


def test_ad_row_becomes_typed(spark):
    row = {"campaign_name": " Summer  Sale ", "spend_amount": "$120.50", "impressions": "45000"}
    (got,) = ads_clean(checked_ads(spark, row), Params()).collect()
    assert tuple(got) == (date(2026, 9, 1), "Summer Sale", 15665.0, 45000, 50, "ETB")


def test_ad_reasons_in_their_order(spark):
    checked = checked_ads(
        spark,
        {"campaign_name": "a", "reporting_start": "x", "spend_amount": "x"},
        {"campaign_name": "b", "reporting_end": "x"},
        {"campaign_name": "c", "reporting_end": "2026-09-07", "spend_amount": "x"},
        {"campaign_name": "d", "spend_amount": "x"},
        {"campaign_name": "e", "spend_amount": None},
        {"campaign_name": "f", "reporting_start": "2026/9/1"},
    )
    assert {r.campaign_name: r[REASON] for r in checked.collect()} == {
        "a": "invalid_meta_date",
        "b": "invalid_meta_date",
        "c": "multi_day_interval",
        "d": "invalid_spend",
        "e": "missing_required_value",
        "f": None,
    }


def test_ad_nulls_and_zeros_stay_apart(spark):
    rows = ads_clean(
        checked_ads(
            spark,
            {"campaign_name": None, "impressions": None, "link_clicks": "n/a"},
            {"spend_amount": "0.00", "impressions": "0", "link_clicks": "0"},
        ),
        Params(),
    ).collect()
    assert sorted((r.spend_amount, r.campaign_name, r.impressions, r.link_clicks) for r in rows) == [
        (0.0, "A", 0, 0),
        (13000.0, None, None, None),
    ]


def test_ad_rates(spark):
    def spend(params):
        return ads_clean(checked_ads(spark, {}), params).head().spend_amount

    assert spend(Params(fx_rates={"USD": Decimal("135.0")})) == 13500.0
    assert spend(Params(reporting_currency="USD", fx_rates={"USD": 1})) == 100.0


def test_identical_ad_rows_all_count(spark):
    assert ads_clean(checked_ads(spark, {}, {}, {}), Params()).count() == 3


def test_interval_samples_come_in_input_order(spark):
    starts = ["2026-09-09", "2026-09-05", "2026-09-08", "2026-09-01"]
    rows = [{"reporting_start": s, "reporting_end": "2026-09-30"} for s in starts]
    samples = interval_samples(checked_ads(spark, {}, *rows))
    assert [r.reporting_start.isoformat() for r in samples.collect()] == starts[:3]


def test_reasons_are_counted_while_writing(spark):
    seen = Observation()
    flagged = flag_orders(order_rows(spark, {}, {"order_id": "2", "gross_amount": "x"}))
    checked = check_orders(flagged, Params(), seen)
    orders_clean(checked, Params()).write.format("noop").mode("overwrite").save()
    assert seen.get["received"] == 2 and seen.get["invalid_money"] == 1


def test_parsing_appears_once_in_the_plan_and_needs_no_python(spark, tmp_path):
    """A filter on the reason must not drag a second copy of the parsing along."""
    flag_orders(order_rows(spark, {})).write.parquet(str(tmp_path / "staged"))
    staged = spark.read.parquet(str(tmp_path / "staged"))
    plan = plan_of(orders_clean(check_orders(staged, Params()), Params()))
    thousands = plan.count(r"(?<=\d)")
    assert thousands == 5  # one per money column
    assert "Python" not in plan and "Pandas" not in plan
    flag_ads(ad_rows(spark, {})).write.parquet(str(tmp_path / "ads"))
    ads = spark.read.parquet(str(tmp_path / "ads"))
    assert plan_of(ads_clean(check_ads(ads), Params())).count(r"(?<=\d)") == 1
