from __future__ import annotations

import csv
import glob
from datetime import date

import pytest
from pyspark.sql import types as T

from daybook import Params
from daybook.contracts import DAILY_MODEL, EXPORT_HEADERS, T_MODEL
from daybook.plans import (
    load_model,
    model_date_range,
    model_exists,
    period_kpis,
    run_summary,
    with_roas_bands,
)
from daybook.sources import TableStore, report_frame, write_report
from tests.conftest import plan_of

# (day, net, spend, margin, orders): fixed values of the five-day example
FIVE_DAYS = [
    (1, 1400.0, 9100.0, -8300.0, 2),
    (2, 950.0, 5200.0, -4650.0, 2),
    (3, 600.0, 3900.0, -3540.0, 1),
    (4, 630.0, 0.0, 350.0, 1),
    (5, 0.0, 1300.0, -1300.0, 0),
]


def model(spark, rows=FIVE_DAYS, **extra):
    data = []
    for day, net, spend, margin, orders in rows:
        values = dict.fromkeys(DAILY_MODEL.fieldNames())
        values |= {"calendar_date": date(2026, 9, day), "net_revenue": net, "ad_spend": spend}
        values |= {"contribution_margin": margin, "orders": orders, "reporting_currency": "ETB"}
        values |= extra
        data.append(tuple(values.values()))
    return spark.createDataFrame(data, DAILY_MODEL)


def test_period_kpis_are_ratios_of_sums(spark):
    k = period_kpis(model(spark), Params()).head()
    assert (k.total_net_revenue, k.total_ad_spend, k.total_contribution_margin) == (
        3580.0,
        19500.0,
        -17440.0,
    )
    assert k.total_orders == 6
    assert k.profit_margin == pytest.approx(-17440 / 3580)
    assert k.blended_roas == pytest.approx(3580 / 19500)
    assert k.meta_spend_ratio == pytest.approx(19500 / 3580)
    assert (k.administrative_hours_saved, k.reporting_currency) == (2.9, "ETB")


def test_period_kpis_of_nothing(spark):
    k = period_kpis(model(spark, []), Params(reporting_currency="EUR")).head()
    assert k.asDict() == {
        "total_net_revenue": 0.0,
        "total_ad_spend": 0.0,
        "total_contribution_margin": 0.0,
        "profit_margin": None,
        "blended_roas": None,
        "meta_spend_ratio": None,
        "total_orders": 0,
        "administrative_hours_saved": 0.0,
        "reporting_currency": "EUR",
    }


@pytest.mark.parametrize(
    ("last_day", "per_week", "hours"), [(1, "4.0", 0.6), (7, "4.0", 4.0), (7, "10.0", 10.0), (5, "4", 2.9)]
)
def test_hours_saved_are_prorated(spark, last_day, per_week, hours):
    frame = model(spark, [(1, 0.0, 0.0, 0.0, 0), (last_day, 0.0, 0.0, 0.0, 0)])
    k = period_kpis(frame, Params(admin_hours_per_week=per_week)).head()
    assert k.administrative_hours_saved == hours


def test_period_guards(spark):
    no_spend = period_kpis(model(spark, [(1, 100.0, 0.0, 100.0, 1)]), Params()).head()
    assert (no_spend.blended_roas, no_spend.meta_spend_ratio) == (None, 0.0)
    no_revenue = period_kpis(model(spark, [(1, 0.0, 100.0, -100.0, 0)]), Params()).head()
    assert (no_revenue.blended_roas, no_revenue.meta_spend_ratio) == (0.0, None)
    assert no_revenue.profit_margin is None


def test_run_summary(spark):
    s = run_summary(model(spark)).head()
    assert (s.dates_min, s.dates_max) == (date(2026, 9, 1), date(2026, 9, 5))
    assert (s.total_net_revenue, s.total_ad_spend, s.currency) == (3580.0, 19500.0, "ETB")
    assert tuple(run_summary(model(spark, [])).head()) == (None, None, 0.0, 0.0, 0.0, "?")


def test_bands_over_the_model(spark):
    rows = [(d, r, 0.0, 0.0, 0) for d, r in ((1, 4.0), (2, 2.0), (3, 1.0))]
    banded = with_roas_bands(model(spark, rows), Params(), roas="net_revenue")
    assert [(r.roas_band, r.roas_label) for r in banded.orderBy("calendar_date").collect()] == [
        ("green", "+ On target"),
        ("amber", "~ Watch"),
        ("red", "- Below"),
    ]


def test_loading_with_bounds(spark, store):
    assert not model_exists(store) and model_date_range(store) is None
    store.write(model(spark, FIVE_DAYS[::-1]).repartition(3), T_MODEL)
    assert model_exists(store)
    assert model_date_range(store) == (date(2026, 9, 1), date(2026, 9, 5))

    def days(*bounds):
        return [r.calendar_date.day for r in load_model(store, *bounds).collect()]

    assert days() == [1, 2, 3, 4, 5]
    assert days(date(2026, 9, 2), date(2026, 9, 4)) == [2, 3, 4]
    assert days(date(2026, 9, 4)) == [4, 5]
    assert days(None, date(2026, 9, 1)) == [1]
    assert days(date(2027, 1, 1)) == []
    assert load_model(store).columns == DAILY_MODEL.fieldNames()


def test_date_bounds_reach_the_scan(spark, store):
    store.write(model(spark), T_MODEL)
    plan = plan_of(load_model(store, date(2026, 9, 2)).select("net_revenue"))
    assert "GreaterThanOrEqual(calendar_date,2026-09-02)" in plan
    assert "ad_spend" not in plan


def test_writing_replaces_and_keeps_empty_schemas(spark, store):
    store.write(model(spark), T_MODEL)
    store.write(model(spark, FIVE_DAYS[:2]), T_MODEL)
    assert store.read(T_MODEL).count() == 2
    store.write(model(spark, []), T_MODEL)
    assert store.read(T_MODEL).schema == DAILY_MODEL
    assert model_exists(store) and model_date_range(store) is None


def test_catalog_store(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS daybook_test")
    store = TableStore(spark, database="daybook_test")
    assert not model_exists(store)
    store.write(model(spark), T_MODEL)
    store.write(model(spark), T_MODEL)
    assert spark.table(f"daybook_test.{T_MODEL}").count() == 5
    assert model_date_range(store) == (date(2026, 9, 1), date(2026, 9, 5))
    spark.sql("DROP DATABASE daybook_test CASCADE")


def test_store_needs_one_place(spark):
    with pytest.raises(ValueError):
        TableStore(spark)
    with pytest.raises(ValueError):
        TableStore(spark, root="x", database="y")


def exported(frame, path) -> list[list[str]]:
    write_report(frame, str(path))
    (part,) = glob.glob(f"{path}/part-*.csv")
    with open(part, newline="", encoding="utf-8") as handle:
        return list(csv.reader(handle))


def test_export_has_display_headers_and_plain_numbers(spark, tmp_path):
    frame = model(
        spark,
        FIVE_DAYS[::-1],
        gross_revenue=12345678.5,
        taxes=900.123456,
        shipping_fees=1e9,
        impressions=14000,
        roas=6.923076923,
        mer=0.5,
        profit_margin=-0.00004,
    )
    header, *rows = exported(frame.repartition(3), tmp_path / "out")
    assert header == list(EXPORT_HEADERS.values())
    assert [r[0] for r in rows] == [f"2026-09-0{d}" for d in range(1, 6)]
    first = dict(zip(header, rows[0], strict=True))
    assert first == {
        "Date": "2026-09-01",
        "Gross Revenue": "12345678.5",
        "Discounts": "",
        "Net Revenue": "1400.0",
        "Taxes": "900.12",
        "Shipping Fees": "1000000000.0",
        "Orders": "2",
        "Ad Spend": "9100.0",
        "Impressions": "14000",
        "Link Clicks": "",
        "COGS Estimate": "",
        "Contribution Margin": "-8300.0",
        "ROAS": "6.9231",
        "Meta Spend / Net Revenue": "0.5",
        "Profit Margin": "0.0",
        "Currency": "ETB",
    }


def test_export_of_an_empty_model_has_headers(spark, tmp_path):
    assert exported(model(spark, []), tmp_path / "rows") == [list(EXPORT_HEADERS.values())]
    bare = spark.createDataFrame([], T.StructType())
    assert exported(bare, tmp_path / "columns") == [list(EXPORT_HEADERS.values())]


def test_export_skips_absent_and_foreign_columns(spark):
    frame = model(spark).selectExpr("net_revenue", "1 AS debug", "calendar_date")
    assert report_frame(frame).columns == ["Date", "Net Revenue"]
