"""Whole runs over CSV files, with numbers worked out by hand."""

from __future__ import annotations

import random
import time
from datetime import date

import pytest

from daybook import CurrencyError, DataQualityError, ParamError, Params, SchemaError
from daybook.contracts import T_ADS_CLEAN, T_ADS_DAILY, T_MODEL, T_ORDERS_CLEAN, T_ORDERS_DAILY
from daybook.operators import DQReport, check_ads, enforce_threshold, interval_samples, rejected
from daybook.plans import add_exports, ingest_ads, ingest_orders, load_model, period_kpis, run, run_summary
from daybook.plans.daily_run import STAGED
from daybook.sources import TableStore
from daybook.sources.tables import Version

# The five-day example.
# (id, day and time in UTC, status, gross, discount, taxes, shipping); net = gross - discount
ORDERS = [
    ("S001", "01 08:00", "paid", 1000, 100, 135, 50),
    ("S002", "01 14:00", "paid", 500, 0, 75, 0),
    ("S003", "01 22:30", "paid", 200, 0, 30, 0),
    ("S004", "02 10:00", "paid", 800, 50, 112.5, 30),
    ("S005", "02 15:00", "cancelled", 400, 0, 60, 0),
    ("S006", "03 09:00", "paid", 600, 0, 90, 20),
    ("S007", "03 11:00", "refunded", 300, 0, 45, 0),
    ("S008", "04 12:00", "partially_refunded", 700, 70, 94.5, 40),
]
# (day, campaign, spend in USD, impressions, clicks)
ADS = [
    (1, "Campaign A", 50, 10000, 200),
    (1, "Campaign B", 20, 4000, 80),
    (2, "Campaign A", 40, 8000, 160),
    (3, "Campaign A", 30, 6000, 120),
    (5, "Campaign A", 10, 2000, 40),
]
# gross, discount, net, taxes, shipping, orders, spend, impressions, clicks, cogs, margin
DAILY = {
    1: (1500, 100, 1400, 210, 50, 2, 9100, 14000, 280, 600, -8300),
    2: (1000, 50, 950, 142.5, 30, 2, 5200, 8000, 160, 400, -4650),
    3: (600, 0, 600, 90, 20, 1, 3900, 6000, 120, 240, -3540),
    4: (700, 70, 630, 94.5, 40, 1, 0, None, None, 280, 350),
    5: (0, 0, 0, 0, 0, 0, 1300, 2000, 40, 0, -1300),
}

ORDER_HEADER = (
    "Order ID,Created at,Financial Status,Gross Amount,Discount Amount,"
    "Net Amount,Taxes,Shipping fees,Currency"
)
AD_HEADER = "Reporting Start,Reporting End,Campaign Name,Amount Spent (USD),Impressions,Link Clicks"


@pytest.fixture
def exports(tmp_path):
    orders = [
        f"{oid},2026-09-{at}:00 UTC,{status},{gross:.2f},{off:.2f},{gross - off:.2f},"
        f"{tax:.2f},{ship:.2f},ETB"
        for oid, at, status, gross, off, tax, ship in ORDERS
    ]
    ads = [
        f"2026-09-{day:02},2026-09-{day:02},{name},{usd:.2f},{shown},{clicked}"
        for day, name, usd, shown, clicked in ADS
    ]
    return save(tmp_path, [ORDER_HEADER, *orders], [AD_HEADER, *ads])


def save(folder, order_lines, ad_lines):
    paths = []
    for name, lines in (("orders.csv", order_lines), ("ads.csv", ad_lines)):
        (folder / name).write_text("\n".join(lines), encoding="utf-8")
        paths.append(str(folder / name))
    return paths


def test_five_days(spark, exports, store):
    result = run(spark, *exports, store)
    rows = {r.calendar_date.day: r for r in load_model(store).collect()}
    assert list(rows) == [1, 2, 3, 4, 5]
    for day, expected in DAILY.items():
        got = rows[day]
        assert tuple(got)[1:12] == expected
        gross, _, net, _, _, _, spend, _, _, _, margin = expected
        assert got.roas == (net / spend if spend else None)
        assert got.mer == (spend / net if net else None)
        assert got.profit_margin == (margin / net if net else None)
        assert got.reporting_currency == "ETB"

    assert result.orders_report.rows_received == 8
    assert result.orders_report.rows_accepted == 6
    assert dict(result.orders_report.reasons) == {"excluded_status": 2}
    assert result.ads_report.rows_received == 5 and result.ads_report.rows_rejected == 0

    kpis = period_kpis(result.model, Params()).head()
    assert (kpis.total_net_revenue, kpis.total_ad_spend) == (3580, 19500)
    assert (kpis.total_contribution_margin, kpis.total_orders) == (-17440, 6)
    assert kpis.administrative_hours_saved == 2.9
    summary = run_summary(result.model).head()
    assert (summary.dates_min, summary.dates_max) == (date(2026, 9, 1), date(2026, 9, 5))

    assert store.read(T_ORDERS_DAILY).count() == 4 and store.read(T_ADS_DAILY).count() == 4
    on_sep_2 = store.read(T_ORDERS_CLEAN).where("calendar_date = '2026-09-02'").collect()
    assert sorted(r.order_id for r in on_sep_2) == ["S003", "S004"]


def test_running_again_changes_nothing(spark, exports, store):
    first = run(spark, *exports, store)
    rows = load_model(store).collect()
    second = run(spark, *exports, store)
    assert load_model(store).collect() == rows
    assert first.orders_report == second.orders_report


def test_a_catalog_works_like_a_folder(spark, exports):
    spark.sql("CREATE DATABASE IF NOT EXISTS daybook_run")
    try:
        store = TableStore(spark, database="daybook_run", keep=1)
        for _ in range(2):
            run(spark, *exports, store)
        assert spark.table("daybook_run.daily_financial_model").count() == 5
        assert store.read(T_MODEL).count() == store.snapshot().read(T_MODEL).count() == 5
        names = [r.tableName for r in spark.sql("SHOW TABLES IN daybook_run").collect()]
        assert sum(n.startswith(f"{T_MODEL}__") for n in names) == store.keep
        store.write(store.read(T_MODEL).limit(2), T_MODEL)
        assert spark.table("daybook_run.daily_financial_model").count() == 2
        store.drop(T_MODEL)
        assert not store.exists(T_MODEL)
    finally:
        spark.sql("DROP DATABASE daybook_run CASCADE")


GOOD = "paid,100,0,100,15,0,ETB"
MESSY_ORDERS = [
    "Created At,Order ID,Status,Gross Sales,Discount,Net,Tax,Shipping,Currency,Note",
    f"2026-09-01 09:15:00 UTC,1,{GOOD},a",
    f'"2026-09-01T10:00:00Z",2," PAID ","$1,000.00",n/a,"(50.00)",15,0,ETB,"b, ""c"""',
    f"2026-09-01 11:00:00 UTC,2,{GOOD},later copy",
    f"2026-09-02,,{GOOD},no id",
    "2026-09-02 10:00:00 UTC,4,,,,,,,ETB,",
    f" ,5,{GOOD},blank time",
    "2026-09-03,6,paid,many,0,many,0,0,ETB,",
    f"soon,7,{GOOD},",
    f"2026-09-04 23:30:00 UTC,8,{GOOD},",
    "2026-09-05,9,cancelled,400,0,400,60,0,ETB,",
    "2026-09-05,10,lost,400,0,400,60,0,ETB,",
    ",,,,,,,,,",
]
MESSY_ADS = [
    "Date Start,Date End,Spend,Clicks",
    "2026/09/01,2026-09-01,10,5",
    "2026-09-01,2026-09-07,800,5500",
    "2026-09-02,2026-09-02,,600",
    "2026-09-03,2026-09-03,free,1",
    "2026-09-03,x,1,1",
    "2026-09-07,2026-09-07,0.00,",
]


def test_messy_exports(spark, tmp_path, store):
    paths = save(tmp_path, MESSY_ORDERS, MESSY_ADS)
    result = run(spark, *paths, store, Params(dq_rejection_threshold=1))
    assert dict(result.orders_report.reasons) == {
        "empty_row": 1,
        "missing_required_value": 3,
        "duplicate_order_id": 1,
        "invalid_created_at": 1,
        "invalid_money": 1,
        "excluded_status": 2,
    }
    assert (result.orders_report.rows_received, result.orders_report.rows_accepted) == (12, 3)
    assert dict(result.ads_report.reasons) == {
        "missing_required_value": 1,
        "invalid_meta_date": 1,
        "multi_day_interval": 1,
        "invalid_spend": 1,
    }
    assert result.orders_header.unexpected == ("Note",)
    assert result.ads_header.absent == ("campaign_name", "impressions")

    assert [tuple(r) for r in result.unknown_statuses().collect()] == [("lost", 1)]
    assert [r.reporting_start for r in result.interval_samples().collect()] == [date(2026, 9, 1)]
    assert rejected(result.checked_orders).count() == result.orders_report.rows_rejected

    orders = {r.order_id: r for r in store.read(T_ORDERS_CLEAN).collect()}
    assert set(orders) == {"1", "2", "8"}
    assert (orders["2"].gross_amount, orders["2"].discount_amount) == (1000.0, 0.0)
    assert orders["2"].net_amount == -50.0
    assert orders["8"].calendar_date == date(2026, 9, 5)
    assert "Note" not in store.read(T_ORDERS_CLEAN).columns

    ads = store.read(T_ADS_CLEAN).orderBy("calendar_date").collect()
    assert [(r.spend_amount, r.campaign_name, r.impressions, r.link_clicks) for r in ads] == [
        (1300.0, None, None, 5),
        (0.0, None, None, None),
    ]
    model = {r.calendar_date.day: r for r in load_model(store).collect()}
    assert list(model) == [1, 2, 3, 4, 5, 6, 7]
    assert (model[1].net_revenue, model[1].orders, model[1].mer) == (50.0, 2, 26.0)
    assert (model[7].roas, model[7].reporting_currency) == (None, "ETB")
    assert model[6].reporting_currency is None


def test_rejected_rows_can_be_looked_at(spark, tmp_path, store):
    paths = save(tmp_path, MESSY_ORDERS, MESSY_ADS)
    rows = rejected(ingest_orders(spark, paths[0], store).rows).collect()
    assert {(r.order_id, r.rejection_reason) for r in rows} == {
        ("2", "duplicate_order_id"),
        (None, "missing_required_value"),
        ("4", "missing_required_value"),
        ("5", "missing_required_value"),
        (None, "empty_row"),
    }
    (copy,) = [r for r in rows if r.rejection_reason == "duplicate_order_id"]
    assert copy["Note"] == "later copy"


def test_only_ingestion_counts_for_the_threshold(spark, exports, tmp_path, store):
    run(spark, *exports, store, Params(dq_rejection_threshold=0))  # 2 of 8 excluded later
    messy = save(tmp_path, MESSY_ORDERS, MESSY_ADS)
    with pytest.raises(DataQualityError, match="rows were rejected"):
        run(spark, *messy, store, Params(dq_rejection_threshold="0.4"))


@pytest.mark.parametrize(("fails_at", "error"), [(1, KeyboardInterrupt), (9, RuntimeError)])
def test_a_run_that_breaks_off_leaves_the_model_before_it(spark, exports, tmp_path, store, monkeypatch, fails_at, error):
    run(spark, *exports, store)
    before = {name: store.read(name).collect() for name in (T_ORDERS_CLEAN, T_ADS_DAILY, T_MODEL)}
    files = sorted(p for p in (tmp_path / "store").rglob("*") if p.is_file())
    inner, calls = Version.write, []

    def write(self, df, name):
        stored = inner(self, df, name)  # the table is there, the run is not complete
        calls.append(name)
        if len(calls) > fails_at:
            raise error(name)
        return stored

    monkeypatch.setattr(Version, "write", write)
    fewer = save(tmp_path, [ORDER_HEADER, "S9,2026-09-09,paid,1,0,1,0,0,ETB"], [AD_HEADER])
    with pytest.raises(error):
        run(spark, *fewer, store)
    assert len(calls) == fails_at + 1
    assert before == {name: store.read(name).collect() for name in before}
    assert sorted(p for p in (tmp_path / "store").rglob("*") if p.is_file()) == files
    monkeypatch.undo()
    assert [r.calendar_date.day for r in run(spark, *fewer, store).model.collect()] == [9]


def test_a_killed_run_is_cleared_away_later(spark, tmp_path):
    store = TableStore(spark, root=str(tmp_path / "store"), orphan_days=0)
    store.begin().write(spark.range(3), T_MODEL)  # never published
    assert not store.exists(T_MODEL)
    time.sleep(1.1)
    for _ in range(4):
        store.write(spark.range(3), T_MODEL)
    assert len(list((tmp_path / "store" / "versions").iterdir())) == store.keep
    assert len(list((tmp_path / "store" / "published").glob("0*"))) == store.keep


def split_at_random(rng, lines, n):
    """The lines in n runs that keep their order."""
    cuts = sorted(rng.randint(0, len(lines)) for _ in range(n - 1))
    return [lines[a:b] for a, b in zip([0, *cuts], [*cuts, len(lines)], strict=True)]


def test_added_exports_give_what_one_run_gives(spark, tmp_path):
    rng = random.Random(1)
    orders = [
        f"{rng.choice(['', *map(str, range(30))])},{rng.choice(['soon', f'2026-09-{rng.randint(1, 28):02} 0{rng.randint(0, 9)}:00'])},"
        f"{rng.choice(['paid', 'paid', 'lost'])},{rng.uniform(0, 9e5)},0,{rng.choice(['x', rng.uniform(0, 1e-3)])},1,0,ETB"
        for _ in range(90)
    ]
    ads = [
        f"2026-09-{(d := rng.randint(1, 28)):02},2026-09-{d:02},A,{rng.uniform(0, 3)},{rng.choice(['', 7])},{rng.choice(['', 3])}"
        for _ in range(40)
    ]
    lenient = Params(dq_rejection_threshold=1, cogs_percentage="0.3")
    whole = TableStore(spark, root=str(tmp_path / "whole"))
    run(spark, *save(tmp_path, [ORDER_HEADER, *orders], [AD_HEADER, *ads]), whole, lenient)
    parts = TableStore(spark, root=str(tmp_path / "parts"), keep=1)
    for k, (some, more) in enumerate(zip(split_at_random(rng, orders, 2), split_at_random(rng, ads, 2), strict=True)):
        folder = tmp_path / f"export-{k}"
        folder.mkdir()
        result = add_exports(spark, *save(folder, [ORDER_HEADER, *some], [AD_HEADER, *more]), parts, lenient)
        assert result.orders_report.rows_received == len(some)
    for name in (T_ORDERS_CLEAN, T_ADS_CLEAN, T_ORDERS_DAILY, T_ADS_DAILY, T_MODEL):
        got, want = (sorted(map(repr, s.read(name).collect())) for s in (parts, whole))
        assert got == want
    with pytest.raises(ParamError, match="run over all exports"):
        add_exports(spark, *save(tmp_path, [ORDER_HEADER], [AD_HEADER]), parts, Params(orders_currency="USD"))
    result.discard_staged()
    with pytest.raises(ParamError, match="discarded"):
        add_exports(spark, *save(tmp_path, [ORDER_HEADER], [AD_HEADER]), parts, lenient)


def test_exports_are_added_in_a_catalog(spark, exports, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS daybook_add")
    try:
        store = TableStore(spark, database="daybook_add", keep=1)
        run(spark, *exports, store)
        more = save(tmp_path, [ORDER_HEADER, "S9,2026-09-09,paid,1,0,1,0,0,ETB", "S001,2026-09-09,paid,1,0,1,0,0,ETB"], [AD_HEADER])
        result = add_exports(spark, *more, store, Params(dq_rejection_threshold=1))
        assert dict(result.orders_report.reasons) == {"duplicate_order_id": 1}
        assert store.read(T_ORDERS_CLEAN).count() == spark.table(f"daybook_add.{T_ORDERS_CLEAN}").count() == 7
        assert load_model(store).count() == 9
    finally:
        spark.sql("DROP DATABASE daybook_add CASCADE")


def test_a_reader_keeps_its_version(spark, exports, tmp_path, store):
    run(spark, *exports, store)
    seen = store.snapshot()
    run(spark, *save(tmp_path, [ORDER_HEADER], [AD_HEADER]), store)
    assert load_model(seen).count() == 5 and load_model(store).count() == 0


def test_staged_rows_can_be_discarded(spark, exports, tmp_path, store):
    result = run(spark, *exports, store)
    assert rejected(result.checked_orders).count() == 2
    result.discard_staged()
    assert not any(store.exists(name) for name in STAGED) and store.exists(T_MODEL)


def test_the_limit_itself_is_allowed():
    for rejected_rows, rows, threshold in ((29, 100, 0.29), (58, 200, 0.29), (0, 0, 0.0)):
        enforce_threshold(DQReport("orders", rows, {"empty_row": rejected_rows}), threshold)
    with pytest.raises(DataQualityError, match="30 of 100"):
        enforce_threshold(DQReport("orders", 100, {"empty_row": 30}), 0.29)


def test_unusable_input(spark, exports, tmp_path, store):
    with pytest.raises(SchemaError):
        run(spark, str(tmp_path / "absent.csv"), exports[1], store)
    with pytest.raises(SchemaError, match="no column fits"):
        run(spark, exports[1], exports[0], store)
    wide = save(tmp_path, [ORDER_HEADER, "1,2,3,4,5,6,7,8,9,10"], [AD_HEADER])
    with pytest.raises(SchemaError, match="more cells"):
        run(spark, *wide, store)
    with pytest.raises(CurrencyError):
        run(spark, *exports, store, Params(ads_currency="GBP"))


def test_headers_alone_give_an_empty_model(spark, tmp_path, store):
    result = run(spark, *save(tmp_path, [ORDER_HEADER], [AD_HEADER]), store)
    assert result.model.count() == 0
    assert result.orders_report.rows_received == 0 and result.ads_report.rows_received == 0
    assert tuple(run_summary(result.model).head()) == (None, None, 0.0, 0.0, 0.0, "?")


def test_interval_samples_of_a_file(spark, tmp_path, store):
    paths = save(tmp_path, MESSY_ORDERS, MESSY_ADS)
    checked = check_ads(ingest_ads(spark, paths[1], store).rows)
    assert [r.reporting_start for r in interval_samples(checked).collect()] == [date(2026, 9, 1)]
