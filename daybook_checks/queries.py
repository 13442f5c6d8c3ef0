"""One callable per surveyed operator: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook import functions as fn
from daybook import operators as op
from daybook import plans
from daybook.contracts import (
    AD_FIELDS,
    EMPTY_ROW,
    EXPORT_HEADERS,
    MISSING_REQUIRED,
    ORDER_FIELDS,
    POSITION,
    REASON,
    T_MODEL,
)
from daybook.params import Params
from daybook.session import RECOMMENDED_CONF, scratch_path, settle
from daybook.sources import TableStore, canonical_columns, read_export, write_report
from daybook_checks import frames

PARAMS = Params()
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Headers of the CSV files the queries write, one accepted spelling per column.
ORDER_HEADERS = (
    "Order ID",
    "Created at",
    "Financial Status",
    "Gross Amount",
    "Discounts",
    "Net Sales",
    "Total Tax",
    "Shipping fees",
    "Currency",
)
AD_HEADERS = (
    "Reporting Start",
    "Reporting End",
    "Campaign Name",
    "Amount Spent (USD)",
    "Impressions",
    "Link Clicks",
)

RANGE = (date(1995, 1, 10), date(1996, 6, 30))


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        for key in ("spark.sql.session.timeZone", "spark.sql.codegen.hugeMethodLimit"):
            spark.conf.set(key, RECOMMENDED_CONF[key])
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return function


# ------------------------------------------------------------------ expressions


@query
def money_parse(spark, sf_dir):
    signed = F.when(F.col("k") % 43 == 0, -F.col("net")).otherwise(F.col("net"))
    text = F.when(F.col("k") % 97 == 0, "1,25").otherwise(
        frames.money_text(signed, 4, F.col("k"), "ETB")
    )
    return frames.order_facts(spark, sf_dir).select("k", fn.parse_money(text).alias("amount"))


@query
def timestamp_parse(spark, sf_dir):
    text = F.when(F.col("k") % 101 == 0, "not-a-date").otherwise(
        frames.moment_text(F.col("moment"), F.col("k"))
    )
    return frames.order_facts(spark, sf_dir).select(
        "k", fn.parse_timestamp(text).alias("created_at_utc")
    )


@query
def reporting_date(spark, sf_dir):
    day = fn.reporting_date(F.col("moment"), PARAMS.reporting_timezone)
    return frames.order_facts(spark, sf_dir).select("k", day.alias("calendar_date"))


@query
def date_parse(spark, sf_dir):
    text = (
        F.when(F.col("e") % 101 == 0, "not-a-date")
        .when(F.col("e") % 97 == 0, F.date_format("day", "MM/dd/yyyy"))
        .otherwise(frames.day_text(F.col("day"), F.col("e")))
    )
    return frames.ad_facts(spark, sf_dir).select("e", fn.parse_date(text).alias("day"))


@query
def status_normalize(spark, sf_dir):
    return frames.order_facts(spark, sf_dir).select(
        "k", fn.status_key(frames.status_text()).alias("financial_status")
    )


@query
def campaign_normalize(spark, sf_dir):
    return frames.ad_facts(spark, sf_dir).select(
        "e", fn.campaign_label(frames.campaign_text()).alias("campaign_name")
    )


@query
def counter_parse(spark, sf_dir):
    text = F.when(F.col("e") % 97 == 0, "45,000").otherwise(F.col("value").cast("string"))
    return frames.ad_facts(spark, sf_dir).select("e", fn.parse_counter(text).alias("n"))


@query
def fx_convert(spark, sf_dir):
    spend = F.col("value").cast("double")
    return frames.ad_facts(spark, sf_dir).select(
        "e",
        fn.to_reporting_currency(spend, "usd", PARAMS).alias("converted"),
        fn.to_reporting_currency(spend, "etb", PARAMS).alias("unchanged"),
    )


# ----------------------------------------------------------------- data quality


def _staged_orders(spark, sf_dir) -> DataFrame:
    return settle(op.flag_orders(frames.raw_orders(spark, sf_dir)), "orders")


def _tagged_orders(spark, sf_dir) -> DataFrame:
    staged = _staged_orders(spark, sf_dir)
    return op.flag_repeats(staged, settle(op.repeated_keys(staged), "repeats"))


def _checked_orders(spark, sf_dir) -> DataFrame:
    return op.check_orders(_tagged_orders(spark, sf_dir), PARAMS)


def _checked_ads(spark, sf_dir) -> DataFrame:
    return op.check_ads(op.flag_ads(frames.raw_ads(spark, sf_dir)))


def _position(frame: DataFrame) -> DataFrame:
    return frame.select(F.col(POSITION[2]).alias("row_position"))


@query
def required_values(spark, sf_dir):
    flagged = op.flag_orders(frames.raw_orders(spark, sf_dir))
    return _position(flagged.where(F.col(REASON) == MISSING_REQUIRED))


@query
def empty_rows(spark, sf_dir):
    flagged = op.flag_ads(frames.raw_ads(spark, sf_dir))
    return _position(flagged.where(F.col(REASON) == EMPTY_ROW))


@query
def dedupe_first(spark, sf_dir):
    kept = op.accepted(_tagged_orders(spark, sf_dir))
    return kept.select("order_id", F.col(POSITION[2]).alias("row_position"))


@query
def dq_report_orders(spark, sf_dir):
    return op.rejection_counts(_checked_orders(spark, sf_dir), "orders")


@query
def dq_report_ads(spark, sf_dir):
    return op.rejection_counts(_checked_ads(spark, sf_dir), "ads")


@query
def dq_gate(spark, sf_dir):
    threshold = float(PARAMS.dq_rejection_threshold)
    orders = op.quality_summary(_tagged_orders(spark, sf_dir), "orders", threshold)
    ads = op.flag_ads(frames.raw_ads(spark, sf_dir))
    return orders.unionByName(op.quality_summary(ads, "ads", threshold))


@query
def unknown_statuses(spark, sf_dir):
    return op.unknown_statuses(_checked_orders(spark, sf_dir), PARAMS)


@query
def interval_samples(spark, sf_dir):
    return op.interval_samples(_checked_ads(spark, sf_dir))


# --------------------------------------------------------- clean rows and model


@query
def orders_clean(spark, sf_dir):
    return op.orders_clean(_checked_orders(spark, sf_dir), PARAMS)


@query
def ads_clean(spark, sf_dir):
    return op.ads_clean(_checked_ads(spark, sf_dir), PARAMS)


@query
def orders_daily(spark, sf_dir):
    return op.orders_daily(frames.clean_orders(spark, sf_dir, PARAMS))


@query
def ads_daily(spark, sf_dir):
    return op.ads_daily(frames.clean_ads(spark, sf_dir, PARAMS))


@query
def date_spine(spark, sf_dir):
    return op.date_spine(
        frames.clean_orders(spark, sf_dir, PARAMS), frames.clean_ads(spark, sf_dir, PARAMS)
    )


def _model(spark, sf_dir, params: Params = PARAMS) -> DataFrame:
    return plans.daily_model(
        frames.clean_orders(spark, sf_dir, params),
        frames.clean_ads(spark, sf_dir, params),
        params,
        unique_orders=True,  # o_orderkey is the key of its table
    )


@query
def daily_model(spark, sf_dir):
    return _model(spark, sf_dir)


@query
def daily_model_cogs25(spark, sf_dir):
    return _model(spark, sf_dir, Params(cogs_percentage=Decimal("0.25")))


def _write_exports(spark, sf_dir) -> tuple[str, str]:
    """Both raw frames as CSV folders, under headers that need mapping."""
    paths = []
    for label, raw, headers in (
        ("orders-csv", frames.raw_orders(spark, sf_dir), ORDER_HEADERS),
        ("ads-csv", frames.raw_ads(spark, sf_dir), AD_HEADERS),
    ):
        path = scratch_path(spark, label)
        _write_csv(raw, headers, path)
        paths.append(path)
    return paths[0], paths[1]


def _write_csv(raw: DataFrame, headers: tuple[str, ...], path: str) -> None:
    raw.drop(*POSITION).toDF(*headers).write.options(
        header=True,
        escape='"',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    ).csv(path)


@query
def end_to_end_model(spark, sf_dir):
    orders_csv, ads_csv = _write_exports(spark, sf_dir)
    store = TableStore(spark, root=scratch_path(spark, "run"))
    lenient = Params(dq_rejection_threshold=1)
    return plans.run(spark, orders_csv, ads_csv, store, lenient).model


# -------------------------------------------------------------------- reporting


def _stored_model(spark, sf_dir) -> TableStore:
    store = TableStore(spark, root=scratch_path(spark, "model"))
    store.write(_model(spark, sf_dir), T_MODEL)
    return store


@query
def model_date_range(spark, sf_dir):
    return plans.load_model(_stored_model(spark, sf_dir), *RANGE)


@query
def model_bounds(spark, sf_dir):
    model = _stored_model(spark, sf_dir).read(T_MODEL)
    return op.date_bounds(model)


@query
def run_summary(spark, sf_dir):
    return plans.run_summary(_model(spark, sf_dir))


@query
def period_kpis(spark, sf_dir):
    return plans.period_kpis(_model(spark, sf_dir), PARAMS)


@query
def period_kpis_range(spark, sf_dir):
    return plans.period_kpis(plans.load_model(_stored_model(spark, sf_dir), *RANGE), PARAMS)


@query
def roas_bands(spark, sf_dir):
    banded = plans.with_roas_bands(_model(spark, sf_dir), PARAMS)
    return banded.select("calendar_date", "roas", "roas_band", "roas_label")


# ------------------------------------------------------------- sources and sinks


@query
def header_mapping(spark, sf_dir):
    raw = frames.raw_orders(spark, sf_dir)
    exported = raw.select(
        *(F.col(f.name).alias(h) for f, h in zip(ORDER_FIELDS, ORDER_HEADERS, strict=True)),
        F.col(POSITION[2]).alias("Row Position"),
    )
    mapped, match = canonical_columns(exported, ORDER_FIELDS)
    (extra,) = match.unexpected
    return mapped.select(
        F.col(extra).alias("row_position"), "order_id", "financial_status", "shipping_fees"
    )


@query
def csv_roundtrip(spark, sf_dir):
    _, ads_csv = _write_exports(spark, sf_dir)
    rows, _ = read_export(spark, ads_csv, AD_FIELDS)
    return op.ads_clean(op.check_ads(op.flag_ads(rows)), PARAMS)


@query
def csv_export(spark, sf_dir):
    path = scratch_path(spark, "report")
    write_report(_model(spark, sf_dir), path)
    shown = spark.read.csv(path, header=True)
    names = {header: name for name, header in EXPORT_HEADERS.items()}
    back = shown.toDF(*(names[h] for h in shown.columns))
    kinds = {"calendar_date": "date", "reporting_currency": "string"}
    kinds |= dict.fromkeys(("orders", "impressions", "link_clicks"), "bigint")
    return back.select(*(F.col(c).cast(kinds.get(c, "double")).alias(c) for c in back.columns))


@query
def table_roundtrip(spark, sf_dir):
    store = TableStore(spark, root=scratch_path(spark, "clean"))
    store.write(frames.clean_ads(spark, sf_dir, PARAMS), "ads_clean")
    return store.read("ads_clean")


# ------------------------------------------- files, stores and runs as a user meets them


@query
def csv_orders_roundtrip(spark, sf_dir):
    orders_csv, _ = _write_exports(spark, sf_dir)
    rows, _ = read_export(spark, orders_csv, ORDER_FIELDS)
    staged = settle(op.flag_orders(rows), "orders")
    tagged = op.flag_repeats(staged, settle(op.repeated_keys(staged), "repeats"))
    return op.orders_clean(op.check_orders(tagged, PARAMS), PARAMS)


@query
def csv_torn_cells(spark, sf_dir):
    """Ads in a folder in which some files have line breaks in campaign names, as quoted cells."""
    raw = frames.raw_ads(spark, sf_dir).drop(*POSITION)
    torn = F.col("__e") % 10 == 0
    keyed = raw.withColumn("__e", F.xxhash64(*raw.columns))
    path = scratch_path(spark, "torn-csv")
    for part, breaks in ((keyed.where(~torn), False), (keyed.where(torn), True)):
        cells = part.drop("__e")
        if breaks:
            name = F.replace(F.col("campaign_name"), F.lit("\t"), F.lit("\n\t"))
            cells = cells.withColumn("campaign_name", name)
        cells.toDF(*AD_HEADERS).write.mode("append").options(
            header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
        ).csv(path)
    rows, _ = read_export(spark, path, AD_FIELDS)
    return op.ads_clean(op.check_ads(op.flag_ads(rows)), PARAMS)


@query
def csv_export_text(spark, sf_dir):
    path = scratch_path(spark, "report")
    write_report(_model(spark, sf_dir), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


@query
def table_overwrite(spark, sf_dir):
    """A table that is replaced by part of itself, as two other tables of its version stay."""
    store = TableStore(spark, root=scratch_path(spark, "clean"))
    with store.begin() as version:
        version.write(frames.clean_ads(spark, sf_dir, PARAMS), "ads_clean")
        version.write(frames.clean_orders(spark, sf_dir, PARAMS), "orders_clean")
    ads = store.read("ads_clean")
    store.write(ads.where("link_clicks = 1"), "ads_clean")
    n_orders = F.lit(store.read("orders_clean").count()).alias("n_orders")
    return store.read("ads_clean").select(n_orders, "calendar_date", "spend_amount")


@query
def model_exists(spark, sf_dir):
    store = TableStore(spark, root=scratch_path(spark, "model"))
    before = plans.model_exists(store)
    store.write(_model(spark, sf_dir), T_MODEL)
    there = F.lit(plans.model_exists(store))
    return store.read(T_MODEL).agg(
        F.lit(before).alias("before"), F.max(there).alias("after"), F.count("*").alias("n_days")
    )


@query
def run_report(spark, sf_dir):
    """What a whole run says about the rows of both exports, by source and reason."""
    orders_csv, ads_csv = _write_exports(spark, sf_dir)
    store = TableStore(spark, root=scratch_path(spark, "run"))
    result = plans.run(spark, orders_csv, ads_csv, store, Params(dq_rejection_threshold=1))
    rows = [
        (r.source, reason, n, r.rows_received, r.rows_accepted)
        for r in (result.orders_report, result.ads_report)
        for reason, n in r.reasons.items()
    ]
    return spark.createDataFrame(
        rows, "source string, rejection_reason string, n long, rows_received long, rows_accepted long"
    )


@query
def incremental_model(spark, sf_dir):
    """The model after a first run and an added export, which has the second copies of orders."""
    # Lines are summed and joined once; either export reads the orders that it has any row of.
    units = settle(frames.order_units(spark, sf_dir), "units")
    ads = frames.raw_ads(spark, sf_dir)
    fifth, second = F.col("k") % 5 == 0, F.col("k") % 53 == 0
    k, slot = F.shiftright(F.col(POSITION[2]), 1), F.col(POSITION[2]) % 2
    later = (slot == 1) | (k % 5 == 0)
    store = TableStore(spark, root=scratch_path(spark, "run"))
    for part, rows, more in (
        (units.where(~fifth), ~later, F.col(POSITION[2]) % 3 > 0),
        (units.where(fifth | second), later, F.col(POSITION[2]) % 3 == 0),
    ):
        some = frames.raw_orders(spark, sf_dir, part).where(rows)
        paths = [scratch_path(spark, label) for label in ("orders-csv", "ads-csv")]
        for frame, headers, path in (
            (some, ORDER_HEADERS, paths[0]),
            (ads.where(more), AD_HEADERS, paths[1]),
        ):
            _write_csv(frame, headers, path)
        model = plans.add_exports(spark, *paths, store, Params(dq_rejection_threshold=1)).model
    return model


@query
def period_kpis_hours(spark, sf_dir):
    return plans.period_kpis(_model(spark, sf_dir), Params(admin_hours_per_week=Decimal("7.5")))


@query
def orders_clean_usd(spark, sf_dir):
    return op.orders_clean(_checked_orders(spark, sf_dir), Params(orders_currency="USD"))


@query
def orders_daily_shared_ids(spark, sf_dir):
    """Orders of which several share an id, also across days and currencies."""
    orders = frames.clean_orders(spark, sf_dir, PARAMS)
    k = F.col("order_id").cast("long")
    currency = F.when(k % 5 == 0, "USD").otherwise("ETB")
    return op.orders_daily(
        orders.withColumns({"order_id": (k % 997).cast("string"), "reporting_currency": currency})
    )
