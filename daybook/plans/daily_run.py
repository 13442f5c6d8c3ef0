"""The complete daily run: two CSV exports in, a stored daily model out."""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from daybook.contracts import (
    AD_FIELDS,
    DUPLICATE_ORDER,
    ORDER_FIELDS,
    T_ADS_CLEAN,
    T_ADS_DAILY,
    T_ADS_STAGED,
    T_MODEL,
    T_ADS_SUMS,
    T_ORDER_REPEATS,
    T_ORDERS_CLEAN,
    T_ORDERS_DAILY,
    T_ORDERS_KNOWN,
    T_ORDERS_STAGED,
    T_ORDERS_SUMS,
    T_ROW_SETTINGS,
)
from daybook.errors import ParamError
from daybook.operators.ads import ads_clean, check_ads, flag_ads, interval_samples
from daybook.operators.daily import (
    ads_from_sums,
    ads_sums,
    merged_ad_sums,
    merged_order_sums,
    orders_from_sums,
    orders_sums,
)
from daybook.operators.orders import (
    check_orders,
    flag_orders,
    orders_clean,
    unknown_statuses,
)
from daybook.operators.quality import (
    DQReport,
    dq_report,
    enforce_threshold,
    flag_known,
    flag_repeats,
    known_keys,
    repeated_keys,
)
from daybook.params import Params
from daybook.plans.daily_model import model_from_daily
from daybook.session import require_utc, tuned
from daybook.sources.csv_files import parse_failures, read_export
from daybook.sources.headers import HeaderMatch
from daybook.sources.tables import TableStore, Version


#: tables with the rows of one run as they came in
STAGED = (T_ORDERS_STAGED, T_ORDER_REPEATS, T_ORDERS_KNOWN, T_ADS_STAGED)


@dataclass(frozen=True)
class RunResult:
    """What a run read, kept and wrote.

    The ``checked`` frames are lazy and hold every input row with its reason, so
    rejected rows can be looked at after the run.
    """

    params: Params
    orders_report: DQReport
    ads_report: DQReport
    orders_header: HeaderMatch
    ads_header: HeaderMatch
    checked_orders: DataFrame
    checked_ads: DataFrame
    store: TableStore
    #: the tables this run wrote, the raw rows that the ``checked`` frames read among them
    version: Version

    def discard_staged(self) -> None:
        """Remove this run's raw rows; the ``checked`` frames cannot be read after that.

        Otherwise they go with the run's other tables, when later runs have replaced these.
        """
        for name in STAGED:
            self.version.drop(name)

    @property
    def model(self) -> DataFrame:
        return self.version.read(T_MODEL)

    def unknown_statuses(self) -> DataFrame:
        """Statuses that were excluded only because no parameter knows them."""
        return unknown_statuses(self.checked_orders, self.params)

    def interval_samples(self) -> DataFrame:
        """First start dates of ad rows that span several days."""
        return interval_samples(self.checked_ads)


@dataclass(frozen=True)
class Ingested:
    """One source after structural checks, with every row it came with."""

    rows: DataFrame
    report: DQReport
    header: HeaderMatch


def ingest_orders(
    spark: SparkSession,
    path: str,
    store: TableStore | Version,
    *,
    multi_line: bool | None = None,
    earlier: DataFrame | None = None,
) -> Ingested:
    """Read, map, check required values and mark repeated orders.

    The CSV text is parsed once, into the staged table. Finding repeats and
    cleaning then read only the columns they need from it. ``earlier`` has the staged rows
    of exports that came before; the new ones are stored after them, and orders
    that are among them are repeats.
    """
    raw, header = read_export(spark, path, ORDER_FIELDS, multi_line=multi_line)
    write = store.write if earlier is None else store.append
    with parse_failures(path):
        staged = write(flag_orders(raw), T_ORDERS_STAGED)
    repeats = store.write(repeated_keys(staged), T_ORDER_REPEATS)
    rows = flag_repeats(staged, repeats)

    structural = dq_report(staged, "orders")
    surplus = repeats.agg(F.coalesce(F.sum(F.col("__copies") - 1), F.lit(0))).head()[0]
    if earlier is not None:
        known = store.write(known_keys(staged, earlier), T_ORDERS_KNOWN)
        rows = flag_known(rows, known)
        surplus += known.count()
    reasons = Counter(structural.reasons) + Counter({DUPLICATE_ORDER: surplus})
    return Ingested(rows, DQReport("orders", structural.rows_received, dict(reasons)), header)


def ingest_ads(
    spark: SparkSession,
    path: str,
    store: TableStore | Version,
    *,
    multi_line: bool | None = None,
) -> Ingested:
    """Read, map and check required values."""
    raw, header = read_export(spark, path, AD_FIELDS, multi_line=multi_line)
    with parse_failures(path):
        staged = store.write(flag_ads(raw), T_ADS_STAGED)
    return Ingested(staged, dq_report(staged, "ads"), header)


def run(
    spark: SparkSession,
    orders_path: str,
    ads_path: str,
    store: TableStore,
    params: Params | None = None,
    *,
    multi_line: bool | None = None,
) -> RunResult:
    """Rebuild the model from two exports.

    Raises ``SchemaError`` for unusable files and ``DataQualityError`` when
    ingestion alone rejects too many rows; rows rejected later do not count.
    All tables are published in one step at the end; a run that fails, for whatever
    reason and wherever, leaves the tables before it.
    """
    require_utc(spark)
    params = params or Params()
    params.rate_from(params.orders_currency)  # an unknown currency fails before any job
    params.rate_from(params.ads_currency)

    with tuned(spark):
        return _store_model(spark, orders_path, ads_path, store, params, multi_line, None)


def add_exports(
    spark: SparkSession,
    orders_path: str,
    ads_path: str,
    store: TableStore,
    params: Params | None = None,
    *,
    multi_line: bool | None = None,
) -> RunResult:
    """Add two exports to what the store has, without reading the earlier ones again.

    The tables and the model become what ``run`` makes of all exports together, the earlier ones
    first, to the last bit. Only new rows are parsed and written. Of the rows there are, the order
    ids alone are looked at, to find orders that came in before; the stored partial
    sums of each day take in the new ones. Reports and the threshold are about the new
    rows. Parameters on which clean rows depend must be those of the run before.
    """
    require_utc(spark)
    params = params or Params()
    params.rate_from(params.orders_currency)
    params.rate_from(params.ads_currency)
    before = store.snapshot()
    if before.exists(T_MODEL):
        if not before.together(T_MODEL, T_ORDERS_STAGED, T_ORDERS_SUMS, T_ADS_SUMS, T_ROW_SETTINGS):
            raise ParamError("the raw rows of earlier exports were discarded; run over all exports instead")
        if before.read(T_ROW_SETTINGS).head()[0] != params.row_settings:
            raise ParamError("other rates, statuses, currencies or time zone than before; run over all exports instead")
    with tuned(spark):
        base = before if before.exists(T_MODEL) else None
        return _store_model(spark, orders_path, ads_path, store, params, multi_line, base)


def _store_model(
    spark: SparkSession,
    orders_path: str,
    ads_path: str,
    store: TableStore,
    params: Params,
    multi_line: bool | None,
    before: TableStore | None,
) -> RunResult:
    """Read the exports and store all tables, after those of ``before`` if that is set."""
    with store.begin() as version:  # any error removes what was written and changes nothing
        earlier = None if before is None else before.read(T_ORDERS_STAGED)
        orders = ingest_orders(spark, orders_path, version, multi_line=multi_line, earlier=earlier)
        ads = ingest_ads(spark, ads_path, version, multi_line=multi_line)
        for source in (orders, ads):
            enforce_threshold(source.report, float(params.dq_rejection_threshold))

        orders_seen, ads_seen = Observation(), Observation()
        checked_orders = check_orders(orders.rows, params, orders_seen)
        checked_ads = check_ads(ads.rows, ads_seen)
        write = version.write if before is None else version.append
        clean_orders = write(orders_clean(checked_orders, params), T_ORDERS_CLEAN)
        clean_ads = write(ads_clean(checked_ads, params), T_ADS_CLEAN)

        of_orders, of_ads = orders_sums(clean_orders, unique_orders=True), ads_sums(clean_ads)
        if before is not None:
            of_orders = merged_order_sums(before.read(T_ORDERS_SUMS).unionByName(of_orders))
            of_ads = merged_ad_sums(before.read(T_ADS_SUMS).unionByName(of_ads))
        of_orders, of_ads = version.write(of_orders, T_ORDERS_SUMS), version.write(of_ads, T_ADS_SUMS)
        orders_by_day = version.write(orders_from_sums(of_orders), T_ORDERS_DAILY)
        ads_by_day = version.write(ads_from_sums(of_ads), T_ADS_DAILY)
        version.write(model_from_daily(orders_by_day, ads_by_day, params), T_MODEL)
        settings = spark.createDataFrame([(params.row_settings,)], "settings string")
        version.write(settings.coalesce(1), T_ROW_SETTINGS)
        return RunResult(
            params,
            _final_report(orders, orders_seen, clean_orders, checked_orders),
            _final_report(ads, ads_seen, clean_ads, checked_ads),
            orders.header,
            ads.header,
            checked_orders,
            checked_ads,
            store,
            version,
        )


def _final_report(
    source: Ingested, seen: Observation, clean: DataFrame, checked: DataFrame
) -> DQReport:
    """The report of a whole source, from the counters of the write that just ran.

    The counters sit in the writing stage, where Spark counts each task once.
    Should they not add up to the rows received and kept, count again instead.
    """
    counts = dict(seen.get)
    received = counts.pop("received")
    report = DQReport(source.report.source, received, {k: n for k, n in counts.items() if n})
    adds_up = received == source.report.rows_received and report.rows_accepted == clean.count()
    return report if adds_up else dq_report(checked, source.report.source)
