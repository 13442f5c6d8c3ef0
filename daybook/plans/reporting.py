"""Reading the stored model: date ranges, period KPIs, run totals, ROAS bands."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.contracts import DAILY_MODEL, T_MODEL
from daybook.functions.measures import (
    exact_sum,
    guarded_ratio,
    roas_band,
    roas_band_label,
    round_tenths,
)
from daybook.params import Params
from daybook.sources.tables import TableStore


def load_model(
    store: TableStore, date_from: date | None = None, date_to: date | None = None
) -> DataFrame:
    """The model between two inclusive dates, each optional, by date."""
    model = store.read(T_MODEL)
    if date_from is not None:
        model = model.where(F.col("calendar_date") >= F.lit(date_from))
    if date_to is not None:
        model = model.where(F.col("calendar_date") <= F.lit(date_to))
    return model.select(*(c for c in DAILY_MODEL.fieldNames() if c in model.columns)).orderBy(
        "calendar_date"
    )


def model_exists(store: TableStore) -> bool:
    return store.exists(T_MODEL)


def model_date_range(store: TableStore) -> tuple[date, date] | None:
    """First and last date of the model; None if it is absent or empty."""
    if not model_exists(store):
        return None
    row = store.read(T_MODEL).agg(F.min("calendar_date"), F.max("calendar_date")).head()
    return None if row[0] is None else (row[0], row[1])


def _total(name: str) -> Column:
    return F.coalesce(exact_sum(F.col(name)), F.lit(0.0))


def run_summary(model: DataFrame) -> DataFrame:
    """One row of totals over the whole model; an empty model gives zeros and ``?``."""
    return model.agg(
        F.min("calendar_date").alias("dates_min"),
        F.max("calendar_date").alias("dates_max"),
        _total("net_revenue").alias("total_net_revenue"),
        _total("ad_spend").alias("total_ad_spend"),
        _total("contribution_margin").alias("total_contribution_margin"),
        F.coalesce(F.max("reporting_currency"), F.lit("?")).alias("currency"),
    )


def period_kpis(model: DataFrame, params: Params) -> DataFrame:
    """One row of KPIs over the dates of ``model``: ratios of sums, not mean ratios."""
    days = F.datediff(F.max("calendar_date"), F.min("calendar_date")) + 1
    totals = model.agg(
        _total("net_revenue").alias("total_net_revenue"),
        _total("ad_spend").alias("total_ad_spend"),
        _total("contribution_margin").alias("total_contribution_margin"),
        F.coalesce(F.sum("orders"), F.lit(0)).alias("total_orders"),
        F.coalesce(days, F.lit(0)).alias("__days"),
    )
    net, spend, margin = (
        F.col(f"total_{name}") for name in ("net_revenue", "ad_spend", "contribution_margin")
    )
    hours = F.lit(float(params.admin_hours_per_week)) * (F.col("__days") / F.lit(7.0))
    return totals.select(
        net,
        spend,
        margin,
        guarded_ratio(margin, net).alias("profit_margin"),
        guarded_ratio(net, spend).alias("blended_roas"),
        guarded_ratio(spend, net).alias("meta_spend_ratio"),
        "total_orders",
        round_tenths(hours).alias("administrative_hours_saved"),
        F.lit(params.reporting_currency).alias("reporting_currency"),
    )


def with_roas_bands(frame: DataFrame, params: Params, roas: str = "roas") -> DataFrame:
    """Add the band of a ROAS column and the label shown for it."""
    return frame.withColumn("roas_band", roas_band(F.col(roas), params)).withColumn(
        "roas_label", roas_band_label(F.col("roas_band"))
    )
