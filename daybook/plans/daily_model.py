"""The daily financial model: both daily aggregates on the date spine, plus KPIs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.contracts import DAILY_MODEL
from daybook.functions.measures import guarded_ratio
from daybook.operators.daily import ads_daily, orders_daily
from daybook.operators.spine import date_spine
from daybook.params import Params
from daybook.session import settle

_ZERO_WHEN_ABSENT = (
    "gross_revenue",
    "discount_amount",
    "net_revenue",
    "taxes",
    "shipping_fees",
    "ad_spend",
)


def model_from_daily(orders_by_day: DataFrame, ads_by_day: DataFrame, params: Params) -> DataFrame:
    """One row per date of the spine. Money and orders default to zero, counts to null.

    Both inputs are read by the spine and by a join, so pass stored frames, not
    ones that would be computed anew for each use. They hold one row per day;
    Spark picks the join strategy from their stored size.
    """
    orders_side = orders_by_day.withColumnRenamed("reporting_currency", "__orders_currency")
    ads_side = ads_by_day.withColumnRenamed("reporting_currency", "__ads_currency")
    joined = (
        date_spine(orders_by_day, ads_by_day)
        .join(orders_side, "calendar_date", "left")
        .join(ads_side, "calendar_date", "left")
        .withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in _ZERO_WHEN_ABSENT})
        .withColumns(
            {
                "orders": F.coalesce(F.col("orders"), F.lit(0)),
                "reporting_currency": F.coalesce("__orders_currency", "__ads_currency"),
            }
        )
    )
    return joined.withColumns(_kpis(params)).select(*DAILY_MODEL.fieldNames()).orderBy(
        "calendar_date"
    )


def _kpis(params: Params) -> dict[str, Column]:
    net, spend = F.col("net_revenue"), F.col("ad_spend")
    cogs = F.col("gross_revenue") * F.lit(float(params.cogs_percentage))
    margin = net - spend - cogs
    return {
        "cogs_estimate": cogs,
        "contribution_margin": margin,
        "roas": guarded_ratio(net, spend),
        "mer": guarded_ratio(spend, net),
        "profit_margin": guarded_ratio(margin, net),
    }


def daily_model(
    orders: DataFrame, ads: DataFrame, params: Params, *, unique_orders: bool = False
) -> DataFrame:
    """The model from clean orders and clean ads.

    Stores the two daily aggregates on the way, so each clean input is read once.
    """
    return model_from_daily(
        settle(orders_daily(orders, unique_orders=unique_orders), "orders-daily"),
        settle(ads_daily(ads), "ads-daily"),
        params,
    )
