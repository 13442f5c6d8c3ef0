"""Daily aggregates of the two clean tables.

``max`` of a text column would make Spark sort every row before aggregating, as
text does not fit a hash-aggregation buffer. The currency is therefore part of
the first grouping key, and the maximum is taken over the handful of rows per
day that leaves. What is shuffled is partial sums: at most one row per day,
currency and task, however many orders fall on one day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.functions.measures import add_parts, parts_total, sum_parts

_ORDER_SUMS = {
    "gross_revenue": "gross_amount",
    "discount_amount": "discount_amount",
    "net_revenue": "net_amount",
    "taxes": "taxes",
    "shipping_fees": "shipping_fees",
}


def orders_sums(orders: DataFrame, *, unique_orders: bool = False) -> DataFrame:
    """Partial sums of orders per business date and currency; they can be added up further.

    ``orders`` counts distinct order ids. The rows are read once, for two grouping sets:
    the sums per currency, and the ids of a day, which have to be shuffled to be counted exactly.
    A frame known to hold each id once, as ingestion with deduplication leaves it, can
    say so with ``unique_orders`` and spares that shuffle.
    """
    sums = [part for name, src in _ORDER_SUMS.items() for part in sum_parts(F.col(src), name)]
    if unique_orders:
        return orders.groupBy("calendar_date", "reporting_currency").agg(
            *sums, F.count("order_id").alias("orders")
        )
    sets = [["calendar_date", "reporting_currency"], ["calendar_date", "order_id"]]
    # "reporting_currency" is null in the rows of an id, so these meet in one group a day.
    by_currency = F.col("__without_id") == 1
    return (
        orders.groupingSets(sets, "calendar_date", "reporting_currency", "order_id")
        .agg(*sums, F.grouping("order_id").alias("__without_id"))
        .groupBy("calendar_date", "reporting_currency")
        .agg(
            *(part for name in _ORDER_SUMS for part in add_parts(name, by_currency)),
            F.count(F.when(~by_currency, F.col("order_id"))).alias("orders"),
        )
    )


def merged_order_sums(sums: DataFrame) -> DataFrame:
    """The partial sums of several sets of orders, none of whose ids are in two of them, as one."""
    return sums.groupBy("calendar_date", "reporting_currency").agg(
        *(part for name in _ORDER_SUMS for part in add_parts(name)), F.sum("orders").alias("orders")
    )


def orders_from_sums(sums: DataFrame) -> DataFrame:
    """Daily revenue columns from the partial sums of one or more sets of orders."""
    daily = sums.groupBy("calendar_date").agg(
        *(part for name in _ORDER_SUMS for part in add_parts(name)),
        F.sum("orders").alias("orders"),
        F.max("reporting_currency").alias("reporting_currency"),
    )
    daily = daily.withColumns({name: parts_total(name) for name in _ORDER_SUMS})
    average = F.when(F.col("orders") > 0, F.col("discount_amount") / F.col("orders"))
    return daily.select(
        "calendar_date",
        *_ORDER_SUMS,
        "orders",
        average.alias("avg_discount_per_order"),
        "reporting_currency",
    )


def orders_daily(orders: DataFrame, *, unique_orders: bool = False) -> DataFrame:
    """Revenue columns, order count and average discount per business date."""
    return orders_from_sums(orders_sums(orders, unique_orders=unique_orders))


def ads_sums(ads: DataFrame) -> DataFrame:
    """Partial sums of ad rows per date and currency; they can be added up further."""
    return ads.groupBy("calendar_date", "reporting_currency").agg(
        *sum_parts(F.col("spend_amount"), "ad_spend"),
        F.sum("impressions").alias("impressions"),
        F.sum("link_clicks").alias("link_clicks"),
        F.count(F.lit(1)).alias("meta_row_count"),
    )


def merged_ad_sums(sums: DataFrame) -> DataFrame:
    """The partial sums of several sets of ad rows as one."""
    return sums.groupBy("calendar_date", "reporting_currency").agg(
        *add_parts("ad_spend"),
        *(F.sum(c).alias(c) for c in ("impressions", "link_clicks", "meta_row_count")),
    )


def ads_from_sums(sums: DataFrame) -> DataFrame:
    """Daily spend, impressions, clicks and row count; unknown counts stay null."""
    daily = sums.groupBy("calendar_date").agg(
        *add_parts("ad_spend"),
        F.sum("impressions").alias("impressions"),
        F.sum("link_clicks").alias("link_clicks"),
        F.sum("meta_row_count").alias("meta_row_count"),
        F.max("reporting_currency").alias("reporting_currency"),
    )
    return daily.select(
        "calendar_date",
        parts_total("ad_spend").alias("ad_spend"),
        "impressions",
        "link_clicks",
        "meta_row_count",
        "reporting_currency",
    )


def ads_daily(ads: DataFrame) -> DataFrame:
    """Spend, impressions, clicks and row count per date."""
    return ads_from_sums(ads_sums(ads))
