"""Order rows: from text to typed, recognised revenue in the reporting currency."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.contracts import (
    EXCLUDED_STATUS,
    INVALID_CREATED_AT,
    INVALID_MONEY,
    ORDER_FIELDS,
    ORDER_MONEY,
    ORDER_REASONS,
    REASON,
)
from daybook.functions import (
    parse_money,
    parse_timestamp,
    reporting_date,
    status_key,
    to_reporting_currency,
)
from daybook.operators.quality import accepted, first_reason, flag_missing, with_reason
from daybook.params import Params
from daybook.session import require_utc

MUST_PARSE = ("gross_amount", "net_amount")


def flag_orders(rows: DataFrame) -> DataFrame:
    """Structural flags of order rows under canonical names (repeats come after)."""
    return flag_missing(rows, [f.name for f in ORDER_FIELDS if f.required])


def check_orders(
    flagged: DataFrame, params: Params, observation: Observation | str = "orders_checked"
) -> DataFrame:
    """Parse the order columns and flag rows that cannot count as revenue.

    Raw columns stay; parsed ones are added under a ``__`` prefix. Row counts
    per reason are collected in ``observation`` when the result is written.
    """
    require_utc(flagged.sparkSession)
    raw_moment = F.col("created_at")
    zoned = isinstance(flagged.schema["created_at"].dataType, T.TimestampType)
    parsed = flagged.withColumns(
        {
            "__created_at_utc": raw_moment if zoned else parse_timestamp(raw_moment),
            "__financial_status": status_key(F.col("financial_status")),
            **{f"__{name}": parse_money(F.col(name)) for name in ORDER_MONEY},
        }
    )
    unusable_money = F.lit(False)
    for name in MUST_PARSE:
        unusable_money |= F.col(f"__{name}").isNull()
    recognised = F.col("__financial_status").isin(sorted(params.revenue_statuses))
    return with_reason(
        parsed,
        observation,
        ORDER_REASONS,
        first_reason(
            (INVALID_CREATED_AT, F.col("__created_at_utc").isNull()),
            (INVALID_MONEY, unusable_money),
            (EXCLUDED_STATUS, ~F.coalesce(recognised, F.lit(False))),
        ),
    )


def orders_clean(checked: DataFrame, params: Params) -> DataFrame:
    """Accepted orders with their final columns, one row per order."""

    def money(name: str):
        amount = F.col(f"__{name}")
        if name not in MUST_PARSE:
            amount = F.coalesce(amount, F.lit(0.0))
        return to_reporting_currency(amount, params.orders_currency, params).alias(name)

    return accepted(checked).select(
        "order_id",
        reporting_date(F.col("__created_at_utc"), params.reporting_timezone).alias("calendar_date"),
        F.col("__created_at_utc").alias("created_at_utc"),
        F.col("__financial_status").alias("financial_status"),
        *map(money, ORDER_MONEY),
        F.lit(params.reporting_currency).alias("reporting_currency"),
    )


def unknown_statuses(checked: DataFrame, params: Params) -> DataFrame:
    """Statuses no parameter mentions, with row counts, in alphabetical order."""
    status = F.col("__financial_status")
    return (
        checked.where(F.col(REASON) == EXCLUDED_STATUS)
        .where(~status.isin(sorted(params.known_statuses)))
        .groupBy(status.alias("financial_status"))
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("financial_status")
    )
