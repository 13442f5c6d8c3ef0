"""Ad-spend rows: from text to typed campaign days in the reporting currency."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from daybook.contracts import (
    AD_FIELDS,
    AD_REASONS,
    INVALID_AD_DATE,
    INVALID_SPEND,
    MULTI_DAY,
    POSITION,
    REASON,
)
from daybook.functions import (
    campaign_label,
    parse_counter,
    parse_date,
    parse_money,
    to_reporting_currency,
)
from daybook.operators.quality import accepted, first_reason, flag_missing, with_reason
from daybook.params import Params


def flag_ads(rows: DataFrame) -> DataFrame:
    """Structural flags of ad rows. They have no key, so nothing is deduplicated."""
    return flag_missing(rows, [f.name for f in AD_FIELDS if f.required])


def check_ads(flagged: DataFrame, observation: Observation | str = "ads_checked") -> DataFrame:
    """Parse the ad columns and flag rows that do not describe one day's spend.

    Row counts per reason are collected in ``observation``.
    """
    parsed = flagged.withColumns(
        {
            "__start": parse_date(F.col("reporting_start")),
            "__end": parse_date(F.col("reporting_end")),
            "__spend_amount": parse_money(F.col("spend_amount")),
        }
    )
    return with_reason(
        parsed,
        observation,
        AD_REASONS,
        first_reason(
            (INVALID_AD_DATE, F.col("__start").isNull() | F.col("__end").isNull()),
            (MULTI_DAY, F.col("__start") != F.col("__end")),
            (INVALID_SPEND, F.col("__spend_amount").isNull()),
        ),
    )


def ads_clean(checked: DataFrame, params: Params) -> DataFrame:
    """Accepted ad rows with their final columns. Dates are taken as they are."""
    spend = to_reporting_currency(F.col("__spend_amount"), params.ads_currency, params)
    return accepted(checked).select(
        F.col("__start").alias("calendar_date"),
        campaign_label(F.col("campaign_name")).alias("campaign_name"),
        spend.alias("spend_amount"),
        parse_counter(F.col("impressions")).alias("impressions"),
        parse_counter(F.col("link_clicks")).alias("link_clicks"),
        F.lit(params.reporting_currency).alias("reporting_currency"),
    )


def interval_samples(
    checked: DataFrame, *, n: int = 3, position: Sequence[str] = POSITION
) -> DataFrame:
    """Start dates of the first few rows rejected as intervals, in input order."""
    return (
        checked.where(F.col(REASON) == MULTI_DAY)
        .orderBy(*position)
        .limit(n)
        .select(F.col("__start").alias("reporting_start"))
    )
