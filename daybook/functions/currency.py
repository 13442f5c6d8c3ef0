"""Currency conversion at a configured rate."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.params import Params


def to_reporting_currency(amount: Column, currency: str, params: Params) -> Column:
    """Convert an amount; the rate is looked up now, before any job starts."""
    if currency.upper() == params.reporting_currency:
        return amount
    return amount * F.lit(float(params.rate_from(currency)))
