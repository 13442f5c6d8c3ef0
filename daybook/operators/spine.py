"""The gap-free list of dates both sources together span."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def date_bounds(*dailies: DataFrame) -> DataFrame:
    """One row ``(min_d, max_d)`` over the dates of several daily frames."""
    ends = [
        df.agg(F.min("calendar_date").alias("min_d"), F.max("calendar_date").alias("max_d"))
        for df in dailies
    ]
    both = ends[0]
    for more in ends[1:]:
        both = both.unionByName(more)
    return both.agg(F.min("min_d").alias("min_d"), F.max("max_d").alias("max_d"))


def date_spine(*dailies: DataFrame) -> DataFrame:
    """Every date from the first to the last, ascending; empty if there is none."""
    days = F.sequence("min_d", "max_d", F.expr("interval 1 day"))
    return (
        date_bounds(*dailies).select(F.explode(days).alias("calendar_date")).orderBy("calendar_date")
    )
