"""The daily model as a CSV file for people."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.contracts import (
    DAILY_MODEL,
    EXPORT_HEADERS,
    EXPORT_RATIOS,
    MONEY_DECIMALS,
    RATIO_DECIMALS,
)
from daybook.functions.measures import round_half_even


def report_frame(model: DataFrame) -> DataFrame:
    """Model columns as display text under display headers, in the fixed order.

    Dates are ISO, money has at most two decimals and ratios four; nulls stay
    null. Columns the model lacks are left out, other columns too. A model
    without columns gives the headers alone.
    """
    types = {f.name: f.dataType for f in model.schema.fields}
    if not any(name in types for name in EXPORT_HEADERS):
        model = model.sparkSession.createDataFrame([], DAILY_MODEL)
        types = {f.name: f.dataType for f in DAILY_MODEL.fields}
    return model.select(
        *(
            _as_text(name, types[name]).alias(header)
            for name, header in EXPORT_HEADERS.items()
            if name in types
        )
    )


def _as_text(name: str, kind: T.DataType) -> Column:
    value = F.col(name)
    if name == "calendar_date":
        return F.date_format(value, "yyyy-MM-dd")
    if not isinstance(kind, T.FractionalType):
        return value.cast("string")
    places = RATIO_DECIMALS if name in EXPORT_RATIOS else MONEY_DECIMALS
    # A double prints as 1.0E7 from ten million on; a decimal never does.
    digits = round_half_even(value.cast("double"), places).try_cast(f"decimal(38,{places})")
    shown = F.regexp_replace(digits.cast("string"), r"(\.[0-9]+?)0+$", "$1")
    return F.coalesce(shown, value.cast("string"))  # too large for a decimal: its own text


def write_report(model: DataFrame, path: str) -> None:
    """Write the report as one CSV file with a header into folder ``path``.

    One row per calendar day and a bounded range of days make this small, which
    is why one file is safe.
    """
    dated = "calendar_date" in model.columns
    rows = model.repartition(1)
    report_frame(rows.sortWithinPartitions("calendar_date") if dated else rows).write.mode(
        "overwrite"
    ).csv(path, header=True, nullValue="")
