"""Timestamps and dates written as text.

Which layouts are allowed is decided by patterns; the value itself comes from
one ``try_cast``, which needs no formatter and raises nothing. Chaining
``try_to_timestamp`` per layout would build one exception per failed attempt
and row. Text without a zone is UTC, which holds because the session zone is
required to be UTC (see ``daybook.session``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.functions.text import stripped

# The allowed layouts. A "T" needs a zone; a space does not.
# The usual ones a cast takes as they stand.
USUAL_LAYOUT = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}"
    r"(?:[T ][0-9]{2}:[0-9]{2}:[0-5][0-9](?:Z|[+-](?:0[0-9]|1[0-7]):?[0-9]{2})"
    r"| [0-9]{2}:[0-9]{2}(?::[0-5][0-9](?: UTC)?)?)?\z"
)
_DAY = r"([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})"
_MINUTE = r"([0-9]{1,2}:[0-9]{1,2})"
_SECOND = r"([0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2})"
_OFFSET = r"([+-](?:[0-9]{4}|[0-9]{1,2}(?::[0-9]{1,2})?))"
_WITH_T = rf"[Tt]{_SECOND}(?:[Zz]|{_OFFSET})"
_WITH_SPACE = rf"\s+(?:{_SECOND}(?:Z|{_OFFSET})?|{_MINUTE})"
# Any other text matches as a whole, without groups, and so turns into a blank.
ANY_LAYOUT = rf"(?Us)^(?:{_DAY}(?:{_WITH_T}|{_WITH_SPACE})?(?:\s*UTC\s*)?|.*)\z"
CANONICAL = "$1 $2$4$6$3$5"
LEAP_SECOND = r"(:[0-9]{1,2}):6([01])"
ODD_OFFSET = (
    r"^(.*[0-9]:[0-9]{1,2})([+-])"
    r"(?:(?=1[89]|2[0-3]|[01][0-9]:[0-9]{2}:)([01][0-9]|2[0-3])):?([0-5][0-9])(?::([0-5][0-9]))?\s*\z"
)
DATE_LAYOUT = r"^[0-9]{4}([-/])[0-9]{1,2}\1[0-9]{1,2}\z"

# Instants a 64-bit nanosecond clock can hold. The surveyed system rejects
# later and earlier ones; this is its range, not a limit on the work done here.
EARLIEST_INSTANT = "1677-09-21 00:12:44"
LATEST_INSTANT = "2262-04-11 23:47:16"
EARLIEST_DATE = "1677-09-22"
LATEST_DATE = "2262-04-11"


def parse_timestamp(text: Column) -> Column:
    """Timestamp text as an instant, or null."""

    def rearranged(body: Column) -> Column:
        return F.regexp_replace(body, ANY_LAYOUT, CANONICAL).try_cast("timestamp")

    # A second of 60 or 61 reads as 59; what that lacks is added back.
    at_59 = rearranged(F.regexp_replace(text, LEAP_SECOND, "$1:59"))
    lacking = F.regexp_extract(text, LEAP_SECOND, 2).try_cast("int") + 1
    # Offsets that no cast takes, up to a day: the clock time is read as UTC and shifted.
    clock = rearranged(F.regexp_replace(text, ODD_OFFSET, "$1Z"))
    sign = F.when(F.regexp_extract(text, ODD_OFFSET, 2) == "-", 1).otherwise(-1)
    unit = [F.coalesce(F.regexp_extract(text, ODD_OFFSET, k).try_cast("int"), F.lit(0)) for k in (3, 4, 5)]
    shifted = clock + F.make_dt_interval(F.lit(0), sign * unit[0], sign * unit[1], sign * unit[2])
    instant = (
        F.when(text.rlike(USUAL_LAYOUT), text.try_cast("timestamp"))
        .when(text.rlike(LEAP_SECOND), at_59 + F.make_dt_interval(secs=lacking))
        .when(text.rlike(ODD_OFFSET), shifted)
        .otherwise(rearranged(text))
    )
    in_range = instant.between(
        F.lit(EARLIEST_INSTANT).cast("timestamp"), F.lit(LATEST_INSTANT).cast("timestamp")
    )
    return F.when(in_range, instant)


def parse_date(text: Column) -> Column:
    """Calendar date text, year first with dashes or slashes, or null."""
    body = F.regexp_extract(stripped(text), DATE_LAYOUT, 0)
    day = F.replace(body, F.lit("/"), F.lit("-")).try_cast("date")
    in_range = day.between(F.lit(EARLIEST_DATE).cast("date"), F.lit(LATEST_DATE).cast("date"))
    return F.when(in_range, day)


def reporting_date(instant: Column, timezone: str) -> Column:
    """The business date an instant falls on in the reporting zone."""
    return F.to_date(F.from_utc_timestamp(instant, timezone))
