"""Aggregates and ratios shared by the daily model and the period reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from daybook.params import Params

# ROAS bands and the labels shown for them.
BAND_LABELS = {"green": "+ On target", "amber": "~ Watch", "red": "- Below"}
NEUTRAL_BAND = "neutral"

_EXACT_TYPE = "decimal(26,8)"


# Binary places at which what eight decimals do not hold is split: a small rest, below 2**-27,
# and amounts too large for the type, of 2**59 and more, up to where an amount is beyond both.
_SMALL, _SMALLER = 60, 92
_LARGE, _LARGER = 7, 53
_BEYOND = float(2**99)
_PARTS = ("exact", "small", "smaller", "large", "larger", "beyond")


def _split(amount: Column) -> tuple[Column, ...]:
    """An amount in parts whose sums are exact, in the order of ``_PARTS``."""

    def units(x: Column, place: int) -> Column:
        return F.rint(x * F.lit(2.0**-place))

    exact = amount.try_cast(_EXACT_TYPE)
    fits = F.abs(amount) < _BEYOND
    rest = F.when(exact.isNotNull(), amount - exact.cast("double"))
    whole = F.when(exact.isNull() & fits, amount)
    small, larger = units(rest, -_SMALL), units(whole, _LARGER)
    smaller = units(rest, -_SMALLER) - small * F.lit(2.0 ** (_SMALLER - _SMALL))
    large = units(whole, _LARGE) - larger * F.lit(2.0 ** (_LARGER - _LARGE))
    counts = [c.cast("bigint") for c in (small, smaller, large, larger)]
    return exact, *counts, F.when(exact.isNull() & ~fits, amount)


def _joined(parts: list[Column]) -> Column:
    exact, small, smaller, large, larger, beyond = (F.coalesce(p, F.lit(0)).cast("double") for p in parts)
    total = (
        exact
        + (larger * F.lit(2.0**_LARGER) + large * F.lit(2.0**_LARGE))
        + (small * F.lit(2.0**-_SMALL) + smaller * F.lit(2.0**-_SMALLER))
        + beyond
    )
    return F.when(F.coalesce(parts[0].cast("double"), parts[4].cast("double"), parts[5]).isNotNull(), total)


def sum_parts(amount: Column, name: str) -> list[Column]:
    """The sums that make up ``exact_sum``, each under a name of its own.

    For totals of totals: ``add_parts`` adds such sums up and ``parts_total`` makes the double.
    """
    return [F.sum(p).alias(f"__{name}_{kind}") for kind, p in zip(_PARTS, _split(amount), strict=True)]


def add_parts(name: str, where: Column | None = None) -> list[Column]:
    """Sums of stored parts, of those rows for which ``where`` holds."""
    columns = [f"__{name}_{kind}" for kind in _PARTS]
    return [F.sum(c if where is None else F.when(where, F.col(c))).alias(c) for c in columns]


def parts_total(name: str) -> Column:
    """The sum whose parts are stored."""
    return _joined([F.col(f"__{name}_{kind}") for kind in _PARTS])


def exact_sum(amount: Column) -> Column:
    """Sum of doubles with the same bits whatever the partitions and the order of tasks.

    Floating-point addition is not associative, so a plain distributed sum can
    differ in its last digits between two runs over the same rows. Here each amount is
    split into a decimal of eight places and, for what that does not hold, whole numbers of
    fixed binary units, all of which add up exactly; only the totals meet as doubles.
    The rest below eight decimals counts to the nearest 2**-92 (about 2e-28). Amounts of 2**99
    (about 6e29) and more, infinite ones and NaN are added as doubles.
    """
    return _joined([F.sum(p) for p in _split(amount)])


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient where the denominator is positive, else null (never zero or infinity)."""
    return F.when(denominator > 0, numerator / denominator)


def round_half_even(value: Column, places: int) -> Column:
    """Scale, round halves to even, scale back, all in binary floating point.

    ``round`` and ``bround`` work on the printed decimal instead and differ from
    this where the printed value ends in a half but the stored one does not.
    """
    scale = F.lit(float(10**places))
    return F.rint(value * scale) / scale


def round_tenths(value: Column) -> Column:
    """Round to one decimal by the stored binary value, halves to even.

    Ten times the value is rarely exact, so a product that looks like a half may stand for
    slightly more or less. Eight and two times the value are exact; the error of their sum
    decides.
    """
    eight, two = value * 8, value * 2
    ten = eight + two
    taken = ten - eight
    error = (eight - (ten - taken)) + (two - taken)
    half = ten - F.floor(ten) == 0.5
    units = (
        F.when(half & (error > 0), F.ceil(ten).cast("double"))
        .when(half & (error < 0), F.floor(ten).cast("double"))
        .otherwise(F.rint(ten))
    )
    return units / 10


def roas_band(roas: Column, params: Params) -> Column:
    """Band of a return on ad spend; a threshold belongs to the better band."""
    return (
        F.when(roas.isNull() | F.isnan(roas), NEUTRAL_BAND)
        .when(roas >= float(params.roas_green_threshold), "green")
        .when(roas >= float(params.roas_amber_threshold), "amber")
        .otherwise("red")
    )


def roas_band_label(band: Column) -> Column:
    """Display label of a band; neutral has none."""
    label = F.lit(None).cast("string")
    for name, text in BAND_LABELS.items():
        label = F.when(band == name, text).otherwise(label)
    return label
