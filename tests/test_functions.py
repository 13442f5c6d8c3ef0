from __future__ import annotations

import random
from datetime import date, datetime
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from daybook import CurrencyError, Params
from daybook import functions as fn
from daybook.functions import numbers
from daybook.functions.measures import round_tenths
from tests.conftest import evaluate, optimized_plan_of

MONEY = [
    # plain
    ("150.00", 150.0),
    ("150", 150.0),
    ("0", 0.0),
    ("0.00", 0.0),
    ("-150.00", -150.0),
    ("+5", 5.0),
    (".5", 0.5),
    ("5.", 5.0),
    ("1e3", 1000.0),
    # decorated
    ("1,250.50", 1250.5),
    ("1,250,000.00", 1250000.0),
    ("$150.00", 150.0),
    ("$1,250.50", 1250.5),
    ("ETB 150.00", 150.0),
    ("$1,250.00 ETB", 1250.0),
    ("  150.00  ", 150.0),
    ("\t150.00\xa0", 150.0),
    ("1 250.50", 1250.5),
    ("1\xa0250.50", 1250.5),
    ("₦2,000", 2000.0),
    # accounting negatives
    ("(150.00)", -150.0),
    ("(1,250.50)", -1250.5),
    ("($5)", -5.0),
    ("(ETB 5)", -5.0),
    ("( 5 )", -5.0),
    ("(-5)", 5.0),
    ("(+5)", -5.0),
    # kept quirks
    ("1234,567", 1234567.0),
    ("1.234,567", 1.234567),
    (" (5) ", None),
    ("$(5)", None),
    ("(--5)", None),
    ("USD150", None),
    # not money
    ("", None),
    ("   ", None),
    ("abc", None),
    ("N/A", None),
    ("null", None),
    ("1,25", None),
    ("1,2345", None),
    ("12 34", None),
    ("$", None),
    ("ETB", None),
    ("1d", None),
    ("0x10", None),
    ("1_000", None),
    ("NaN", None),
    ("Infinity", None),
    ("inf", None),
    ("1e400", None),
    ("--5", None),
    ("1.5.2", None),
    ("٣", None),
    ("\ue0005", None),
    (" 1 234,567.5\t", 1234567.5),
    ("(1 234.50)", -1234.5),
    (" (5) ", None),
    ("(-5)", 5.0),
    ("1 2345", None),
    ("1 234 56", None),
    (None, None),
]


def test_money(spark):
    got = evaluate(spark, fn.parse_money, [raw for raw, _ in MONEY])
    assert dict(zip([r for r, _ in MONEY], got, strict=True)) == dict(MONEY)


def test_long_digit_runs_do_not_overflow(spark):
    texts = ["9" * 200, "9" * 400, "-" + "1" * 305, "1e99", "1e100", "1.5E+120", "1e308", "1e309"]
    got = evaluate(spark, fn.parse_money, texts)
    assert got[0] == pytest.approx(1e200) and got[2] == pytest.approx(-1.1111111e304)
    assert got[3:7] == [1e99, 1e100, 1.5e120, 1e308]
    assert got[1] is None and got[7] is None


def test_odd_offsets(spark):
    texts = ["2026-09-01T22:30:00+03:00:00", "2026-09-01 22:30:00+1900", "2026-09-01T22:30:00-23:59"]
    got = evaluate(spark, fn.parse_timestamp, [*texts, "2026-09-01T22:30:00+2400"])
    assert got[:3] == [
        datetime(2026, 9, 1, 19, 30), datetime(2026, 9, 1, 3, 30), datetime(2026, 9, 2, 22, 29)
    ]
    assert got[3] is None


def test_sums_keep_tiny_and_huge_amounts(spark):
    tiny = spark.range(1000).select(fn.exact_sum(F.lit(4e-9)).alias("x")).head()[0]
    assert tiny == pytest.approx(4e-6)
    mixed = spark.createDataFrame([(1e200,), (0.1,), (None,)], "v double")
    assert mixed.select(fn.exact_sum(F.col("v"))).head()[0] == 1e200


def test_tenths_round_by_the_stored_value(spark):
    values = [4.35, 0.35, 2.675 * 2, 0.25, 0.75, 2.5, 1.05]
    assert evaluate(spark, round_tenths, values, "double") == [round(v, 1) for v in values]


def utc(*parts) -> datetime:
    return datetime(*parts)


TIMESTAMPS = [
    ("2026-09-01T22:30:00Z", utc(2026, 9, 1, 22, 30)),
    ("2026-09-01 22:30:00 UTC", utc(2026, 9, 1, 22, 30)),
    ("2026-09-01 22:30:00UTC ", utc(2026, 9, 1, 22, 30)),
    ("2026-09-01 UTC", utc(2026, 9, 1)),
    ("2026-09-01 22:30:00+0300", utc(2026, 9, 1, 19, 30)),
    ("2026-09-01 22:30:00+03:00", utc(2026, 9, 1, 19, 30)),
    ("2026-09-01 22:30:00+03", utc(2026, 9, 1, 19, 30)),
    ("2026-09-01T22:30:00-0330", utc(2026, 9, 2, 2)),
    ("2026-09-01 22:30:00Z", utc(2026, 9, 1, 22, 30)),
    ("2026-09-01 22:30:00", utc(2026, 9, 1, 22, 30)),
    ("2026-09-01 22:30", utc(2026, 9, 1, 22, 30)),
    ("2026-09-01", utc(2026, 9, 1)),
    ("2026-9-1 2:3:4", utc(2026, 9, 1, 2, 3, 4)),
    ("2026-9-1 2:3", utc(2026, 9, 1, 2, 3)),
    ("2026-9-1", utc(2026, 9, 1)),
    ("2026-09-01t22:30:00z", utc(2026, 9, 1, 22, 30)),
    ("2026-09-01  22:30:00", utc(2026, 9, 1, 22, 30)),
    ("2026-09-01\t22:30:00", utc(2026, 9, 1, 22, 30)),
    ("2026-09-01 22:30:60", utc(2026, 9, 1, 22, 31)),
    ("2026-09-01 22:30:61", utc(2026, 9, 1, 22, 31, 1)),
    ("1677-09-22", utc(1677, 9, 22)),
    ("2262-04-11 23:47:16", utc(2262, 4, 11, 23, 47, 16)),
    ("2026-09-01T22:30:00", None),
    ("2026-09-01T22:30:00 UTC", None),
    ("2026-09-01T22:30Z", None),
    (" 2026-09-01", None),
    ("2026-09-01 ", None),
    ("2026-09-01 22:30:00 +0300", None),
    ("2026-09-01 22:30:00.5", None),
    ("2026-09-01 22:30:00z", None),
    ("2026-09-01 24:00:00", None),
    ("2026-09-01 22:30:62", None),
    ("2026-02-30", None),
    ("2026-09", None),
    ("12026-09-01", None),
    ("2026-0009-01", None),
    ("1677-09-21", None),
    ("2262-04-12", None),
    ("9999-12-31", None),
    ("not-a-date", None),
    ("", None),
    (None, None),
]


def test_timestamps(spark):
    got = evaluate(spark, fn.parse_timestamp, [raw for raw, _ in TIMESTAMPS])
    assert dict(zip([r for r, _ in TIMESTAMPS], got, strict=True)) == dict(TIMESTAMPS)


DATES = [
    ("2026-09-01", date(2026, 9, 1)),
    ("2026/09/01", date(2026, 9, 1)),
    ("2026-9-1", date(2026, 9, 1)),
    ("  2026-09-01\t", date(2026, 9, 1)),
    ("09/01/2026", None),
    ("2026-09/01", None),
    ("2026-09-01 00:00", None),
    ("2026-02-29", None),
    ("1677-09-21", None),
    ("2262-04-12", None),
    ("not-a-date", None),
    ("", None),
    (None, None),
]


def test_dates(spark):
    got = evaluate(spark, fn.parse_date, [raw for raw, _ in DATES])
    assert dict(zip([r for r, _ in DATES], got, strict=True)) == dict(DATES)


def test_reporting_date_follows_the_business_zone(spark):
    moments = [
        utc(2026, 9, 1, 20, 30),
        utc(2026, 9, 1, 22, 30),
        utc(2026, 9, 1),
        None,
    ]

    def east(c):
        return fn.reporting_date(c, "Africa/Addis_Ababa")

    assert evaluate(spark, east, moments, "timestamp") == [
        date(2026, 9, 1),
        date(2026, 9, 2),
        date(2026, 9, 1),
        None,
    ]

    def west(c):
        return fn.reporting_date(c, "America/New_York")

    winter_and_summer = [utc(2026, 1, 15, 4, 30), utc(2026, 7, 15, 4, 30)]
    assert evaluate(spark, west, winter_and_summer, "timestamp") == [
        date(2026, 1, 14),
        date(2026, 7, 15),
    ]


def test_status_key(spark):
    cases = {
        "paid": "paid",
        "PAID": "paid",
        " Partially Refunded ": "partially_refunded",
        "partially-refunded": "partially_refunded",
        "PARTIALLY__REFUNDED": "partially_refunded",
        "partially - \xa0 refunded": "partially_refunded",
        " cancelled\n": "cancelled",
        "": "",
        None: None,
    }
    assert evaluate(spark, fn.status_key, list(cases)) == list(cases.values())


def test_campaign_label(spark):
    cases = {
        "  Summer   Sale  ": "Summer Sale",
        "summer\t\xa0sale": "summer sale",
        "Summer": "Summer",
        "": None,
        " \u3000 ": None,
        None: None,
    }
    assert evaluate(spark, fn.campaign_label, list(cases)) == list(cases.values())


def test_blank_knows_all_white_space(spark):
    assert evaluate(spark, fn.is_blank, [None, "", "  ", "\t\xa0 \x1f", "x", " x "]) == [
        True,
        True,
        True,
        True,
        False,
        False,
    ]


def test_counters(spark):
    cases = {
        "45000": 45000,
        " 45 ": 45,
        "45\n": 45,
        "+5": 5,
        "-3": -3,
        "10.5": 10,
        "-10.9": -10,
        "1e3": 1000,
        "9007199254740993": 9007199254740993,
        "45,000": None,
        "1e30": None,
        "99999999999999999999": None,
        "NaN": None,
        "n/a": None,
        "": None,
        None: None,
    }
    assert evaluate(spark, fn.parse_counter, list(cases)) == list(cases.values())


def test_conversion(spark):
    params = Params(fx_rates={"USD": Decimal("135.5")})

    def convert(currency):
        return lambda c: fn.to_reporting_currency(c, currency, params)

    assert evaluate(spark, convert("usd"), [2.0, None], "double") == [271.0, None]
    assert evaluate(spark, convert("etb"), [2.0, None], "double") == [2.0, None]
    with pytest.raises(CurrencyError, match="GBP"):
        convert("GBP")(F.lit(1.0))


def test_exact_sum_ignores_order(spark):
    values = [0.1] * 10 + [1e9, -1e9, 0.2, 1e-8]
    for order in (values, values[::-1], sorted(values)):
        rows = spark.createDataFrame([(v,) for v in order], "v double").repartition(3)
        assert rows.agg(fn.exact_sum(F.col("v")).alias("s")).head().s == 1.20000001


def test_exact_sum_has_the_same_bits_for_any_partitioning(spark):
    rng = random.Random(4)
    values = [rng.choice((1e20, 1e-12, 130.7, -3e17, 2.0**70, 1e-9)) * rng.uniform(-1, 1) for _ in range(3000)]
    values += [1e20, 1e-12, -1e20, 17.35 * 130, 1e25, None]
    found = set()
    for parts in (1, 2, 7, 40):
        rng.shuffle(values)
        rows = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
        found.add(rows.agg(fn.exact_sum(F.col("v"))).head()[0])
    assert len(found) == 1
    assert found.pop() == pytest.approx(float(sum(Fraction(v) for v in values if v is not None)), rel=1e-15)
    assert rows.where("abs(v) < 1e-8").agg(fn.exact_sum(F.col("v"))).head()[0] == pytest.approx(
        float(sum(Fraction(v) for v in values if v is not None and abs(v) < 1e-8)), rel=1e-15
    )


def test_exact_sum_of_nothing_and_of_giants(spark):
    def total(values):
        rows = spark.createDataFrame([(v,) for v in values], "v double")
        return rows.agg(fn.exact_sum(F.col("v")).alias("s")).head().s

    assert total([]) is None
    assert total([None, None]) is None
    assert total([None, 2.5]) == 2.5
    assert total([1e30, 1.0]) == 1e30


def test_roas_bands_at_the_thresholds(spark):
    params = Params()
    values = [5.0, 3.0, 2.999999, 1.5, 1.499999, 0.0, -1.0, float("nan"), None]
    bands = evaluate(spark, lambda c: fn.roas_band(c, params), values, "double")
    assert bands == ["green", "green", "amber", "amber", "red", "red", "red", "neutral", "neutral"]
    labels = evaluate(spark, fn.roas_band_label, ["green", "amber", "red", "neutral"])
    assert labels == ["+ On target", "~ Watch", "- Below", None]
    other = Params(roas_green_threshold="10", roas_amber_threshold="4")
    assert evaluate(spark, lambda c: fn.roas_band(c, other), [5.0], "double") == ["amber"]


def test_rounding_halves_to_even(spark):
    got = evaluate(spark, lambda c: fn.round_half_even(c, 2), [0.125, 2.675, 1.005, None], "double")
    assert got == [0.12, 2.68, 1.0, None]


def test_a_usual_amount_is_searched_once(spark):
    money = spark.range(1).select(fn.parse_money(F.col("id").cast("string")).alias("x"))
    assert optimized_plan_of(money).count(numbers.USUAL_AMOUNT) == 1


def test_long_and_mixed_amounts(spark):
    texts = ["12345,678", "(12345 678)", "ETB 7,000 000", "(-5)", "(5) ", "ETB 1 2345", "1." + "0" * 400]
    assert evaluate(spark, fn.parse_money, texts) == [12345678.0, -12345678.0, 7e6, 5.0, None, None, 1.0]
    digits = ["9" * n + tail for n in (100, 101, 300, 400) for tail in ("", " ETB")]
    want = [float(d.split()[0]) if len(d) < 310 else None for d in digits]
    assert evaluate(spark, fn.parse_money, digits) == want
    many = ["$1" + ",234" * k for k in (60, 61, 110)]
    assert evaluate(spark, fn.parse_money, many) == [float("1" + "234" * 60), float("1" + "234" * 61), None]
