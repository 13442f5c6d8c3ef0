"""Shop orders and ad spend derived from the given tables.

The tables hold no such exports, so orders come from ``orders`` and ``lineitem``
and ad spend comes from ``events``. ``raw_*`` frames carry text as an export
would, in many layouts, with defects placed by key arithmetic so that an oracle
can restate them as predicates. ``clean_*`` frames are typed from the start.
Every frame covers its whole tables.

=====================  ======================================================
orders, key k          k % 211 empty row, % 89 blank net, % 53 second copy with
                       doubled amounts (standing first where % 106), % 101 bad
                       timestamp, % 97 bad gross, % 61 bad discount, % 43
                       negative discount, % 41 and % 83 unknown status
ad rows, key e         e % 211 empty row, % 89 blank spend, % 101 bad start,
                       % 103 seven-day interval, % 97 bad spend, % 37 and % 31
                       no campaign; days ending in 3 have no counters
=====================  ======================================================
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.contracts import ORDER_MONEY, POSITION
from daybook.functions import reporting_date, to_reporting_currency
from daybook.params import Params

#: Moves the events of January 2024 to the ten days before the first order on.
DAYS_BACK = 10602

RECOGNISED = {"F": "paid", "P": "partially_paid"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _every(key: str, n: int) -> Column:
    return F.col(key) % n == 0


def order_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: key, status code, day and sums over its lines in whole units, null without lines."""
    # Whole cents and per cents: sums of longs are exact and cheap.
    cents, off, tax = (
        F.round(F.col(c) * 100).cast("bigint") for c in ("l_extendedprice", "l_discount", "l_tax")
    )
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.sum(cents).alias("gross"),
            F.sum(cents * off).alias("discount"),
            F.sum(cents * tax).alias("tax"),
        )
    )

    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.col("o_orderstatus").alias("code"),
        F.col("o_orderdate").cast("timestamp").alias("day_start"),
    )
    # Spread by key like the lines, as a small table may be one row group and so one task.
    orders = orders.repartition("k")
    return orders.join(lines, orders["k"] == lines["l_orderkey"], "left").drop("l_orderkey")


def order_facts(spark: SparkSession, sf_dir: str, units: DataFrame | None = None) -> DataFrame:
    """One row per order (amounts are zero without lines): key, status code, moment (UTC), exact amounts.

    ``units`` has rows of ``order_units``, if they are stored already.
    """

    def scaled(amount: Column, places: int) -> Column:
        step = F.lit(Decimal(1).scaleb(-places))
        whole = F.coalesce(amount, F.lit(0)).cast("decimal(18,0)")
        return (whole * step).cast(f"decimal(20,{places})")

    clock = F.make_dt_interval(F.lit(0), F.col("k") % 24, F.col("k") % 60, F.lit(0))
    return (order_units(spark, sf_dir) if units is None else units).select(
        "k",
        "code",
        "day_start",
        (F.col("day_start") + clock).alias("moment"),
        scaled(F.col("gross"), 2).alias("gross"),
        scaled(F.col("discount"), 4).alias("discount"),
        scaled(F.col("gross") * 100 - F.col("discount"), 4).alias("net"),
        scaled(F.col("tax"), 4).alias("tax"),
    )


def ad_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event: key, kind, shifted day, exact value."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("e"),
        F.col("event_type").alias("kind"),
        F.date_sub(F.to_date("ts"), DAYS_BACK).alias("day"),
        F.col("value").cast("decimal(12,2)").alias("value"),
    )


# ---------------------------------------------------------------- text layouts


def _pick(selector: Column, *choices: Column) -> Column:
    chosen = choices[-1]
    for i in range(len(choices) - 2, -1, -1):
        chosen = F.when(selector == i, choices[i]).otherwise(chosen)
    return chosen


def money_text(amount: Column, places: int, selector: Column, code: str) -> Column:
    """An amount in one of six spellings an export may use."""
    plain = amount.cast("string")
    grouped = F.format_number(amount, places)
    return _pick(
        F.abs(selector) % 6,
        plain,
        F.when(amount < 0, F.concat(F.lit("("), F.format_number(-amount, places), F.lit(")")))
        .otherwise(F.concat(F.lit("$"), grouped)),
        F.concat(F.lit(f"{code} "), plain),
        F.concat(grouped, F.lit(f" {code}")),
        F.translate(grouped, ",", " "),
        F.concat(F.lit(" \t"), plain, F.lit("  ")),
    )


def moment_text(moment: Column, selector: Column) -> Column:
    """A moment in one of seven layouts; the last two drop seconds and clock."""

    def at(pattern: str, shift: int = 0) -> Column:
        return F.date_format(moment + F.expr(f"interval {shift} hours"), pattern)

    stamp = "yyyy-MM-dd HH:mm:ss"
    return _pick(
        selector % 7,
        at("yyyy-MM-dd'T'HH:mm:ss'Z'"),
        F.concat(at(stamp), F.lit(" UTC")),
        F.concat(at(stamp, 3), F.lit("+0300")),
        F.concat(at("yyyy-MM-dd'T'HH:mm:ss", -5), F.lit("-05:00")),
        at(stamp),
        at("yyyy-MM-dd HH:mm"),
        at("yyyy-MM-dd"),
    )


def status_text(key: str = "k") -> Column:
    return (
        F.when(_every(key, 41), "Under  Review")
        .when(_every(key, 83), "disputed")
        .when(F.col("code") == "F", "Paid")
        .when(F.col("code") == "P", " Partially-Paid ")
        .otherwise("PENDING")
    )


def campaign_text(key: str = "e") -> Column:
    return (
        F.when(_every(key, 37), F.lit(None).cast("string"))
        .when(_every(key, 31), "   ")
        .otherwise(F.concat(F.lit("  Spring\t  Sale "), F.col("kind"), F.lit(" ")))
    )


def impressions_text() -> Column:
    known = (
        F.when(F.col("kind") == "view", "1")
        .when(F.col("kind") == "click", " 2 ")
        .when(F.col("kind") == "purchase", "10.5")
        .when(F.col("kind") == "signup", "45,000")
    )
    return F.when(F.dayofmonth("day") % 10 != 3, known)


def clicks_text() -> Column:
    known = F.when(F.col("kind") == "click", "1").when(F.col("kind") == "view", "0")
    return F.when(F.dayofmonth("day") % 10 != 3, known)


def day_text(day: Column, selector: Column) -> Column:
    return _pick(
        selector % 3,
        F.date_format(day, "yyyy-MM-dd"),
        F.date_format(day, "yyyy/M/d"),
        F.concat(F.lit(" "), F.date_format(day, "yyyy-MM-dd"), F.lit("\t")),
    )


# ------------------------------------------------------------------ raw frames


def raw_orders(spark: SparkSession, sf_dir: str, units: DataFrame | None = None) -> DataFrame:
    """Orders as export text under canonical names, with row positions.

    ``units`` has rows of ``order_units``, if they are stored already.
    """
    copies = F.when(_every("k", 53), 2).otherwise(1)
    rows = (
        order_facts(spark, sf_dir, units)
        .withColumn("slot", F.explode(F.sequence(F.lit(0), copies - 1)))
        .withColumn("copy", F.when(_every("k", 106), 1 - F.col("slot")).otherwise(F.col("slot")))
    )
    factor = F.col("copy") + 1
    discount = F.when(_every("k", 43), -F.col("discount")).otherwise(F.col("discount"))
    rows = rows.withColumns(
        {
            "gross": (F.col("gross") * factor).cast("decimal(20,2)"),
            "discount": (discount * factor).cast("decimal(20,4)"),
            "net": (F.col("net") * factor).cast("decimal(20,4)"),
            "tax": (F.col("tax") * factor).cast("decimal(20,4)"),
        }
    )

    def money(name: str, places: int, column: int) -> Column:
        return money_text(F.col(name), places, F.col("k") + column, "ETB")

    blank = F.when(_every("k", 2), "   ")
    cells = {
        "order_id": F.concat(F.lit("S"), F.col("k").cast("string")),
        "created_at": F.when(_every("k", 101), "not-a-date").otherwise(
            moment_text(F.col("moment"), F.col("k"))
        ),
        "financial_status": status_text(),
        "gross_amount": F.when(_every("k", 97), "not_a_number").otherwise(
            money("gross", 2, 0)
        ),
        "discount_amount": F.when(_every("k", 61), "n/a").otherwise(money("discount", 4, 1)),
        "net_amount": F.when(_every("k", 89), blank).otherwise(money("net", 4, 2)),
        "taxes": money("tax", 4, 3),
        "shipping_fees": F.lit("0.00"),
        "currency": F.lit("ETB"),
    }
    return rows.select(
        *(F.when(~_every("k", 211), cell).alias(name) for name, cell in cells.items()),
        F.lit("orders.csv").alias(POSITION[0]),
        F.lit(0).cast("bigint").alias(POSITION[1]),
        (F.col("k") * 2 + F.col("slot")).alias(POSITION[2]),
    )


def raw_ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ad spend as export text under canonical names, with row positions."""
    end = F.when(_every("e", 103), F.date_add("day", 6)).otherwise(F.col("day"))
    cells = {
        "reporting_start": F.when(_every("e", 101), "not-a-date").otherwise(
            day_text(F.col("day"), F.col("e"))
        ),
        "reporting_end": day_text(end, F.col("e") + 1),
        "campaign_name": campaign_text(),
        "spend_amount": F.when(_every("e", 89), F.lit(None).cast("string"))
        .when(_every("e", 97), "abc")
        .otherwise(money_text(F.col("value"), 2, F.col("e"), "USD")),
        "impressions": impressions_text(),
        "link_clicks": clicks_text(),
    }
    return ad_facts(spark, sf_dir).select(
        *(F.when(~_every("e", 211), cell).alias(name) for name, cell in cells.items()),
        F.lit("ads.csv").alias(POSITION[0]),
        F.lit(0).cast("bigint").alias(POSITION[1]),
        F.col("e").alias(POSITION[2]),
    )


# ---------------------------------------------------------------- clean frames


def clean_orders(spark: SparkSession, sf_dir: str, params: Params) -> DataFrame:
    """Recognised orders, typed, one row per order."""
    amounts = dict(zip(ORDER_MONEY, ("gross", "discount", "net", "tax", None), strict=True))
    status = _pick(F.when(F.col("code") == "F", 0).otherwise(1), *map(F.lit, RECOGNISED.values()))
    return (
        order_facts(spark, sf_dir)
        .where(F.col("code").isin(sorted(RECOGNISED)))
        .select(
            F.col("k").cast("string").alias("order_id"),
            reporting_date(F.col("moment"), params.reporting_timezone).alias("calendar_date"),
            F.col("moment").alias("created_at_utc"),
            status.alias("financial_status"),
            *(
                (F.col(src).cast("double") if src else F.lit(0.0)).alias(name)
                for name, src in amounts.items()
            ),
            F.lit(params.reporting_currency).alias("reporting_currency"),
        )
    )


def clean_ads(spark: SparkSession, sf_dir: str, params: Params) -> DataFrame:
    """Ad rows, typed, spend in the reporting currency."""
    counted = F.dayofmonth("day") % 10 != 3
    spend = to_reporting_currency(F.col("value").cast("double"), params.ads_currency, params)
    return ad_facts(spark, sf_dir).select(
        F.col("day").alias("calendar_date"),
        F.col("kind").alias("campaign_name"),
        spend.alias("spend_amount"),
        F.when(counted, (F.col("kind") == "view").cast("bigint")).alias("impressions"),
        F.when(counted, (F.col("kind") == "click").cast("bigint")).alias("link_clicks"),
        F.lit(params.reporting_currency).alias("reporting_currency"),
    )
