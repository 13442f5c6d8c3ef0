"""Row-level data quality.

A row is never moved to another frame when it fails a test: it stays where it is
and gets a ``rejection_reason``. Accepted and rejected rows are filters on that
one column, so nothing is lost and every row has at most one reason, the first
that applies.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.contracts import (
    DUPLICATE_ORDER,
    EMPTY_ROW,
    MALFORMED,
    MISSING_REQUIRED,
    POSITION,
    REASON,
)
from daybook.errors import DataQualityError
from daybook.functions.text import is_blank

#: A position in one number: rows of a block are numbered below ``_ROWS``.
_SPOT = "decimal(38,0)"
_ROWS = 2**63

_HELPERS = (*POSITION, MALFORMED, REASON)


@dataclass(frozen=True)
class DQReport:
    """How many rows of one source came in, stayed, and left for which reason."""

    source: str
    rows_received: int
    reasons: Mapping[str, int]

    @property
    def rows_rejected(self) -> int:
        return sum(self.reasons.values())

    @property
    def rows_accepted(self) -> int:
        return self.rows_received - self.rows_rejected

    @property
    def rejection_rate(self) -> float:
        return self.rows_rejected / self.rows_received if self.rows_received else 0.0


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.col(REASON).isNull())


def rejected(df: DataFrame) -> DataFrame:
    return df.where(F.col(REASON).isNotNull())


def first_reason(*tests: tuple[str, Column]) -> Column:
    """The reason of the first test that holds, or null."""
    return F.coalesce(*(F.when(holds, F.lit(reason)) for reason, holds in tests))


def with_reason(df: DataFrame, label: str, reasons: Sequence[str], reason: Column) -> DataFrame:
    """Set the reason of rows that have none yet, and count reasons in passing.

    The counts reach query listeners under ``label`` at no extra cost. They also
    keep Spark from copying a filter on the reason, and with it all the parsing
    the reason depends on, below the projection that parses already.
    """
    return df.withColumn(REASON, F.coalesce(F.col(REASON), reason)).observe(
        label,
        F.count(F.lit(1)).alias("received"),
        *(F.count_if(F.col(REASON) == name).alias(name) for name in reasons),
    )


def flag_missing(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Flag rows without any value, then rows with a blank required value.

    An all-blank row that holds white space is not empty; it misses values.
    """
    values = [F.col(f"`{c.replace('`', '``')}`") for c in df.columns if c not in _HELPERS]
    reason = first_reason(
        (EMPTY_ROW, reduce(and_, (v.isNull() for v in values))),
        (MISSING_REQUIRED, reduce(or_, (is_blank(F.col(c)) for c in required))),
    )
    if MALFORMED in df.columns:  # null, or an error that must not be optimised away
        reason = F.coalesce(F.col(MALFORMED), reason)
    return df.withColumn(REASON, reason).drop(MALFORMED)


def repeated_keys(
    df: DataFrame, key: str = "order_id", position: Sequence[str] = POSITION
) -> DataFrame:
    """Keys that occur more than once, with their first position and copy count.

    Built for a mostly unique key. The first pass shuffles one hash and partial
    count per key instead of the key text. Only rows whose hash repeats take part
    in the second pass, which goes by the keys themselves, so keys that merely
    share a hash drop out again. Positions are reduced to one minimum per key and
    task before they are shuffled: a key that fills a third of the input costs
    each task one row. With no repeats the second pass is dropped at run time.

    A minimum over text would sort every suspect row. So the file blocks, of which there
    are as many as splits of the input, are numbered in order, and a position is the number
    of its block and the row in one decimal, which a hash aggregate holds. The result
    shows positions as they were.
    """
    *block, row = position
    opened = accepted(df)
    eligible = opened.select(key, *position, F.xxhash64(key).alias("__hash"))
    suspects = (
        eligible.groupBy("__hash").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    ).select("__hash")
    in_order = F.array_sort(F.collect_set(F.struct(*block)))
    blocks = opened.select(*block).distinct().agg(in_order.alias("at")).select(
        F.posexplode("at").alias("__block_no", "at")
    ).select("__block_no", "at.*")
    spot = F.col("__block_no").cast("decimal(10,0)") * F.lit(Decimal(_ROWS)) + F.col(row)
    firsts = (
        eligible.join(suspects, "__hash", "left_semi")
        .join(blocks, reduce(and_, (eligible[c].eqNullSafe(blocks[c]) for c in block)))
        .groupBy(key)
        .agg(F.min(spot.cast(_SPOT)).alias("__spot"), F.count(F.lit(1)).alias("__copies"))
        .where(F.col("__copies") > 1)
        .withColumns(
            {
                "__block_no": F.expr(f"cast(__spot div {_ROWS} as int)"),
                row: F.expr(f"cast(__spot % {_ROWS} as bigint)"),
            }
        )
    )
    return firsts.join(blocks, "__block_no").select(key, F.struct(*position).alias("__first"), "__copies")


def known_keys(df: DataFrame, earlier: DataFrame, key: str = "order_id") -> DataFrame:
    """Keys of rows without a reason that some such row of ``earlier`` has too.

    The keys of ``df``, the smaller side, meet the earlier ones in a semi-join, so at most as many
    keys come out as ``df`` has.
    """
    new = accepted(df).select(key).distinct()
    return accepted(earlier).select(key).join(new, key, "left_semi").distinct()


def flag_known(
    df: DataFrame, known: DataFrame, key: str = "order_id", position: Sequence[str] = POSITION
) -> DataFrame:
    """Flag every occurrence of a key that came in before; ``known`` comes from ``known_keys``."""
    open_row = F.col(REASON).isNull()
    matched = df.join(
        known.select(F.col(key).alias("__known")),
        (_key_of_open_rows(key, position) == F.col("__known")) & open_row,
        "left",
    )
    again = F.when(F.col("__known").isNotNull(), F.lit(DUPLICATE_ORDER))
    return matched.withColumn(REASON, F.coalesce(F.col(REASON), again)).drop("__known")


def _key_of_open_rows(key: str, position: Sequence[str]) -> Column:
    """The key, or one of its own for a row already rejected, so that blank keys do not gather."""
    own_key = F.concat(F.lit("\0"), *(F.col(c).cast("string") for c in position))
    return F.when(F.col(REASON).isNull(), F.col(key)).otherwise(own_key)


def flag_repeats(
    df: DataFrame,
    repeats: DataFrame,
    key: str = "order_id",
    position: Sequence[str] = POSITION,
) -> DataFrame:
    """Flag every occurrence of a key but the first; keys compare as they are.

    ``repeats`` comes from ``repeated_keys``. It is small unless much of the
    input is duplicated: then Spark broadcasts it and the rows do not move.
    Otherwise this is a sort-merge join whose row side is split where one key
    is hot. Rows already rejected take no part; each gets a key of its own so
    that blank keys do not gather in one task.
    """
    open_row = F.col(REASON).isNull()
    left_key = _key_of_open_rows(key, position)
    firsts = repeats.select(F.col(key).alias("__repeated"), "__first")
    later = F.struct(*position) > F.col("__first")
    return (
        df.join(firsts, (left_key == F.col("__repeated")) & open_row, "left")
        .withColumn(REASON, F.coalesce(F.col(REASON), F.when(later, F.lit(DUPLICATE_ORDER))))
        .drop("__repeated", "__first")
    )


def rejection_counts(df: DataFrame, source: str) -> DataFrame:
    """Rejected rows per reason: ``(source, rejection_reason, n)``."""
    return (
        rejected(df)
        .groupBy(REASON)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.lit(source).alias("source"), REASON, "n")
    )


def quality_summary(df: DataFrame, source: str, threshold: float) -> DataFrame:
    """One row of row counts and whether the rejected share is above the threshold."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows_received"),
        F.count(REASON).alias("rows_rejected"),
    )
    received, dropped = F.col("rows_received"), F.col("rows_rejected")
    rate = F.when(received > 0, dropped / received).otherwise(F.lit(0.0))
    return counts.select(
        F.lit(source).alias("source"),
        received,
        (received - dropped).alias("rows_accepted"),
        dropped,
        rate.alias("rejection_rate"),
        F.lit(float(threshold)).alias("threshold"),
        (rate > float(threshold)).alias("exceeds"),
    )


def dq_report(df: DataFrame, source: str) -> DQReport:
    """Count a flagged frame; brings one number per reason to the driver."""
    counts = {r[REASON]: r["n"] for r in df.groupBy(REASON).agg(F.count("*").alias("n")).collect()}
    received = sum(counts.values())
    counts.pop(None, None)
    return DQReport(source, received, counts)


def enforce_threshold(report: DQReport, threshold: float) -> None:
    """Refuse a source of which more than the allowed share of rows was rejected."""
    if report.rejection_rate > threshold:
        raise DataQualityError(
            f"{report.source}: {report.rows_rejected} of {report.rows_received} rows were "
            f"rejected, and only a share of {threshold:g} may be"
        )
