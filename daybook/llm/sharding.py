"""Operator 10: shards along a Hilbert curve over several metadata columns.

Every dimension is quantised at its own quantiles over all rows, the levels become an
index on a Hilbert curve, and the rows in the order of the index are cut into runs of
equal numbers of rows. Neighbours on the curve are near in every dimension, so each
shard covers a small box and a filter on any of them skips files.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.session import settle

BITS = 5


def hilbert_index(levels: np.ndarray, bits: int) -> np.ndarray:
    """Curve index of points, a row per dimension of integers below 2**bits.

    The levels are first brought into the curve's transposed form by exchanging and
    inverting low bits from the top bit down, then Gray-decoded, then interleaved.
    """
    x = levels.astype(np.int64).copy()
    n = len(x)
    for q in (1 << k for k in range(bits - 1, 0, -1)):
        low = q - 1
        for i in range(n):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    for q in (1 << k for k in range(bits - 1, 0, -1)):
        turn = np.where((x[n - 1] & q) != 0, turn ^ (q - 1), turn)
    x ^= turn
    index = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for i in range(n):
            index = index << 1 | (x[i] >> bit & 1)
    return index


def text_ranks(values: DataFrame, name: str) -> DataFrame:
    """Every distinct text of a column with a number that keeps their order (``<name>_rank``)."""
    distinct = values.select(name).where(F.col(name).isNotNull()).distinct()
    ordered = distinct.repartitionByRange(name).sortWithinPartitions(name)
    return settle(ordered.withColumn(f"{name}_rank", F.monotonically_increasing_id().cast("double")), "text-ranks")


def _narrow(docs: DataFrame, dimensions: Sequence[Column], size: Column) -> tuple[DataFrame, list[str]]:
    """doc_id, size, text_crc32, a hash of the text, and the dimensions as numbers that equal texts share."""
    names = [f"d{k}" for k in range(len(dimensions))]
    whole = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        size.alias("size"),
        F.crc32(whole).alias("text_crc32"),
        F.xxhash64(whole).alias("same"),
        *[d.alias(n) for n, d in zip(names, dimensions, strict=True)],
    )
    rows = settle(rows, "shard-rows")
    for name in [n for n in names if rows.schema[n].dataType.typeName() == "string"]:
        # Joined by the size of the dictionary; a value that fills a third of the rows is split at run time.
        rows = rows.join(text_ranks(rows, name), name, "left").drop(name).withColumnRenamed(f"{name}_rank", name)
    rows = rows.select("doc_id", "size", "text_crc32", "same", *[F.col(n).cast("double").alias(n) for n in names])
    rows = settle(rows, "shard-numbers")
    key = ["same", "size", "text_crc32"]
    groups = rows.groupBy(*key).agg(F.count("*").alias("n"), *[F.min(n).alias(f"least_{n}") for n in names])
    groups = settle(groups.where("n > 1").drop("n"), "equal-texts").withColumn("many", F.lit(True))
    shared = [F.when(F.col("many"), F.col(f"least_{n}")).otherwise(F.col(n)).alias(n) for n in names]
    return rows.join(groups, key, "left").select("doc_id", *key, *shared), names


def shard(
    docs: DataFrame,
    dimensions: Sequence[Column] | None = None,
    shards: int = 24,
    bits: int = BITS,
) -> DataFrame:
    """Assign every row of ``docs`` (doc_id, text, ...) a shard and its place in it.

    Columns: doc_id, size (UTF-8 bytes of the text, null: none, plus 8), text_crc32, law
    ("rows": numbers of rows differ by one at most), shard, slot, grown_shard (always null,
    as the cuts move when shards are added), hilbert. ``dimensions`` are columns of numbers or texts, which
    count by their rank among all texts of the column; by default the id, the size, the language
    and the source. A null lies at the lowest level.

    Equal texts, null and empty ones among them, count as one point, the least of each dimension over
    all of them, and ties go by text before id, so they are neighbours whatever their metadata;
    only a group at one of the cuts lies in two shards, or one larger than a shard in more.
    Every row of repeated rows has a place of its own. An empty table gives no rows.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 8
    if dimensions is None:
        dimensions = (F.col("doc_id"), size, F.col("lang"), F.col("source"))
    narrow, names = _narrow(docs, dimensions, size)
    narrow = settle(narrow, "shard-points")
    steps = [k / 2**bits for k in range(1, 2**bits)]
    found = narrow.agg(*[F.percentile_approx(n, steps, 10_000).alias(n) for n in names]).first()
    cuts = [np.unique(np.array(found[n] or [], dtype=np.float64)) for n in names]

    @F.pandas_udf("long")
    def index(*columns: pd.Series) -> pd.Series:
        levels = [
            np.where(c.isna(), 0, np.searchsorted(cut, c.to_numpy(np.float64, na_value=0.0), "right"))
            for c, cut in zip(columns, cuts, strict=True)
        ]
        return pd.Series(hilbert_index(np.array(levels), bits))

    # Ties go by text and id, so a hot point of the curve is still spread over tasks.
    order = ["hilbert", "same", "text_crc32", "size", "doc_id"]
    along = narrow.select("doc_id", "size", "text_crc32", "same", index(*names).alias("hilbert"))
    spread = along.repartitionByRange(*order).sortWithinPartitions(*order)
    # A row's number within its partition is in the low 33 bits, the partition above them.
    place = settle(spread.withColumn("place", F.monotonically_increasing_id()), "shard-order")
    place = place.withColumn("part", F.shiftright("place", 33)).withColumn(
        "place", F.col("place").bitwiseAND(2**33 - 1)
    )
    counts = {r["part"]: r["n"] for r in place.groupBy("part").agg(F.count("*").alias("n")).collect()}
    total, before, offsets = sum(counts.values()), 0, []
    for part in sorted(counts):
        offsets.append((part, before))
        before += counts[part]
    spark = docs.sparkSession
    starts = spark.createDataFrame(offsets, "part long, before long")
    low, more = divmod(total, shards)  # the first `more` shards have one row more
    at = F.col("before") + F.col("place")
    edge = more * (low + 1)
    in_long = at < edge
    per = max(low, 1)
    number = F.when(in_long, F.floor(at / (low + 1))).otherwise(more + F.floor((at - edge) / per))
    slot = F.when(in_long, at % (low + 1)).otherwise((at - edge) % per)
    # One row per task of the sort: as small as the list of that stage's tasks.
    return place.join(F.broadcast(starts), "part").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        number.cast("int").alias("shard"),
        slot.cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "hilbert",
    )
