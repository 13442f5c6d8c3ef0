"""Comparing the members of buckets of any size, in tiles of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Members of a bucket that meet in one tile: one block with itself or with another.
BLOCK = 512


def tiles(members: DataFrame, sizes: DataFrame, keys: list[str], member: str = "uid") -> DataFrame:
    """Deal the members of buckets out to tiles, so that every pair meets in exactly one.

    ``sizes`` has the keys and ``n``, the members of each bucket. A bucket of more than BLOCK
    members is split into blocks by a hash of the member, and there is a tile for every two
    blocks and for each block with itself. Adds block, tile_a, tile_b; the result is
    partitioned by tile and sorted, a tile's rows together.
    """
    split = members.join(sizes.select(*keys, F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), keys)
    split = split.withColumn("block", F.pmod(F.xxhash64(member), F.col("blocks")).cast("int"))
    other = F.explode(F.when(F.col("blocks") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = split.withColumn("other", other).select(
        *members.columns,
        "block",
        F.least("block", "other").alias("tile_a"),
        F.greatest("block", "other").alias("tile_b"),
    )
    at = [*keys, "tile_a", "tile_b"]
    return dealt.repartition(*at).sortWithinPartitions(*at, member)


def whole_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str], least: int = 4096
) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole runs of equal keys with the bounds of the runs, from sorted batches."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows < least:
            continue
        table = pa.Table.from_batches(held)
        bounds = _bounds(table, keys)
        last = int(bounds[-2])
        if last:
            yield table.slice(0, last), bounds[:-1]
        held, rows = table.slice(last).to_batches(), table.num_rows - last
    if rows:
        table = pa.Table.from_batches(held)
        yield table, _bounds(table, keys)


def _bounds(table: pa.Table, keys: list[str]) -> np.ndarray:
    differs = np.zeros(table.num_rows, dtype=bool)
    differs[0] = True
    for key in keys:
        column = table.column(key).combine_chunks().to_numpy(zero_copy_only=False)
        differs[1:] |= column[1:] != column[:-1]
    return np.append(np.flatnonzero(differs), table.num_rows)


def pairs_within(bounds: np.ndarray, most: int = 24) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs (a, b) of equal runs, by distance for short runs and run by run for long ones."""
    size = np.diff(bounds)
    short = size <= most
    run = np.repeat(np.arange(len(size)), size)
    for apart in range(1, min(most, int(size.max(initial=1)))):
        a = np.flatnonzero((run[:-apart] == run[apart:]) & short[run[:-apart]])
        if len(a):
            yield a, a + apart
    for k in np.flatnonzero(~short):
        rows = np.arange(bounds[k], bounds[k + 1])
        step = max(1, 500_000 // len(rows))  # bounds the pairs held at a time
        for lo in range(0, len(rows), step):
            a, b = np.nonzero(np.arange(lo, min(lo + step, len(rows)))[:, None] < np.arange(len(rows))[None, :])
            yield rows[lo + a], rows[b]


def local_forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """A star per connected part of the links (a, b) among ``n`` rows: members and their centres."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            break
    members = np.flatnonzero(label != np.arange(n))
    return members, label[members]
