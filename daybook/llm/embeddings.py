"""Operator 3: near-duplicate vectors by Euclidean p-stable hashing.

Normalised vectors are projected on Gaussian directions, shifted and cut into steps of a
fixed width. Several such numbers make a bucket key and there are several tables of keys.
Vectors that share a bucket in any table are compared by their exact cosine in double
precision. The number of projections of a key follows the number of vectors, so a bucket
has few unrelated members at any size; the number of tables follows from the wanted
chance to find a pair at the threshold.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.blocks import local_forest, pairs_within, tiles, whole_groups
from daybook.llm.common import mix, record
from daybook.llm.graph import components
from daybook.session import settle


@dataclass(frozen=True)
class Hashing:
    """``recall`` is the chance to find a pair that lies exactly at the threshold."""

    threshold: float = 0.95
    width: float = 2.0
    recall: float = 0.999
    #: unrelated vectors expected in a vector's bucket
    strangers: float = 0.1
    seed: int = 17

    def collide(self, distance: float) -> float:
        """Chance that two vectors at a distance get the same step of one projection."""
        t = self.width / distance
        tail = 0.5 * math.erfc(t / math.sqrt(2))
        return 1 - 2 * tail - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))

    def shape(self, vectors: int) -> tuple[int, int]:
        """Projections of a key and number of tables for so many vectors."""
        near = self.collide(math.sqrt(2 - 2 * self.threshold))
        far = self.collide(math.sqrt(2))
        rows = max(4, math.ceil(math.log(max(vectors, 2) / self.strangers) / -math.log(far)))
        tables = math.ceil(math.log(1 - self.recall) / math.log(1 - near**rows))
        return rows, tables


@lru_cache(maxsize=8)
def _directions(dim: int, rows: int, tables: int, width: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng((seed, dim))
    return rng.standard_normal((dim, rows * tables)), rng.uniform(0, width, rows * tables)


def bucket_keys(unit: np.ndarray, rows: int, tables: int, hashing: Hashing) -> np.ndarray:
    """Keys of unit vectors, a column per table. Vectors of other lengths get other keys."""
    directions, shift = _directions(unit.shape[1], rows, tables, hashing.width, hashing.seed)
    # Row by row products do not depend on which vectors are handled together.
    projected = np.einsum("ij,jk->ik", unit, directions, optimize=False)
    steps = np.floor((projected + shift) / hashing.width).astype(np.int64)
    keys = np.empty((len(unit), tables), dtype=np.int64)
    for t in range(tables):
        part = mix(steps[:, t * rows : (t + 1) * rows].astype(np.uint64))
        total = np.full(len(unit), np.uint64(unit.shape[1]))
        for k in range(rows):
            total = mix(total * np.uint64(0x9E3779B97F4A7C15) + part[:, k])
        keys[:, t] = total.view(np.int64)
    return keys


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


def _valid(row) -> np.ndarray | None:
    """The vector in double precision, or None where it links with nothing."""
    if row is None or not len(row):
        return None
    v = np.array(row, dtype=np.float64)  # a null component becomes nan
    if not np.isfinite(v).all():
        return None
    top = np.abs(v).max()
    return v / top if top > 0 else None  # scaled, so that squares neither overflow nor vanish


_PACKED = pa.schema([("vec_id", pa.int64()), ("vector", pa.binary()), ("dim", pa.int32())])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [_valid(v) for v in batch.column("embedding").to_pylist()]
        data = [None if v is None else v.astype("<f8").tobytes() for v in rows]
        yield record(_PACKED, batch.column("vec_id"), data, [0 if v is None else len(v) for v in rows])


def near_duplicates(vectors: DataFrame, hashing: Hashing = Hashing()) -> DataFrame:
    """Links of cosine >= ``threshold`` among all rows of (vec_id, embedding).

    One row per input row: vec_id, n_links (other rows linked directly), component_id
    (smallest vec_id reachable by links, the own included), kept (vec_id = component_id). Null
    or zero vectors and those with null or non-finite components link with nothing, nor do
    vectors of different lengths with each other. Equal vectors are compared once and count
    as many; rows with one vec_id are vectors of their own. A row with a null
    vec_id takes part like any other; a component of such rows alone has a null id and
    keeps its rows. An empty table gives no rows.
    """
    named = vectors.select(
        vectors["vec_id"].cast("long").alias("vec_id"),
        vectors["embedding"].cast("array<double>").alias("embedding"),
    )
    packed = named.mapInArrow(_pack, "vec_id long, vector binary, dim int").withColumn("same", F.sha2("vector", 256))
    rows = settle(packed, "vectors").withColumn("uid", F.monotonically_increasing_id())
    rows = settle(rows, "vectors")  # from here on a row has its uid for good
    # One row for all equal vectors.
    equal = rows.where("vector is not null").groupBy("same").agg(
        F.min("uid").alias("uid"), F.count("*").alias("weight"), F.min("vec_id").alias("least_id")
    )
    equal = settle(equal, "equal-vectors")
    single = settle(
        rows.select("uid", "vector", "dim").join(equal.select("uid", "weight"), "uid"), "distinct-vectors"
    )
    per_key, tables = hashing.shape(single.count())
    threshold = hashing.threshold

    keyed = pa.schema([("uid", pa.int64()), ("bucket", pa.int64()), ("in_table", pa.int32())])

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, ["dim"], least=1):
            for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
                for at in range(lo, hi, 1024):
                    part = table.slice(at, min(1024, hi - at))
                    unit = _unit(_matrix(part))
                    found = bucket_keys(unit, per_key, tables, hashing)
                    uid = np.repeat(part.column("uid").to_numpy(), tables)
                    yield record(keyed, uid, found.ravel(), np.tile(np.arange(tables), len(unit)))

    hashed = single.mapInArrow(keys, "uid long, bucket long, in_table int")
    hashed = settle(hashed, "vector-keys")
    sizes = hashed.groupBy("bucket", "in_table").agg(F.count("*").alias("n")).where("n > 1")
    sizes = settle(sizes, "vector-buckets")
    members = hashed.join(sizes.select("bucket", "in_table"), ["bucket", "in_table"])
    members = members.join(single, "uid").select("bucket", "in_table", "uid", "weight", "dim", "vector")
    at = ["bucket", "in_table"]
    met = pa.schema([("uid", pa.int64()), ("links", pa.int64()), ("centre", pa.int64())])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, [*at, "tile_a", "tile_b", "dim"]):
            uid, weight = table.column("uid").to_numpy(), table.column("weight").to_numpy()
            block = table.column("block").to_numpy()
            crossing = table.column("tile_a").to_numpy() != table.column("tile_b").to_numpy()
            in_table = table.column("in_table").to_numpy()
            dims = table.column("dim").to_numpy()
            units: dict[int, np.ndarray] = {}
            keys_of: dict[int, np.ndarray] = {}
            place = np.zeros(len(uid), dtype=np.int64)
            for dim in np.unique(dims):
                where = np.flatnonzero(dims == dim)
                _, first, inverse = np.unique(uid[where], return_index=True, return_inverse=True)
                place[where] = inverse
                units[dim] = _unit(_matrix(table.take(where[first])))
                keys_of[dim] = bucket_keys(units[dim], per_key, tables, hashing)
            links = np.zeros(len(uid), dtype=np.int64)
            linked: list[tuple[np.ndarray, np.ndarray]] = []
            for a, b in pairs_within(bounds):
                ok = ~crossing[a] | (block[a] != block[b])
                a, b = a[ok], b[ok]
                for dim in units:
                    of = dims[a] == dim if len(units) > 1 else slice(None)
                    p, q = a[of], b[of]
                    if not len(p):
                        continue
                    u, k = units[dim], keys_of[dim]
                    near = np.flatnonzero(np.einsum("ij,ij->i", u[place[p]], u[place[q]]) >= threshold)
                    p, q = p[near], q[near]
                    # The first table in which two vectors meet counts their link.
                    first = (k[place[p]] == k[place[q]]).argmax(axis=1) == in_table[p]
                    p, q = p[first], q[first]
                    np.add.at(links, p, weight[q])
                    np.add.at(links, q, weight[p])
                    linked.append((p, q))
            if not linked:
                continue
            a, b = (np.concatenate(x) for x in zip(*linked, strict=True))
            centre = uid.copy()
            member, hub = local_forest(a, b, len(uid))
            centre[member] = uid[hub]
            some = np.flatnonzero(links)
            yield record(met, uid[some], links[some], centre[some])

    found = tiles(members, sizes, at).mapInArrow(compare, "uid long, links long, centre long")
    found = settle(found, "vector-links")
    counts = found.groupBy("uid").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("uid").alias("a"), F.col("centre").alias("b")))
    linked = equal.join(counts, "uid", "left").join(groups.withColumnRenamed("node", "uid"), "uid", "left")
    linked = linked.withColumn("component", F.coalesce("component", "uid"))
    least = linked.groupBy("component").agg(F.min("least_id").alias("component_id"))
    linked = linked.join(least, "component").select(
        "same", "component_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    )
    joined = rows.select("vec_id", "same").join(linked, "same", "left")
    component = F.when(F.col("n_links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, component.isNull()).alias("kept"),
    )


def _matrix(table: pa.Table) -> np.ndarray:
    data = b"".join(table.column("vector").to_pylist())
    return np.frombuffer(data, dtype="<f8").reshape(table.num_rows, -1)
