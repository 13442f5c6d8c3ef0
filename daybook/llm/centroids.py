"""Operator 12: centroid clustering of integer vectors with subvector dictionaries.

Vectors are cut into blocks of neighbouring dimensions. Within a chunk of rows every block is
dictionary-encoded without loss: the distinct subvectors and a code per row. Each round works out
the exact squared distances between distinct subvectors and the centroids' blocks once, and a
vector's distance to a centroid is the sum over blocks of what its codes point at. New centroids come
from how often each cluster has each code, so whole vectors are never put together again.

Chunks are written once to the shared folder and read by every round. A round sends one
row of sums per cluster and task, and the centroids go to the tasks with the job; both are
bounded by clusters times dimensions.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import plain, record
from daybook.session import settle


@dataclass(frozen=True)
class Settings:
    clusters: int = 40
    rounds: int = 5
    dimensions: int = 64
    #: a component x becomes the integer floor(scale * x)
    scale: int = 256
    #: start of the text whose SHA-256 picks the first centroids
    seed: str = "2"
    #: dimensions of a block, and rows of a chunk
    width: int = 2
    chunk: int = 32768


#: Integers below this in size have squared distances over 64 dimensions that fit 64 bits.
_LIMIT = 1 << 27


def usable(vector: Column, dimensions: int) -> Column:
    """Whether a vector has the right number of components, none null or non-finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return F.coalesce((F.size(vector) == dimensions) & finite, F.lit(False))


def integers(values: np.ndarray, settings: Settings) -> np.ndarray:
    scaled = np.floor(settings.scale * values.astype(np.float64))
    if len(scaled) and np.abs(scaled).max() >= _LIMIT:
        raise ValueError(f"a component times {settings.scale} reaches {_LIMIT}; scale the vectors down")
    return scaled.astype(np.int64)


def dictionary(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows of a block, and the number of each row's among them."""
    code = np.zeros(len(block), dtype=np.int64)
    for column in block.T:
        distinct, value = np.unique(column, return_inverse=True)
        code = np.unique(code * len(distinct) + value, return_inverse=True)[1]
    entries = np.empty((int(code.max(initial=-1)) + 1, block.shape[1]), dtype=np.int64)
    entries[code] = block
    return entries, code


class Chunk:
    """Dictionary-encoded vectors: the entries of every block, and codes by block and row."""

    def __init__(self, entries: list[np.ndarray], codes: list[np.ndarray]):
        self.entries, self.codes = entries, codes

    @staticmethod
    def of(vectors: np.ndarray, width: int) -> Chunk:
        coded = [dictionary(vectors[:, at : at + width]) for at in range(0, vectors.shape[1], width)]
        return Chunk([e for e, _ in coded], [c for _, c in coded])

    def nearest(self, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroid of every row and the squared distance; ties go to the smaller number."""
        total = np.zeros((len(self.codes[0]), len(centroids)), dtype=np.int64)
        at = 0
        for entries, codes in zip(self.entries, self.codes, strict=True):
            part = np.zeros((len(entries), len(centroids)), dtype=np.int64)
            for column in entries.T:
                part += (column[:, None] - centroids[:, at]) ** 2
                at += 1
            total += part[codes]
        cluster = total.argmin(axis=1)
        return cluster, total[np.arange(len(total)), cluster]

    def sums(self, cluster: np.ndarray, clusters: int) -> np.ndarray:
        """Componentwise sum of the vectors of every cluster, from counts of codes."""
        parts = []
        for entries, codes in zip(self.entries, self.codes, strict=True):
            often = np.bincount(cluster * len(entries) + codes, minlength=clusters * len(entries))
            parts.append(often.reshape(clusters, len(entries)) @ entries)
        return np.concatenate(parts, axis=1)


CHUNKS = "vec_id array<long>, entries array<binary>, codes array<binary>"
_CHUNKS = pa.schema(
    [("vec_id", pa.list_(pa.int64())), ("entries", pa.list_(pa.binary())), ("codes", pa.list_(pa.binary()))]
)


def _gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    n = 0
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            held.append(batch.slice(at, rows))
            n += held[-1].num_rows
            if n >= rows:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def encode(vectors: DataFrame, settings: Settings) -> DataFrame:
    """Chunks of dictionary-encoded vectors, a row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _gathered(batches, settings.chunk):
            values = table.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            chunk = Chunk.of(integers(values.reshape(-1, settings.dimensions), settings), settings.width)
            entries = [e.astype("<i4").tobytes() for e in chunk.entries]
            codes = [c.astype("<u2" if settings.chunk <= 65536 else "<u4").tobytes() for c in chunk.codes]
            yield record(_CHUNKS, [table.column("vec_id").to_pylist()], [entries], [codes])

    return vectors.mapInArrow(run, CHUNKS)


def _stored(row: dict, settings: Settings) -> Chunk:
    sizes = [min(settings.width, settings.dimensions - at) for at in range(0, settings.dimensions, settings.width)]
    entries = [
        np.frombuffer(e, "<i4").reshape(-1, n).astype(np.int64) for e, n in zip(row["entries"], sizes, strict=True)
    ]
    kind = "<u2" if settings.chunk <= 65536 else "<u4"
    return Chunk(entries, [np.frombuffer(c, kind).astype(np.int64) for c in row["codes"]])


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for at in range(batch.num_rows):
            yield batch.slice(at, 1).to_pylist()[0]


_SUMS = pa.schema([("cluster", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.int64()))])


def round_sums(chunks: DataFrame, centroids: np.ndarray, settings: Settings) -> dict[int, tuple[int, list[int]]]:
    """Number of vectors and componentwise sum of every cluster that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(len(centroids), dtype=np.int64)
        total = np.zeros(centroids.shape, dtype=np.int64)
        for row in _chunks(batches):
            chunk = _stored(row, settings)
            cluster, _ = chunk.nearest(centroids)
            count += np.bincount(cluster, minlength=len(centroids))
            total += chunk.sums(cluster, len(centroids))
        some = np.flatnonzero(count)
        yield record(_SUMS, some.astype(np.int32), count[some], total[some].tolist())

    each = chunks.mapInArrow(run, "cluster int, n long, total array<long>")
    parts = each.select("cluster", "n", F.posexplode("total").alias("dimension", "x"))
    sums = parts.groupBy("cluster", "dimension").agg(F.sum("n").alias("n"), F.sum("x").alias("x"))
    found: dict[int, tuple[int, list[int]]] = {}
    for r in sums.orderBy("cluster", "dimension").collect():  # clusters times dimensions rows
        found.setdefault(r.cluster, (r.n, []))[1].append(r.x)
    return found


_ASSIGNED = pa.schema([("vec_id", pa.int64()), ("cluster", pa.int32()), ("distance", pa.int64())])


def assign(chunks: DataFrame, centroids: np.ndarray, settings: Settings) -> DataFrame:
    """vec_id, cluster and squared distance of every vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _chunks(batches):
            cluster, distance = _stored(row, settings).nearest(centroids)
            yield record(_ASSIGNED, row["vec_id"], cluster.astype(np.int32), distance)

    return chunks.mapInArrow(run, "vec_id long, cluster int, distance long")


def first_centroids(vectors: DataFrame, settings: Settings) -> np.ndarray:
    """The vectors with the smallest hashes of their ids, in that order."""
    text = F.concat(F.lit(settings.seed + ":"), F.col("vec_id").cast("string"))
    hashed = vectors.where("vec_id is not null").withColumn("hash", F.sha2(text, 256))
    rows = hashed.orderBy("hash", "embedding").limit(settings.clusters).collect()
    values = np.array([r.embedding for r in rows], dtype=np.float64)
    return integers(values.reshape(-1, settings.dimensions), settings)


RESULT = (
    "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, "
    "centroid_sha256 string, centroid array<long>"
)


def cluster(vectors: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Cluster the rows of (vec_id, embedding) around ``settings.clusters`` centroids.

    One row per usable vector: vec_id, cluster, distance (squared Euclidean), cluster_inertia
    and inertia (distances summed over its cluster and over all), centroid_sha256 (of
    the centroid's components in decimal, joined by commas), centroid. All arithmetic is
    exact, in integers.

    A vector that is null, has another number of components, or a null or non-finite one is left
    out. Rows that repeat or share a vec_id are vectors of their own; they tie as first centroids, by
    components. A row without a vec_id is clustered but never a first centroid. With fewer vectors
    than clusters there are fewer clusters; without any there are no rows. Equal distances go
    to the smaller number. Other columns are ignored. A component whose integer reaches 2**27 in
    size raises an error, as distances might not fit a long.
    """
    spark = vectors.sparkSession
    named = plain(vectors.withColumn("vec_id", F.col("vec_id").cast("long")), "vec_id", "embedding")
    named = named.where(usable(F.col("embedding"), settings.dimensions))
    centroids = first_centroids(named, settings)
    if not len(centroids):
        return spark.createDataFrame([], RESULT)
    chunks = settle(encode(named, settings), "vector-chunks")
    for _ in range(settings.rounds):
        for number, (n, total) in round_sums(chunks, centroids, settings).items():
            centroids[number] = [x // n for x in total]
    assigned = settle(assign(chunks, centroids, settings), "assigned")
    each = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum"))
    sums = {r["cluster"]: int(r["sum"]) for r in each.collect()}  # a row per cluster
    rows = []
    for k, inertia in sums.items():
        middle = centroids[k].tolist()
        digest = hashlib.sha256(",".join(map(str, middle)).encode()).hexdigest()
        rows.append((k, inertia, sum(sums.values()), digest, middle))
    told = spark.createDataFrame(
        rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string, centroid array<long>"
    )
    # As many rows as clusters, so it goes to every task.
    return assigned.join(F.broadcast(told), "cluster").select(*[c.split()[0] for c in RESULT.split(", ")])
