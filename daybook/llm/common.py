"""Helpers that the operators share: slices of batches, word tables, ragged copies."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Separators of words: the space and the code points 9 to 13. Fixed by the contracts.
WORD = r"[^\x20\x09-\x0D]+"

#: Text handled at a time inside a task, so that work arrays stay small however many
#: rows an Arrow batch has. A single longer text is still handled whole.
SLICE_CHARS = 1_000_000


def slices(
    batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_CHARS
) -> Iterator[pa.RecordBatch]:
    """Cut record batches into runs of rows whose texts have about ``limit`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = batch.column(column)
        sizes = np.asarray(pa.compute.fill_null(pa.compute.binary_length(sizes), 0), dtype=np.int64)
        end = np.cumsum(sizes)
        row = 0
        while row < batch.num_rows:
            before = end[row - 1] if row else 0
            stop = max(row + 1, int(np.searchsorted(end, before + limit, "right")))
            yield batch.slice(row, stop - row)
            row = stop


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch; a null is an empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def record(schema: pa.Schema, *columns) -> pa.RecordBatch:
    arrays = [
        c if isinstance(c, pa.Array) else pa.array(c, type=f.type)
        for c, f in zip(columns, schema, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def ragged(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start+1, ... of every run, one run after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def binary_rows(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary column whose row i is the bytes of ``data`` up to ``ends[i]``."""
    offsets = np.zeros(len(ends) + 1, dtype=np.int64)
    offsets[1:] = ends
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(data)]
    ).cast(pa.binary())


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers (the finaliser of splitmix64; fixed values)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class WordTable:
    """The words of several texts as arrays: place, length, text number and hash.

    ``data`` holds every word followed by one space, so words ``i`` to ``j`` of a
    text, joined by one space, are the bytes ``start[i]`` to ``start[j] + length[j]``.
    """

    def __init__(self, batch: list[str] | list[bytes]):
        raw = [t if isinstance(t, bytes) else t.encode("utf-8", "surrogatepass") for t in batch]
        joined = np.frombuffer(b" ".join(raw) + b" ", dtype=np.uint8)
        gap = (joined == 32) | ((joined >= 9) & (joined <= 13))
        step = np.diff(np.concatenate(([True], gap)).view(np.int8))
        begin, end = np.flatnonzero(step == -1), np.flatnonzero(step == 1)
        sizes = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)) + 1
        text_end = np.cumsum(sizes)
        #: number of the text a word is in
        self.owner = np.searchsorted(text_end, begin, "right")
        self.length = end - begin
        keep = ~gap
        keep[end] = True
        kept = joined.copy()
        kept[gap] = 32
        self.data = kept[keep]
        self.start = np.cumsum(self.length + 1) - self.length - 1
        #: first word of every text, and one past the last text's last
        self.first = np.searchsorted(self.owner, np.arange(len(raw) + 1))

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.start, self.start + self.length)

    def kept_texts(self, keep: np.ndarray) -> list[str]:
        """Every text's words that ``keep`` marks, joined by one space."""
        at = np.flatnonzero(keep)
        data = self.data[ragged(self.start[at], self.length[at] + 1)].tobytes()
        ends = np.append(0, np.cumsum(self.length[at] + 1))
        upto = np.searchsorted(at, self.first).tolist()
        return [
            data[ends[lo] : max(ends[hi] - 1, ends[lo])].decode("utf-8", "surrogatepass")
            for lo, hi in zip(upto[:-1], upto[1:], strict=True)
        ]


_BYTE_VALUES = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64)
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: list[np.ndarray] = []


def power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base of span hashes and of its inverse, ``n`` or more."""
    if not _powers or len(_powers[0]) <= n:
        size = max(n + 1, 1 << 20)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            table = np.full(size, base, dtype=np.uint64)
            table[0] = 1
            with np.errstate(over="ignore"):
                table = np.cumprod(table, dtype=np.uint64)
            _powers[k : k + 1] = [table]
    return _powers[0], _powers[1]


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every byte span, by differences of one running polynomial sum."""
    power, inverse = power_table(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_BYTE_VALUES[data] * power[: len(data)], out=sums[1:])
    return mix((sums[end] - sums[start]) * inverse[start])


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values, by doubling."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    reach = 1
    while reach * 2 <= width:
        x = np.minimum(x[:-reach], x[reach:])
        reach *= 2
    return np.minimum(x[:n], x[width - reach : width - reach + n])


def packed_words(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` consecutive hashes; the last ``width - 1`` have none."""
    n = max(0, len(hashes) - width + 1)
    total = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        total *= np.uint64(_BASE)
        total += hashes[k : k + n]
    return mix(total)


def plain(docs: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that extra columns cannot clash with an operator's own."""
    return docs.select(*[docs[n] for n in names])


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package wherever they run; once per session."""
    context = spark.sparkContext
    # Texts are long: small batches keep the memory of workers small.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    if getattr(context, "_daybook_shipped", False):
        return spark
    root = Path(__file__).resolve().parent.parent
    # The driver serves the file to every executor as long as the session lives.
    bundle = Path(tempfile.mkdtemp(prefix="daybook-code-"), "daybook.zip")
    with zipfile.ZipFile(bundle, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(bundle))
    context._daybook_shipped = True
    return spark


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """Text and label of at most ``most`` labelled documents of each class (0 and 1).

    Which ones is decided by a hash of the id, so it depends neither on partitioning nor
    on order. Only the chosen ids, at most ``2 * most`` of them, go to every task.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
    known = known.where("doc_id is not null and label in (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    picked = [known.where(F.col("label") == k).orderBy(*order).limit(most) for k in (0, 1)]
    chosen = picked[0].unionByName(picked[1])
    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), docs["text"])
    return read.join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id"]).select("doc_id", "label", "text")
