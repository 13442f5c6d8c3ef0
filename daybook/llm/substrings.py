"""Operator 1: substring deduplication by super-k-mers of words.

A window is k consecutive words. Every window has a minimiser, the least hash among its
short word groups. Consecutive windows with the same minimiser overlap in all but a few
words, so they travel together, as one string, to the bucket of their minimiser; equal
windows always meet there. Each bucket sorts its windows and learns the smallest document
of each. Strings that one task sees several times travel once, with the places that they
stand for, and blocks travel compressed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import WordTable, packed_words, ragged, record, sliding_least, slices, span_hashes, texts
from daybook.session import settle


@dataclass(frozen=True)
class Settings:
    window: int = 13
    #: words whose joint hash may be a window's minimiser
    group: int = 2
    #: bytes of strings that a bucket holds on average
    bucket_bytes: int = 1_500_000
    #: bytes of strings that a task gathers before it sends blocks
    flush_bytes: int = 24_000_000


def super_kmers(table: WordTable, settings: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, number of windows and minimiser of every run of windows that travels together."""
    k = settings.window
    groups = packed_words(table.hashes(), settings.group)
    least = sliding_least(groups, k - settings.group + 1)
    at = np.flatnonzero(table.owner[: len(least)] == table.owner[k - 1 :]) if len(least) else np.zeros(0, np.int64)
    if not len(at):
        return at, at, least[at]
    new = np.ones(len(at), dtype=bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (least[at[1:]] != least[at[:-1]]) | (table.owner[at[1:]] != table.owner[at[:-1]])
    first = np.flatnonzero(new)
    return at[first], np.diff(np.append(first, len(at))), least[at[first]]


_ROW = np.dtype([("doc_id", "<i8"), ("tag", "<i8"), ("start", "<u4")])
_SENT = pa.schema([("bucket", pa.int64()), ("block", pa.binary())])


class _Sender:
    """Gathers super-k-mers and packs them into one compressed block per bucket."""

    def __init__(self, settings: Settings, buckets: int):
        self.settings, self.buckets = settings, buckets
        self.zip = zstandard.ZstdCompressor(level=1)
        self._clear()

    def _clear(self) -> None:
        self.parts: list[tuple] = []
        self.size = 0

    def add(self, table: WordTable, doc_id: np.ndarray, tag: np.ndarray) -> Iterator[pa.RecordBatch]:
        word, windows, least = super_kmers(table, self.settings)
        if len(word):
            last = word + windows + self.settings.window - 2
            begin, end = table.start[word], table.start[last] + table.length[last]
            rows = np.empty(len(word), dtype=_ROW)
            owner = table.owner[word]
            rows["doc_id"], rows["tag"] = doc_id[owner], tag[owner]
            rows["start"] = word - table.first[owner]
            bucket = (least % np.uint64(self.buckets)).astype(np.int64)
            hashes = span_hashes(table.data, begin, end)
            self.parts.append((table.data, begin, end, bucket, hashes, rows))
            self.size += int((end - begin).sum())
        if self.size >= self.settings.flush_bytes:
            yield self.flush()

    def flush(self) -> pa.RecordBatch:
        if not self.parts:
            return record(_SENT, [], [])
        shift = np.cumsum([0, *(len(p[0]) for p in self.parts)])[:-1]
        data = np.concatenate([p[0] for p in self.parts])
        begin = np.concatenate([p[1] + s for p, s in zip(self.parts, shift, strict=True)])
        end = np.concatenate([p[2] + s for p, s in zip(self.parts, shift, strict=True)])
        bucket, hashes, rows = (np.concatenate([p[k] for p in self.parts]) for k in (3, 4, 5))
        self._clear()
        order = np.lexsort((rows["start"], rows["doc_id"], hashes, bucket))
        begin, end, bucket, hashes, rows = begin[order], end[order], bucket[order], hashes[order], rows[order]
        new = np.ones(len(begin), dtype=bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (bucket[1:] != bucket[:-1])
        raw = data.tobytes()
        for k in np.flatnonzero(~new).tolist():  # equal hashes stand for equal strings only if they are
            new[k] = raw[begin[k] : end[k]] != raw[begin[k - 1] : end[k - 1]]
        first = np.flatnonzero(new)
        counts = np.diff(np.append(first, len(new))).astype("<u4")
        edges = np.flatnonzero(np.diff(bucket[first], prepend=-1, append=-1))
        strings = [raw[a:b] for a, b in zip(begin[first].tolist(), end[first].tolist(), strict=True)]
        row_of = np.append(first, len(new))
        numbers, blocks = [], []
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            refs = rows[row_of[lo] : row_of[hi]]
            parts = [
                np.array([hi - lo, len(refs)], dtype="<u4"),
                counts[lo:hi],
                np.diff(refs["doc_id"], prepend=0),
                refs["tag"],
                refs["start"],
            ]
            packed = [np.ascontiguousarray(p).tobytes() for p in parts]
            numbers.append(int(bucket[first[lo]]))
            blocks.append(self.zip.compress(b"".join((*packed, b"\n".join(strings[lo:hi])))))
        return record(_SENT, numbers, blocks)


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
    """The blocks of every bucket, from batches sorted by bucket."""
    held: list[bytes] = []
    last = None
    for batch in batches:
        number = batch.column("bucket").to_numpy()
        blocks = batch.column("block").to_pylist()
        edges = np.flatnonzero(np.diff(number, prepend=number[:1] - 1)).tolist() if len(number) else []
        for lo, hi in zip(edges, [*edges[1:], len(number)], strict=True):
            if held and number[lo] != last:
                yield held
                held = []
            last = number[lo]
            held += blocks[lo:hi]
    if held:
        yield held


def _unpack(blocks: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Strings, the number of places of each, and the places."""
    strings, counts, rows = [], [], []
    unzip = zstandard.ZstdDecompressor()
    for block in blocks:
        raw = unzip.decompress(block)
        n, m = np.frombuffer(raw, "<u4", 2).tolist()
        at = 8
        counts.append(np.frombuffer(raw, "<u4", n, at).astype(np.int64))
        at += 4 * n
        part = np.empty(m, dtype=_ROW)
        part["doc_id"] = np.cumsum(np.frombuffer(raw, "<i8", m, at))
        part["tag"] = np.frombuffer(raw, "<i8", m, at + 8 * m)
        part["start"] = np.frombuffer(raw, "<u4", m, at + 16 * m)
        rows.append(part)
        strings += raw[at + 20 * m :].split(b"\n")
    return strings, np.concatenate(counts), np.concatenate(rows)


def _earlier_windows(blocks: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places (rows of _ROW), first word and end of the runs of windows that an earlier document has."""
    strings, counts, rows = _unpack(blocks)
    table = WordTable(strings)
    hashes = packed_words(table.hashes(), k)
    at = np.flatnonzero(table.owner[: len(hashes)] == table.owner[k - 1 :])
    owner = table.owner[at]
    place = np.cumsum(counts) - counts
    least_of = np.minimum.reduceat(rows["doc_id"], place)
    order = np.argsort(hashes[at], kind="stable")
    ranked = hashes[at][order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = ranked[1:] != ranked[:-1]
    begin, end = table.start[at], table.start[at + k - 1] + table.length[at + k - 1]
    raw = table.data.tobytes()
    group = np.cumsum(new) - 1
    sorted_begin, sorted_end = begin[order], end[order]
    lead = np.flatnonzero(new)[group]
    extra = len(lead)
    by_bytes: dict[tuple[int, bytes], int] = {}
    for j in np.flatnonzero(~new).tolist():
        i = lead[j]
        own = raw[sorted_begin[j] : sorted_end[j]]
        if own != raw[sorted_begin[i] : sorted_end[i]]:  # same hash, other words
            group[j] = by_bytes.setdefault((int(group[j]), own), extra)
            extra = max(extra, int(group[j]) + 1)
    least = np.full(extra, np.iinfo(np.int64).max)
    np.minimum.at(least, group, least_of[owner[order]])
    earliest = np.empty(len(at), dtype=np.int64)
    earliest[order] = least[group]
    # Every place of a string against every window of the string.
    per_string = np.bincount(owner, minlength=len(strings))
    first_window = np.cumsum(per_string) - per_string
    string_of = np.repeat(np.arange(len(strings)), counts)
    # A string whose windows are all of no earlier document than its own least needs no more work.
    low = np.minimum.reduceat(earliest, first_window) if len(at) else np.zeros(0, np.int64)
    some = np.flatnonzero(low[string_of] < rows["doc_id"])
    times = per_string[string_of[some]]
    row = np.repeat(some, times)
    window = ragged(first_window[string_of[some]], times)
    hit = earliest[window] < rows["doc_id"][row]
    row, window = row[hit], window[hit]
    run = np.ones(len(row), dtype=bool)
    run[1:] = (row[1:] != row[:-1]) | (window[1:] != window[:-1] + 1)
    head = np.flatnonzero(run)
    length = np.diff(np.append(head, len(row)))
    offset = window[head] - first_window[string_of[row[head]]]
    found = rows[row[head]]
    start = found["start"].astype(np.int64) + offset
    return found, start, start + length + k - 1


def _tagged(docs: DataFrame, same_ids: bool) -> DataFrame:
    tag = F.xxhash64(docs["text"]) if same_ids else F.lit(0).cast("long")
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"], tag.alias("tag"))


def repeated_spans(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Spans of words covered by windows that also start in a document with a smaller id.

    Columns: doc_id, tag, spans (array of begin and end word; they may overlap). ``tag`` is 0
    unless doc_ids repeat; then it is the text's hash, which keeps their rows apart.
    """
    size = docs.agg(F.sum(F.octet_length("text")), F.count("*"), F.count_distinct("doc_id"), F.count("doc_id")).first()
    return _spans(_tagged(docs, size[2] < size[3]), size[0] or 0, settings)


def _spans(tagged: DataFrame, total: int, settings: Settings) -> DataFrame:
    k = settings.window
    # A string has about (k + 1) / 2 windows and k - 1 words more.
    buckets = max(16, int(3 * total / settings.bucket_bytes))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sender = _Sender(settings, buckets)
        for part in slices(batches, limit=500_000):
            doc_id, tag = (part.column(c).to_numpy() for c in ("doc_id", "tag"))
            yield from sender.add(WordTable(texts(part)), doc_id, tag)
        yield sender.flush()

    schema = pa.schema([("doc_id", pa.int64()), ("tag", pa.int64()), ("begin", pa.int32()), ("end", pa.int32())])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for blocks in _buckets(batches):
            found, begin, end = _earlier_windows(blocks, k)
            yield record(schema, found["doc_id"].copy(), found["tag"].copy(), begin, end)

    sent = tagged.where("doc_id is not null and text is not null").mapInArrow(send, "bucket long, block binary")
    found = sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        meet, "doc_id long, tag long, begin int, end int"
    )
    return found.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))


_LEFT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("text", pa.string())])


def remove_repeats(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Every row of (doc_id, text) without the words that repeat an earlier document.

    A word goes if a window of ``settings.window`` words of its document covers it and the same
    words also start a window in a document with a smaller doc_id. Columns: doc_id, n_words,
    n_removed, text (the words kept, joined by one space). A null or empty text has no words. Windows
    do not cross documents, so short texts stay whole. Rows that share a doc_id do not remove
    each other's words; a null doc_id neither removes nor loses any. Other columns are ignored;
    an empty table gives no rows.
    """
    size = docs.agg(F.sum(F.octet_length("text")), F.count("*"), F.count_distinct("doc_id"), F.count("doc_id")).first()
    tagged = _tagged(docs, size[2] < size[3])
    spans = settle(_spans(tagged, size[0] or 0, settings), "repeated-spans")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            table = WordTable(texts(part))
            lists = part.column("spans")
            inner = lists.flatten()
            counts = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(lists), 0), dtype=np.int64)
            base = np.repeat(table.first[:-1], counts)
            change = np.zeros(len(table) + 1, dtype=np.int64)
            np.add.at(change, base + inner.field("begin").to_numpy(), 1)
            np.add.at(change, base + inner.field("end").to_numpy(), -1)
            keep = np.cumsum(change[:-1]) == 0
            kept = table.kept_texts(keep)
            n_words = np.diff(table.first)
            upto = np.append(0, np.cumsum(~keep))[table.first]
            yield record(_LEFT, part.column("doc_id"), n_words, np.diff(upto), kept)

    return tagged.join(spans.hint("merge"), ["doc_id", "tag"], "left").mapInArrow(
        cut, "doc_id long, n_words long, n_removed long, text string"
    )
