"""Operator 13: sum-of-squares online packing.

Documents come one after the other, as the tasks read them, and are packed at once into
windows of a fixed number of tokens. Whole windows are cut off first. What is left of a document goes
to the fill level that leaves the least sum of squared numbers of partially filled windows
per level; an array over the levels holds these numbers. Windows then fill up evenly
instead of piling up at levels that nothing completes.

At the end of a task, or when many windows are open, open windows are closed without padding:
the fullest are completed with pieces cut from the emptiest, and what is left at last is
cut into windows whose lengths are powers of two, which are not padded.

No row is shuffled, and a task holds the ids of its open windows only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.bpe import SLICE
from daybook.llm.common import plain, record, slices, texts
from daybook.llm.packing import tokenizer_of, with_end


@dataclass(frozen=True)
class Settings:
    #: ids of a window
    tokens: int = 1024
    #: open windows of a task beyond which they are completed and closed; bounds its memory
    open_windows: int = 2048


class Piece(NamedTuple):
    doc_id: int | None
    doc_tokens: int
    start: int
    ids: np.ndarray

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return self._replace(ids=self.ids[:at]), self._replace(start=self.start + at, ids=self.ids[at:])


_NEVER = np.iinfo(np.int64).max


def best_level(levels: np.ndarray, need: int) -> int:
    """The level at which a piece of ``need`` ids leaves the least sum of squares.

    ``levels[h]`` is the number of windows filled up to h, with 0 < h < capacity; level 0
    stands for a new window. A window that is full leaves the sum. Ties go to the fullest.
    """
    capacity = len(levels) - 1
    stop = capacity - need + 1
    change = 2 * levels[need:] + 1
    change[-1] = 0
    change[1:] -= 2 * levels[1:stop] - 1
    change[1:][levels[1:stop] == 0] = _NEVER
    return stop - 1 - int(change[::-1].argmin())


class Windows:
    """Packs pieces one after the other; ``closed`` gathers the pieces of closed windows."""

    def __init__(self, settings: Settings, number: int = 0):
        self.settings, self.number = settings, number
        self.levels = np.zeros(settings.tokens + 1, dtype=np.int64)
        self.at_level: list[list[list[Piece]]] = [[] for _ in self.levels]
        self.n_open = 0
        self.closed: list[tuple[Piece, int, int]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        """Pack one document."""
        size = self.settings.tokens
        whole = len(ids) // size * size
        for begin in range(0, whole, size):
            self._close([Piece(doc_id, len(ids), begin, ids[begin : begin + size])])
        if whole == len(ids):
            return
        need = len(ids) - whole
        level = best_level(self.levels, need)
        window = self.at_level[level].pop() if level else []
        self.levels[level] -= level > 0
        self.n_open += level == 0
        # A copy, so that an open window does not hold on to the ids of its whole batch.
        window.append(Piece(doc_id, len(ids), whole, ids[whole:].copy()))
        if level + need == size:
            self._close(window)
            self.n_open -= 1
        else:
            self.levels[level + need] += 1
            self.at_level[level + need].append(window)
        if self.n_open > self.settings.open_windows:
            self.finish()

    def _close(self, window: list[Piece]) -> None:
        offset = 0
        for piece in window:
            self.closed.append((piece, self.number, offset))
            offset += len(piece.ids)
        self.number += 1

    def finish(self) -> None:
        """Close all open windows; none of them is padded."""
        size = self.settings.tokens
        left: list[list[Piece]] = []  # the fullest first
        for level in range(size - 1, 0, -1):
            for window in self.at_level[level]:
                if level & (level - 1):
                    left.append(window)
                else:
                    self._close(window)
        first, last = 0, len(left) - 1
        while first < last:
            room = size - sum(len(p.ids) for p in left[first])
            while room and first < last:
                giver = left[last]
                piece = giver.pop()
                if len(piece.ids) > room:
                    piece, rest = piece.cut(room)
                    giver.append(rest)
                left[first].append(piece)
                room -= len(piece.ids)
                last -= not giver
            if not room:
                self._close(left[first])
                first += 1
        for window in left[first : last + 1]:
            self._close_by_powers(window)
        self.levels[:] = 0
        self.at_level = [[] for _ in self.levels]
        self.n_open = 0

    def _close_by_powers(self, window: list[Piece]) -> None:
        total = sum(len(p.ids) for p in window)
        pieces = window[::-1]
        for bit in range(total.bit_length() - 1, -1, -1):
            room, part = total & (1 << bit), []
            while room:
                piece = pieces.pop()
                if len(piece.ids) > room:
                    piece, rest = piece.cut(room)
                    pieces.append(rest)
                part.append(piece)
                room -= len(piece.ids)
            if part:
                self._close(part)


PACKED = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
_PACKED = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary())]
    + [(c, pa.int64()) for c in ("doc_tokens", "sequence_id", "offset")]
)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 0, settings: Settings = Settings()) -> DataFrame:
    """Pack all documents (doc_id, text) into windows of ``settings.tokens`` ids.

    One row per piece: doc_id, start (ids of its document before it), length, ids (little-endian
    unsigned 32-bit integers), doc_tokens, sequence_id, offset. A document is its ids and
    ``end_id``; a null or empty text is ``end_id`` alone. Rows that repeat, or share or lack
    a doc_id, are documents of their own; other columns are ignored; an empty table gives no rows.
    Every window is full or has a power of two of ids, so none is padded: at most
    eleven windows are short each time that a task closes its open ones.

    Windows do not cross tasks. A sequence_id holds the number of its task, so a task that
    runs again gives the same ones.
    """

    def rows(found: list[tuple[Piece, int, int]]) -> pa.RecordBatch:
        data = np.concatenate([p.ids for p, _, _ in found])
        length = np.fromiter((len(p.ids) for p, _, _ in found), dtype=np.int64, count=len(found))
        bounds = np.append(0, np.cumsum(length) * 4).astype(np.int32)
        ids = pa.BinaryArray.from_buffers(pa.binary(), len(found), [None, pa.py_buffer(bounds), pa.py_buffer(data)])
        rest = ([p.doc_tokens for p, _, _ in found], [n for _, n, _ in found], [o for _, _, o in found])
        return record(_PACKED, [p.doc_id for p, _, _ in found], [p.start for p, _, _ in found], length, ids, *rest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer_of(tokenizer)
        windows = Windows(settings, TaskContext.get().partitionId() << 40)
        for part in slices(batches, limit=SLICE):
            ids, bounds = with_end(coder, texts(part), end_id)
            bounds = bounds.tolist()
            for doc_id, a, b in zip(part.column("doc_id").to_pylist(), bounds[:-1], bounds[1:], strict=True):
                windows.add(doc_id, ids[a:b])
            if windows.closed:
                yield rows(windows.closed)
                windows.closed = []
        windows.finish()
        if windows.closed:
            yield rows(windows.closed)

    named = plain(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id", "text")
    return named.mapInArrow(run, PACKED)
