"""Operator 5: vector best-fit packing of tokenised documents into sequences.

Every piece of a document takes three things from a sequence: tokens, one place for a
document, and attention cost (its length squared). A sequence takes a piece only if
all three remainders allow it; among those that do, the one with the smallest weighted
norm of what would remain is taken, or the one with the largest weighted dot product
of piece and remainder.

Only lengths are packed; tokens never move. Pieces are dealt at random into blocks of
bounded size, each packed on its own, largest first. A block wastes about one sequence
in thousands, so the number of sequences stays close to the least possible.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.bpe import SLICE, json_file
from daybook.llm.common import plain, ragged, record, slices, texts
from daybook.session import settle


@dataclass(frozen=True)
class Limits:
    """What one sequence holds: tokens, documents, and the sum of squared lengths.

    The defaults for the last two never bind before the tokens do.
    """

    tokens: int = 2048
    documents: int = 2048
    attention: int = 2048 * 2048
    #: weights of the three remainders
    weights: tuple[float, float, float] = (1.0, 0.01, 0.01)
    #: "norm": least weighted remainder; "dot": largest weighted dot product
    rule: str = "norm"
    #: pieces packed together in one task
    block: int = 8192


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)


class Tokenizer:
    """Ids of whole texts as the tokenizer file defines them, special strings included."""

    def __init__(self, path: str):
        self.bpe, special = json_file(path)
        self.special = {text.encode(): number for text, number in special.items()}
        longest_first = sorted(self.special, key=len, reverse=True)
        self.apart = re.compile(b"(" + b"|".join(map(re.escape, longest_first)) + b")") if special else None

    def encode(self, batch: list[str] | list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the end of each text among them."""
        batch = [t if isinstance(t, bytes) else t.encode("utf-8", "surrogatepass") for t in batch]
        if self.apart is None or not any(map(self.apart.search, batch)):
            return self.bpe.encode(batch)
        # A text is cut around special strings; between two of them lies what is encoded.
        parts = [self.apart.split(t) for t in batch]
        ids, ends = self.bpe.encode([p for own in parts for p in own[::2]])
        ordinary = iter(np.split(ids, ends[:-1]))
        found, bounds = [], []
        for own in parts:
            for k, part in enumerate(own):
                found.append(np.array([self.special[part]], np.int32) if k % 2 else next(ordinary))
            bounds.append(len(found))
        upto = np.cumsum([len(f) for f in found])
        return np.concatenate(found), upto[np.array(bounds) - 1]


def with_end(coder: Tokenizer, batch: list, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts, ``end_id`` after each, and the bounds of the texts among them."""
    ids, ends = coder.encode(batch)
    return np.insert(ids, ends, end_id).astype("<u4"), np.append(0, ends + np.arange(1, len(ends) + 1))


def pieces(docs: DataFrame, tokenizer: str, end_id: int = 0, tokens: int = 2048) -> DataFrame:
    """Tokenise (doc_id, text) and cut what is longer than ``tokens``; one row per piece.

    A document is its ids and ``end_id``. Cuts leave pieces of exactly ``tokens``, but for
    the first, which has the rest. A null or empty text is ``end_id`` alone.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokenizer_of(tokenizer)
        for part in slices(batches, limit=SLICE):
            ids, bounds = with_end(coder, texts(part), end_id)
            length = np.diff(bounds)
            count = -(-length // tokens)
            owner = np.repeat(np.arange(len(length)), count)
            number = ragged(np.zeros(len(length), np.int64), count)
            first = (length - (count - 1) * tokens)[owner]
            start = np.where(number > 0, first + (number - 1) * tokens, 0)
            size = np.where(number > 0, tokens, first)
            begin = (bounds[:-1][owner] + start) * 4
            raw = memoryview(ids).cast("B")
            crc = [zlib.crc32(raw[a:b]) for a, b in zip(begin.tolist(), (begin + size * 4).tolist(), strict=True)]
            yield record(_PIECES, part.column("doc_id").take(pa.array(owner)), number.astype(np.int32), start, size, crc)

    return plain(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id", "text").mapInArrow(run, PIECES)


_coders: dict[str, Tokenizer] = {}


def tokenizer_of(path: str) -> Tokenizer:
    if path not in _coders:
        _coders.clear()
        _coders[path] = Tokenizer(path)
    return _coders[path]


def best_fit(lengths: np.ndarray, limits: Limits) -> np.ndarray:
    """Sequence number of every piece, the lengths in the order in which they are placed."""
    capacity = np.array([limits.tokens, limits.documents, limits.attention], dtype=np.float64)
    weights = np.array(limits.weights)
    room = np.empty((3, len(lengths)))  # what remains of every open sequence
    number = np.empty(len(lengths), dtype=np.int64)
    opened, active = 0, np.zeros(len(lengths), dtype=np.int64)
    n_active = 0
    least = lengths.min() if len(lengths) else 0
    for k, length in enumerate(lengths.tolist()):
        need = np.array([length, 1, length * length], dtype=np.float64)
        left = room[:, :n_active] - need[:, None]
        fits = (left >= 0).all(axis=0)
        if fits.any():
            if limits.rule == "norm":
                score = ((left / capacity[:, None]) ** 2 * weights[:, None]).sum(axis=0)
                score[~fits] = np.inf
                at = int(score.argmin())
            else:
                score = (need[:, None] * room[:, :n_active] / capacity[:, None] ** 2 * weights[:, None]).sum(axis=0)
                score[~fits] = -np.inf
                at = int(score.argmax())
            room[:, at] = left[:, at]
            number[k] = active[at]
        else:
            at = n_active
            room[:, at] = capacity - need
            active[at] = number[k] = opened
            opened, n_active = opened + 1, n_active + 1
        # A sequence that takes not even the shortest piece is no longer searched.
        if room[0, at] < least or room[1, at] < 1 or room[2, at] < least * least:
            n_active -= 1
            room[:, at], active[at] = room[:, n_active], active[n_active]
    return number


PACKED = PIECES + ", sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer: str, limits: Limits = Limits()) -> DataFrame:
    """Pack all documents (doc_id, text) into sequences of at most ``limits.tokens`` ids.

    One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset. Rows
    with the same doc_id are documents of their own. Null and empty texts are packed as
    their end id; an empty table gives no rows. No piece is dropped: one that no open
    sequence takes opens a new one. A limit that even a lone piece exceeds is an error.
    """
    if limits.documents < 1 or limits.attention < limits.tokens**2:
        raise ValueError("a sequence must have room for one piece of the full length")
    cut = settle(pieces(docs, tokenizer, tokens=limits.tokens), "pieces")
    blocks = max(1, -(-cut.count() // limits.block))

    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(
            ["length", "doc_id", "piece", "ids_crc32"], ascending=[False, True, True, True], kind="stable"
        )
        local = best_fit(group["length"].to_numpy(), limits)
        group = group.assign(sequence_id=(group.pop("block").to_numpy().astype(np.int64) << 32) + local)
        group["offset"] = group.groupby("sequence_id")["length"].cumsum() - group["length"]
        return group

    # Numbers of rows of a written table are the same when a lost task runs again.
    block = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)).cast("long")
    return cut.withColumn("block", block).groupBy("block").applyInPandas(run, PACKED)
