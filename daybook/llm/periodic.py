"""Operator 11: periodic runs of words, found by multi-scale minimizers.

A run is a stretch of words that repeats with a period and that no neighbouring word
extends. Short periods are found by comparing the words with themselves at every lag. Longer ones
have a scale each: a scale of width w, a power of two, covers the periods over w / 2 and up to
w. Its grams are w words long; the least gram hash of every w / 2 neighbouring grams is a minimizer.

Within a run of such a period q, grams less than q apart differ and grams q apart are equal, so
minimizers repeat at distance q with no equal one between. A run of at least 4 q words
has two full windows that show this. So linking every minimizer with the next equal one of
its text gives a seed of every run, at most one seed a minimizer; binary search over
span hashes extends all seeds side by side. The words of what is found are then compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import WordTable, plain, power_table, ragged, record, sliding_least, slices, texts


@dataclass(frozen=True)
class Settings:
    #: a run has this many words, and this many times its period, at least; four is the least
    words: int = 6
    times: int = 4
    #: longest period found by lag scans; a power of two
    lags: int = 16

    def least(self, period):
        return np.maximum(self.words, self.times * period)


def _lag_scan(x: np.ndarray, owner: np.ndarray, period: int, settings: Settings) -> np.ndarray:
    """Start, end and period of the runs at one lag, in rows."""
    at = np.flatnonzero(x[:-period] == x[period:])
    at = at[owner[at] == owner[at + period]]
    if not len(at):
        return np.zeros((0, 3), np.int64)
    head = np.flatnonzero(np.diff(at, prepend=-2) != 1)
    size = np.diff(np.append(head, len(at))) + period
    start = at[head][size >= settings.least(period)]
    size = size[size >= settings.least(period)]
    return np.stack((start, start + size, np.full(len(start), period)), axis=1)


class _Spans:
    """Hashes of any span of a sequence of word hashes, by differences of one running sum."""

    def __init__(self, x: np.ndarray):
        power, self.inverse = power_table(len(x))
        self.sums = np.zeros(len(x) + 1, dtype=np.uint64)
        np.cumsum(x * power[: len(x)], out=self.sums[1:])

    def __call__(self, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[begin]) * self.inverse[begin]

    def reach(self, a: np.ndarray, b: np.ndarray, most: np.ndarray, step: int) -> np.ndarray:
        """How far the sequence is equal going from ``a`` and from ``b``, ``most`` at best; forwards or backwards."""
        low, high = np.zeros_like(most), most.copy()
        for _ in range(int(most.max(initial=0)).bit_length()):
            middle = (low + high + 1) // 2
            ends = (a, a + middle, b, b + middle) if step > 0 else (a - middle, a, b - middle, b)
            same = self(ends[0], ends[1]) == self(ends[2], ends[3])
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


def seeds(x: np.ndarray, owner: np.ndarray, spans: _Spans, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Place and distance of minimizers and the next equal one, for one scale."""
    n = len(x) - width + 1
    view = width // 2
    if n < view:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.arange(n)
    grams = spans(at, at + width)
    least = sliding_least(grams, view)
    # A gram is a minimizer if it is the least of some window: the greatest of its windows' least.
    edge = np.zeros(view - 1, dtype=np.uint64)
    chosen = np.flatnonzero(~sliding_least(~np.concatenate((edge, least, edge)), view) == grams)
    order = chosen[np.argsort(grams[chosen], kind="stable")]
    a, b = order[:-1], order[1:]
    linked = (grams[a] == grams[b]) & (owner[a] == owner[b]) & (b - a > width // 2) & (b - a <= width)
    return a[linked], (b - a)[linked]


def _scale(x: np.ndarray, owner: np.ndarray, width: int, settings: Settings) -> np.ndarray:
    spans = _Spans(x)
    a, period = seeds(x, owner, spans, width)
    if not len(a):
        return np.zeros((0, 3), np.int64)
    bounds = np.flatnonzero(np.diff(owner, prepend=-1, append=-1))
    low = bounds[np.searchsorted(bounds, a, "right") - 1]
    high = bounds[np.searchsorted(bounds, a, "right")]
    start = a - spans.reach(a, a + period, a - low, -1)
    end = a + period + spans.reach(a, a + period, high - a - period, 1)
    found = np.stack((start, end, period), axis=1)
    return np.unique(found[end - start >= settings.least(period)], axis=0)


def _smallest(found: np.ndarray) -> np.ndarray:
    """Every stretch once with its smallest period, by start and then period."""
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    new = np.ones(len(found), dtype=bool)
    new[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    found = found[new]
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def runs_of(table: WordTable, settings: Settings = Settings()) -> np.ndarray:
    """All runs of all texts of a word table: first word, end and period in rows, by start."""
    x, owner = table.hashes(), table.owner
    size = np.diff(table.first)
    longest = int(size.max(initial=0)) // settings.times
    found = [_lag_scan(x, owner, q, settings) for q in range(1, min(settings.lags, longest) + 1)]
    width = 2 * settings.lags
    while width // 2 < longest:
        # Only texts that are long enough for the scale's least period take part.
        part = np.flatnonzero(size >= settings.times * (width // 2 + 1))
        words = ragged(table.first[part], size[part])
        rows = _scale(x[words], owner[words], width, settings)
        shift = table.first[part] - np.append(0, np.cumsum(size[part])[:-1])
        rows[:, :2] += shift[np.searchsorted(part, owner[words[rows[:, 0]]])][:, None]
        found.append(rows)
        width *= 2
    if not found:
        return np.zeros((0, 3), np.int64)
    runs = _smallest(np.concatenate(found))
    raw = memoryview(table.data)
    begin, end = table.start, table.start + table.length

    def same(start: int, stop: int, q: int) -> bool:
        return raw[begin[start] : end[stop - q - 1]] == raw[begin[start + q] : end[stop - 1]]

    wrong = {int(owner[r[0]]) for r in runs.tolist() if not same(*r)}
    if wrong:  # two words or spans with one hash: these texts are compared word by word at every lag
        runs = runs[~np.isin(owner[runs[:, 0]], list(wrong))]
        runs = _smallest(np.concatenate([runs, *[_by_words(table, k, settings) for k in wrong]]))
    return runs


def _by_words(table: WordTable, text: int, settings: Settings) -> np.ndarray:
    low, high = int(table.first[text]), int(table.first[text + 1])
    raw, numbers = table.data.tobytes(), {}
    words = [raw[s : s + n] for s, n in zip(table.start[low:high].tolist(), table.length[low:high].tolist(), strict=True)]
    x = np.array([numbers.setdefault(w, len(numbers)) for w in words])
    found = [_lag_scan(x, np.zeros_like(x), q, settings) for q in range(1, len(x) // settings.times + 1)]
    found = np.concatenate(found)
    found[:, :2] += low
    return found


RUNS = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, text string"
_RUN = pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])
_RUNS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(_RUN)), ("text", pa.string())])


def find_runs(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The periodic runs of every text of (doc_id, text), and the text without their repetitions.

    A run is a stretch of words with smallest period q (words q apart are identical) and
    at least max(``words``, ``times`` * q) words that no neighbouring word extends keeping the
    period. Columns: doc_id, n_words, runs (start, length, period, in words, by start
    and then period), text (words joined by one space, without each word that some run contains
    after its first q words).

    A null or empty text has no words and no runs and gives an empty text. Each row is judged on
    its own, so repeated rows, shared and null doc_ids give a row each; other columns are ignored;
    an empty table gives no rows. A text is handled whole, whatever its length; nothing is shuffled.
    """
    if settings.times < 4 or settings.lags & (settings.lags - 1):
        raise ValueError("runs need four periods at least, and lags must be a power of two")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            table = WordTable(texts(part))
            runs = runs_of(table, settings)
            text = table.owner[runs[:, 0]] if len(runs) else np.zeros(0, np.int64)
            runs = runs[np.argsort(text, kind="stable")]
            change = np.zeros(len(table) + 1, dtype=np.int64)
            np.add.at(change, runs[:, 0] + runs[:, 2], 1)
            np.add.at(change, runs[:, 1], -1)
            kept = table.kept_texts(np.cumsum(change[:-1]) == 0)
            first = np.append(0, np.cumsum(np.bincount(text, minlength=part.num_rows)))
            columns = (runs[:, 0] - table.first[np.sort(text)], runs[:, 1] - runs[:, 0], runs[:, 2])
            inner = pa.StructArray.from_arrays([pa.array(c) for c in columns], fields=list(_RUN))
            lists = pa.ListArray.from_arrays(pa.array(first, pa.int32()), inner)
            yield record(_RUNS, part.column("doc_id"), np.diff(table.first), lists, kept)

    named = plain(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id", "text")
    return named.mapInArrow(run, RUNS)
