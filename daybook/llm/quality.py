"""Operator 6: quality rules from gradient-boosted trees over document statistics.

Fixed base rules reject very short and very repetitive documents. What they leave is
judged by boosted trees over statistics of the whole text. Splits on chosen features
are monotonic: more repetition or more symbols never raises the score. The trees are
fitted on a bounded sample of labelled rows and flattened into arrays of nodes, which
score whole batches level by level.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import WORD, labelled_sample, plain, record, slices, texts

#: Characters that count as symbols. Fixed value of the contract.
SYMBOLS = "#*$%&|<>"
_words = re.compile(WORD).findall
_GAPS = " \t\n\x0b\x0c\r"
_UPPER = bytes(range(65, 91))
_DIGITS = bytes(range(48, 58))
_MARKS = b".,;:!?'\"()[]{}-_/\\"

#: Features of a document and how the score may change as each grows: -1 never up, 0 freely.
FEATURES = {
    "log_words": 0,
    "word_length": 0,
    "longest_word": 0,
    "symbols_per_word": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "distinct_words": 0,
    "upper_share": -1,
    "digit_share": -1,
    "mark_share": 0,
    "words_per_line": 0,
    "wide_share": 0,
    "top_word_share": 0,
}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeat_words(words: list[str], width: int = 5) -> int:
    """Words covered by windows of ``width`` words that occur twice or more, the first included."""
    windows = list(zip(*(words[k:] for k in range(width)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    counts = Counter(windows)
    total = upto = 0
    for at, window in enumerate(windows):
        if counts[window] > 1:
            total += at + width - max(at, upto)
            upto = at + width
    return total


def statistics(text: str) -> tuple[tuple[int, ...], tuple[float, ...]]:
    """The base counts and the features of one whole text."""
    words = _words(text)
    n, chars = len(words), sum(map(len, words))
    n_symbols = sum(map(text.count, SYMBOLS))
    lines = [line for line in text.split("\n") if line.strip(_GAPS)]
    dup_lines = len(lines) - len(set(lines))
    repeats = repeat_words(words)
    data = text.encode("utf-8", "surrogatepass")
    size = max(len(data), 1)
    counts = Counter(words)
    top = max(counts.values(), default=0)

    def share(chosen: bytes) -> float:
        return (len(data) - len(data.translate(None, chosen))) / size

    some = max(n, 1)
    features = (
        float(np.log1p(n)),
        chars / some,
        float(np.log1p(max(map(len, words), default=0))),
        n_symbols / some,
        dup_lines / max(len(lines), 1),
        repeats / some,
        len(counts) / some,
        share(_UPPER),
        share(_DIGITS),
        share(_MARKS),
        float(np.log1p(n / max(len(lines), 1))),
        (len(data) - len(text)) / size,
        top / some,
    )
    return (n, chars, n_symbols, dup_lines, repeats), features


@dataclass(frozen=True)
class Settings:
    """Size of the fit. ``sample`` bounds the labelled rows of each class that are read."""

    sample: int = 4000
    trees: int = 60
    depth: int = 3
    rate: float = 0.2
    bins: int = 48
    l2: float = 1.0
    least_hessian: float = 1.0
    #: the verdict keeps scores of at least this
    keep: float = 0.5


@dataclass(frozen=True)
class Trees:
    """Boosted trees as flat arrays of nodes; a leaf leads to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of good quality of every row."""
        total = np.full(len(x), self.bias)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                below = x[rows, self.feature[node]] <= self.threshold[node]
                node = np.where(below, self.left[node], self.right[node])
            total += self.value[node]
        return 1 / (1 + np.exp(-total))


def fit_trees(x: np.ndarray, y: np.ndarray, signs: np.ndarray, settings: Settings = Settings()) -> Trees:
    """Boost trees on log loss over histograms; ``signs`` are the monotonic constraints.

    A split on a constrained feature must order its children's values; their midpoint then
    bounds all values further down on either side, so whole trees are monotonic.
    """
    # Both classes weigh the same, whatever their numbers; without both there is nothing to learn.
    n, width = x.shape
    good = float(y.sum())
    columns: dict[str, list] = {k: [] for k in ("feature", "threshold", "left", "right", "value")}
    roots: list[int] = []
    if not n or good in (0.0, float(n)):
        empty = [np.array(v, dtype=float) for v in columns.values()]
        return Trees(*empty, np.array(roots, dtype=np.int64), 0, 20.0 if not n or good else -20.0)
    weight = np.where(y > 0, n / (2 * good), n / (2 * (n - good)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, settings.bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(c, x[:, f], "left") for f, c in enumerate(cuts)], axis=1)
    margin = np.zeros(n)

    def node(value: float) -> int:
        k = len(columns["value"])
        for name, v in (("feature", 0), ("threshold", np.inf), ("left", k), ("right", k), ("value", value)):
            columns[name].append(v)
        return k

    def grow(rows: np.ndarray, g: np.ndarray, h: np.ndarray, low: float, high: float, depth: int) -> int:
        def best_value(gs, hs):
            return np.clip(-gs / (hs + settings.l2), low, high)

        def gain(gs, hs, v):
            return -(gs * v + 0.5 * (hs + settings.l2) * v * v)

        gt, ht = g[rows].sum(), h[rows].sum()
        here = best_value(gt, ht)
        k = node(settings.rate * float(here))
        if depth == settings.depth or ht < 2 * settings.least_hessian:
            return k
        best = (1e-6, 0, 0, 0.0, 0.0)
        for f in range(width):
            size = len(cuts[f]) + 1
            if size == 1:
                continue
            gl = np.cumsum(np.bincount(binned[rows, f], g[rows], size))[:-1]
            hl = np.cumsum(np.bincount(binned[rows, f], h[rows], size))[:-1]
            vl, vr = best_value(gl, hl), best_value(gt - gl, ht - hl)
            won = gain(gl, hl, vl) + gain(gt - gl, ht - hl, vr) - gain(gt, ht, here)
            won[(hl < settings.least_hessian) | (ht - hl < settings.least_hessian)] = -1
            if signs[f]:
                won[signs[f] * (vr - vl) < 0] = -1
            at = int(won.argmax())
            if won[at] > best[0]:
                best = (float(won[at]), f, at, float(vl[at]), float(vr[at]))
        if best[0] <= 1e-6:
            return k
        _, f, at, vl, vr = best
        bounds = [(low, high), (low, high)]
        if signs[f]:
            middle = (vl + vr) / 2
            bounds = [(low, middle), (middle, high)] if signs[f] > 0 else [(middle, high), (low, middle)]
        goes = binned[rows, f] <= at
        columns["feature"][k], columns["threshold"][k] = f, cuts[f][at]
        columns["left"][k] = grow(rows[goes], g, h, *bounds[0], depth + 1)
        columns["right"][k] = grow(rows[~goes], g, h, *bounds[1], depth + 1)
        return k

    trees = Trees(*[np.zeros(0)] * 5, np.zeros(0), settings.depth, 0.0)
    for _ in range(settings.trees):
        p = 1 / (1 + np.exp(-margin))
        first = len(columns["value"])
        roots.append(grow(np.arange(n), weight * (p - y), weight * p * (1 - p), -np.inf, np.inf, 0))
        trees = Trees(
            np.array(columns["feature"], dtype=np.int64),
            np.array(columns["threshold"]),
            np.array(columns["left"], dtype=np.int64),
            np.array(columns["right"], dtype=np.int64),
            np.array(columns["value"]),
            np.array(roots, dtype=np.int64),
            settings.depth,
            0.0,
        )
        at = np.full(n, first)
        for _ in range(settings.depth):
            below = x[np.arange(n), trees.feature[at]] <= trees.threshold[at]
            at = np.where(below, trees.left[at], trees.right[at])
        margin += trees.value[at]
    return trees


_STATS = pa.schema([("label", pa.int32()), ("features", pa.list_(pa.float64()))])


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Trees:
    """Fit on at most ``settings.sample`` labelled rows of each class, chosen by a hash of the id.

    Labels are read from ``labels`` (doc_id, quality). Without both classes every document
    gets the one that there is; without labels all are good.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            yield record(_STATS, part.column("label"), [statistics(t)[1] for t in texts(part)])

    sample = labelled_sample(docs, labels, "quality", settings.sample)
    rows = sample.mapInArrow(run, "label int, features array<double>").toPandas()
    x = np.array(rows["features"].tolist(), dtype=float).reshape(len(rows), len(FEATURES))
    order = np.lexsort((*x.T, rows["label"].to_numpy()))  # the fit does not depend on task order
    signs = np.array(list(FEATURES.values()))
    return fit_trees(x[order], rows["label"].to_numpy(dtype=float)[order], signs, settings)


JUDGED = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean, score double"
)
_JUDGED = pa.schema(
    [("doc_id", pa.int64()), *[(c, pa.int64()) for c in BASE]]
    + [("base_failed", pa.bool_()), ("kept", pa.bool_()), ("score", pa.float64())]
)


def judge(docs: DataFrame, trees: Trees, settings: Settings = Settings()) -> DataFrame:
    """Base counts and verdict for every row of (doc_id, text), over whole texts.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept (not base_failed and score >= ``settings.keep``), score. A null or
    empty text has no words and fails the base. Rows are judged alone, so repeated rows get
    equal verdicts; an empty table gives no rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            counted = [statistics(t) for t in texts(part)]
            base = np.array([c[0] for c in counted], dtype=np.int64)
            score = trees.score(np.array([c[1] for c in counted]))
            failed = (base[:, 0] < 10) | (100 * base[:, 4] > 20 * base[:, 0])
            kept = ~failed & (score >= settings.keep)
            yield record(_JUDGED, part.column("doc_id"), *base.T, failed, kept, score)

    return plain(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id", "text").mapInArrow(run, JUDGED)
