"""Operator 2: toxicity by multiple-instance learning over sentences.

A document is a bag of sentences. A sentence has a toxicity probability from hashed word
and character features; the document's is the noisy-or of its sentences: it is toxic
unless no sentence is. Only documents are labelled, and the gradient of the noisy-or
shares each label out among the sentences. The fitted sentence scores then tell which
sentences offend.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from math import exp, log1p

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import labelled_sample, plain, record, slices, texts

_SENTENCE = re.compile(r"[^.!?\n]+[.!?]*|[.!?]+")
_word = re.compile(r"\w+").findall


@dataclass(frozen=True)
class Settings:
    """Size of the fit. ``sample`` bounds the labelled rows of each class that are read."""

    sample: int = 2500
    #: hashed features; the ones that tell the classes apart best are used
    buckets: int = 1 << 20
    features: int = 4096
    grams: tuple[int, ...] = (4, 5, 6)
    steps: int = 400
    rate: float = 0.1
    l2: float = 2e-4
    #: a document is predicted toxic from this score on
    threshold: float = 0.3


def features_of(word: str, settings: Settings) -> set[int]:
    """Hashed features of a word: itself and its character n-grams, its ends marked."""
    data = f"<{word}>".encode("utf-8", "surrogatepass")
    marked = f"<{word}>"
    found = {zlib.crc32(data) % settings.buckets}
    for n in settings.grams:
        for k in range(len(marked) - n + 1):
            gram = marked[k : k + n].encode("utf-8", "surrogatepass")
            found.add(zlib.crc32(gram, n) % settings.buckets)
    return found


def sentences(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """Start, end and lower-case words of every sentence."""
    for m in _SENTENCE.finditer(text):
        yield m.start(), m.end(), _word(m[0].lower())


def _softplus(z: float) -> float:
    return z + log1p(exp(-z)) if z > 0 else log1p(exp(z))


@dataclass
class Model:
    """Weights of the features that count, and the scores of words seen so far."""

    bias: float
    weights: dict[int, float]
    settings: Settings
    words: dict[str, float] = field(default_factory=dict, repr=False)

    def _word_score(self, word: str) -> float:
        get = self.weights.get
        score = sum(get(f, 0.0) for f in features_of(word, self.settings))
        if len(word) <= 40:
            if len(self.words) > 400_000:
                self.words.clear()
            self.words[word] = score
        return score

    def judge(self, text: str) -> tuple[float, int, int | None, int | None]:
        """Score, number of offending sentences, start and end of the worst one."""
        total, offending, worst = 0.0, 0, (float("-inf"), None, None)
        known, limit = self.words, np.log(self.settings.threshold / (1 - self.settings.threshold))
        for start, end, words in sentences(text):
            z = self.bias
            for w in words:
                s = known.get(w)
                z += self._word_score(w) if s is None else s
            total += _softplus(z)
            if z >= limit:
                offending += 1
                if z > worst[0]:
                    worst = (z, start, end)
        return -float(np.expm1(-total)), offending, worst[1], worst[2]


def fit(batch: list[str], labels: np.ndarray, settings: Settings = Settings()) -> Model:
    """Fit sentence weights to document labels by full-batch steps on the noisy-or's log loss.

    With one class only there is nothing to tell apart and every score is 0 or 1.
    """
    labels = np.asarray(labels, dtype=float)
    if not len(labels) or labels.min() == labels.max():
        return Model(20.0 if len(labels) and labels[0] else -40.0, {}, settings)
    # First pass: in how many documents of each class every feature occurs.
    counts = np.zeros((2, settings.buckets), dtype=np.int32)
    for text, label in zip(batch, labels, strict=True):
        found: set[int] = set()
        for word in {w for _, _, words in sentences(text) for w in words}:
            found |= features_of(word, settings)
        counts[int(label), np.fromiter(found, dtype=np.int64, count=len(found))] += 1
    # Features that tell the classes apart best, by the squared difference of document shares.
    n = np.array([(labels == 0).sum(), (labels == 1).sum()], dtype=float)
    share = counts / n[:, None]
    pooled = counts.sum(axis=0) / n.sum()
    value = (share[1] - share[0]) ** 2 / np.maximum(pooled * (1 - pooled), 1e-12)
    value[counts.sum(axis=0) < 2] = 0
    order = np.lexsort((np.arange(settings.buckets), -value))[: settings.features]
    chosen = order[value[order] > 0]
    place = np.full(settings.buckets, -1, dtype=np.int64)
    place[chosen] = np.arange(len(chosen))

    # Second pass: the chosen features of every sentence. Few words have any.
    known: dict[str, list[int]] = {}
    none: list[int] = []
    owner, row, column = array("q"), array("q"), array("q")
    for k, text in enumerate(batch):
        for _, _, words in sentences(text):
            for word in words:
                if word not in known:
                    places = [int(place[f]) for f in sorted(features_of(word, settings)) if place[f] >= 0]
                    if len(known) > 200_000:
                        known.clear()
                    known[word] = places or none
                if places := known[word]:
                    column.extend(places)
                    row.extend([len(owner)] * len(places))
            owner.append(k)
    owner, row, column = (np.frombuffer(x, dtype=np.int64) if x else np.zeros(0, np.int64) for x in (owner, row, column))
    w, bias = np.zeros(len(chosen) + 1), -5.0
    first, second = np.zeros_like(w), np.zeros_like(w)
    balance = np.where(labels > 0, 0.5 / n[1], 0.5 / n[0])
    w[-1] = bias
    for step in range(1, settings.steps + 1):
        z = np.bincount(row, w[column], len(owner)) + w[-1]
        total = np.bincount(owner, np.logaddexp(0, z), len(labels))
        outer = np.where(labels > 0, -1 / np.maximum(np.expm1(np.minimum(total, 700)), 1e-9), 1.0) * balance
        inner = outer[owner] / (1 + np.exp(-z))
        gradient = np.append(np.bincount(column, inner[row], len(chosen)) + settings.l2 * w[:-1], inner.sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        w -= settings.rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    weights = {int(f): float(x) for f, x in zip(chosen, w[:-1], strict=True) if abs(x) > 1e-3}
    return Model(float(w[-1]), weights, settings)


def held_out(doc_id: Column) -> Column:
    """The fold that labels are never learned from; a null id is not in it."""
    return F.coalesce(F.crc32(doc_id.cast("long").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, settings: Settings = Settings()) -> Model:
    """Fit on labelled rows (doc_id, toxic) outside the held-out fold, a bounded sample of each class."""
    sample = labelled_sample(docs, labels.where(~held_out(labels["doc_id"])), "toxic", settings.sample)
    rows = sample.toPandas().sort_values("doc_id")
    return fit([t or "" for t in rows["text"]], rows["label"].to_numpy(), settings)


SCORED = "doc_id long, score double, predicted int, n_offending long, worst_start long, worst_end long"
_SCORED = pa.schema(
    [("doc_id", pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())]
    + [(c, pa.int64()) for c in ("n_offending", "worst_start", "worst_end")]
)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Score the whole text of every row of (doc_id, text).

    Columns: doc_id, held_out, score (0 to 1), predicted (1 from the threshold on),
    n_offending sentences, worst_start and worst_end (code points of the worst of them;
    null without any). A null or empty text has no sentence and scores 0. Repeated rows
    get equal scores; an empty table gives no rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = model.judge
        for part in slices(batches):
            judged = [judge(t) for t in texts(part)]
            scores = [j[0] for j in judged]
            predicted = [int(s >= model.settings.threshold) for s in scores]
            rest = ([j[k] for j in judged] for k in (1, 2, 3))
            yield record(_SCORED, part.column("doc_id"), scores, predicted, *rest)

    named = plain(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id", "text")
    scored = named.mapInArrow(run, SCORED)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), *scored.columns[1:])


def keep_clean(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, all columns, whose text is not predicted toxic."""

    @F.pandas_udf("boolean")
    def clean(column):
        return column.map(lambda t: model.judge(t or "")[0] < model.settings.threshold)

    return docs.where(clean(F.coalesce("text", F.lit(""))))
