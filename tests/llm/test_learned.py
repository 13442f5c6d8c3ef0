"""The learned operators against brute force and on labels that they did not see."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest

from daybook.llm import quality, toxicity
from daybook.llm.common import ship
from daybook.llm.queries import QUERIES

SMALL, TABLES = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def labelled():
    texts = {r["doc_id"]: r["text"] for r in pq.read_table(f"{TABLES}/documents.parquet").to_pylist()}
    rows = pq.read_table(f"{TABLES}/labels.parquet").to_pylist()
    return [(r["doc_id"], texts[r["doc_id"]] or "", r["toxic"]) for r in rows if r["doc_id"] in texts]


def fold(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4


def test_scores_are_the_noisy_or_of_sentences_and_hold_for_unseen_labels(labelled):
    seen = [(t, y) for d, t, y in labelled if fold(d) != 2]
    model = toxicity.fit([t for t, _ in seen], np.array([y for _, y in seen]))
    right = []
    for doc_id, text, label in labelled:
        if fold(doc_id) != 2:
            continue
        clean, scores = 1.0, []
        for start, end, words in toxicity.sentences(text):
            z = model.bias
            for word in words:
                z += sum(model.weights.get(f, 0.0) for f in toxicity.features_of(word, model.settings))
            scores.append((z, start, end))
            clean *= 1 / (1 + math.exp(z))
        score, offending, start, end = model.judge(text)
        assert score == pytest.approx(1 - clean, abs=1e-9)
        limit = math.log(0.3 / 0.7)
        assert offending == sum(z >= limit for z, _, _ in scores)
        if offending:
            worst = max(z for z, _, _ in scores)
            assert any((a, b) == (start, end) and z == pytest.approx(worst) for z, a, b in scores)
        right.append((score >= 0.3) == bool(label))
    assert len(right) > 20 and np.mean(right) > 0.9


def test_toxic_query_keeps_its_fold_apart(spark):
    rows = QUERIES["op2_toxicity"](spark, SMALL).collect()
    assert all(r.held_out == (fold(r.doc_id) == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def base_of(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[k : k + 5]) for k in range(len(words) - 4)]
    often = Counter(windows)
    repeated = {k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(5)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(repeated),
    )


def test_quality_counts_match_brute_force(spark):
    ship(spark)
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    for r in QUERIES["op6_quality_rules"](spark, SMALL).collect():
        base = base_of(texts.pop(r.doc_id))
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base
        assert r.base_failed == (base[0] < 10 or 100 * base[4] > 20 * base[0])
        assert not (r.base_failed and r.kept)
    assert not texts


def test_quality_verdicts_hold_for_unseen_labels(spark):
    ship(spark)
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    labels = spark.read.parquet(f"{TABLES}/labels.parquet")
    model = quality.train(docs, labels.where("crc32(cast(doc_id as string)) % 4 <> 2"))
    unseen = labels.where("crc32(cast(doc_id as string)) % 4 = 2").select("doc_id", "quality")
    rows = quality.judge(docs, model).join(unseen, "doc_id").collect()
    assert len(rows) > 20 and np.mean([r.kept == bool(r.quality) for r in rows]) > 0.8
