"""Operators 11 to 13 against brute force, and on awkward tables with values asserted."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from daybook.llm import centroids, level_packing, periodic
from daybook.llm.common import WordTable, ship
from daybook.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
JSON = public_tokenizers.path("byte_bpe_50k.json")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def runs_by_brute_force(w):
    """Every run as (start, length, period), by its definition."""
    found = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


def collapsed(w, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def noisy_repeats(rng, n):
    w = [rng.choice("abcd") for _ in range(n)]
    for _ in range(rng.randint(0, 4)):
        unit = [rng.choice("abcdefgh") for _ in range(rng.randint(1, max(1, n // 5)))]
        at = rng.randint(0, n)
        w[at:at] = (unit * 9)[: rng.randint(0, 6 * len(unit))]
    return w


@pytest.mark.parametrize("lags", [1, 2, 16])
def test_runs_match_brute_force(lags):
    rng = random.Random(lags)
    settings = periodic.Settings(lags=lags)
    texts = [noisy_repeats(rng, rng.randint(0, 90)) for _ in range(400)]
    texts += [noisy_repeats(rng, 900) for _ in range(6)] + [list("ab" * 500), ["x"] * 700, [str(k % 131) for k in range(2000)]]
    table = WordTable([" ".join(w) for w in texts])
    got = defaultdict(list)
    for start, end, q in periodic.runs_of(table, settings).tolist():
        k = int(table.owner[start])
        got[k].append((start - int(table.first[k]), end - start, q))
    for k, w in enumerate(texts):
        assert got[k] == runs_by_brute_force(w)


def test_texts_with_colliding_hashes_are_compared_by_words(monkeypatch):
    monkeypatch.setattr(WordTable, "hashes", lambda self: (self.length % 2).astype(np.uint64))
    rng = random.Random(8)
    texts = [noisy_repeats(rng, 60) for _ in range(40)]
    table = WordTable([" ".join(w) for w in texts])
    got = defaultdict(list)
    for start, end, q in periodic.runs_of(table).tolist():
        k = int(table.owner[start])
        got[k].append((start - int(table.first[k]), end - start, q))
    assert [got[k] for k in range(len(texts))] == [runs_by_brute_force(w) for w in texts]


def test_periodic_query_matches_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    planted = 0
    for r in QUERIES["op11_periodic_runs"](spark, SMALL).collect():
        w = WORD.findall(texts.pop(r.doc_id) or "")
        h = zlib.crc32(str(r.doc_id).encode())
        if h % 10 == 0 and w:
            g = h // 10
            a = g % len(w)
            p = 1 + (len(w) - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(len(w))]
            planted += 1
        runs = runs_by_brute_force(w)
        best = max(runs, key=lambda x: (x[1], -x[0], -x[2]), default=(None,) * 3)
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(w, runs).encode()).hexdigest()
    assert not texts and planted > 5


def test_periodic_runs_of_awkward_tables(spark):
    ship(spark)
    schema = "runs string, doc_id long, text string, n_words int"
    rows = [
        ("x", 1, None, 3), (None, 2, "", None), ("x", 3, " \n\t ", 3), ("x", None, "a a a a a a b", 3),
        ("x", 4, "a a a a a a b", 3), ("x", 4, "a a a a a a b", 3), ("x", 5, "x y " * 20_000, 3),
        ("x", 6, " ".join(str(k % 9001) for k in range(40_000)), 3), ("x", 7, "A a A a A", 3), ("x", 8, "é　é é é é é é\x1c", 3),
    ]
    found = defaultdict(list)
    for r in periodic.find_runs(spark.createDataFrame(rows, schema)).collect():
        found[r.doc_id].append((r.n_words, [tuple(x) for x in r.runs], r.text))
    six = (7, [(0, 6, 1)], "a b")
    assert found[1] == found[2] == found[3] == [(0, [], "")]
    assert found[None] == [six] and found[4] == [six, six]
    assert found[5] == [(40_000, [(0, 40_000, 2)], "x y")]
    assert found[6] == [(40_000, [(0, 40_000, 9001)], " ".join(map(str, range(9001))))]
    assert found[7] == [(5, [], "A a A a A")]
    assert found[8] == [(6, [], "é　é é é é é é\x1c")]
    assert periodic.find_runs(spark.createDataFrame([], schema)).count() == 0


def clusters_by_brute_force(vectors, settings):
    """(vec_id, integers) to cluster, distance and final centroids, in Python integers."""
    order = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in vectors if i is not None)
    middle = [v for _, v in order[: settings.clusters]]

    def nearest(v):
        return min((sum((x - c) ** 2 for x, c in zip(v, m, strict=True)), k) for k, m in enumerate(middle))

    for _ in range(settings.rounds):
        members = defaultdict(list)
        for _, v in vectors:
            members[nearest(v)[1]].append(v)
        for k, held in members.items():
            middle[k] = [sum(x) // len(held) for x in zip(*held, strict=True)]
    return [(i, *nearest(v)[::-1]) for i, v in vectors], middle


@pytest.mark.parametrize(("width", "chunk"), [(1, 7), (2, 32768), (3, 50)])
def test_clusters_match_brute_force(spark, width, chunk):
    ship(spark)
    rng = np.random.default_rng(width)
    base = rng.standard_normal((9, 8))
    values = base[rng.integers(0, 9, 150)] + 0.1 * rng.standard_normal((150, 8))
    rows = [(k, [float(x) for x in v], 0) for k, v in enumerate(values)]
    rows += [(7, rows[7][1], 1), (7, rows[8][1], 1), (None, rows[9][1], None), (200, None, 0), (201, [1.0] * 7, 0)]
    rows += [(202, [1.0] * 7 + [None], 0), (203, [float("nan")] * 8, 0), (204, [float("-inf")] * 8, 0), (205, [0.0] * 8, 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cluster int")
    settings = centroids.Settings(clusters=12, dimensions=8, width=width, chunk=chunk)
    usable = [(i, v) for i, v, _ in rows if v is not None and len(v) == 8 and None not in v and np.isfinite(v).all()]
    usable = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in usable]
    want, middle = clusters_by_brute_force(usable, settings)
    got = centroids.cluster(frame, settings).collect()
    assert Counter((r.vec_id, r.cluster, r.distance) for r in got) == Counter(want)
    for r in got:
        assert r.centroid == middle[r.cluster]
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, middle[r.cluster])).encode()).hexdigest()
        assert r.cluster_inertia == sum(d for _, k, d in want if k == r.cluster)
        assert r.inertia == sum(d for _, _, d in want)


def test_clusters_of_few_none_and_huge_vectors(spark):
    ship(spark)
    schema = "vec_id long, embedding array<float>"
    settings = centroids.Settings(dimensions=2)
    assert centroids.cluster(spark.createDataFrame([], schema), settings).count() == 0
    assert centroids.cluster(spark.createDataFrame([(1, None), (2, [1.0])], schema), settings).count() == 0
    few = centroids.cluster(spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0])], schema), settings).collect()
    assert sorted(r.vec_id for r in few) == [1, 2] and {r.distance for r in few} == {0}
    with pytest.raises(Exception, match="scale the vectors down"):
        centroids.cluster(spark.createDataFrame([(1, [1e30, 0.0])], schema), settings).collect()


def test_dictionaries_lose_nothing():
    rng = np.random.default_rng(0)
    block = rng.integers(-5, 5, (300, 3))
    entries, code = centroids.dictionary(block)
    assert (entries[code] == block).all() and len(entries) == len(np.unique(block, axis=0))


def test_best_level_is_the_least_sum_of_squares():
    rng = random.Random(2)
    for _ in range(2000):
        capacity = rng.randint(2, 20)
        levels = np.array([0] + [rng.choice((0, 0, 1, 2, 3)) for _ in range(capacity - 1)] + [0])
        need = rng.randint(1, capacity - 1)

        def after(h, levels=levels, need=need, capacity=capacity):
            n = levels.copy()
            n[h] -= h > 0
            n[h + need] += h + need < capacity
            return int((n[1:capacity] ** 2).sum())

        open_to = [h for h in range(capacity - need + 1) if h == 0 or levels[h]]
        assert level_packing.best_level(levels, need) == min(open_to, key=lambda h: (after(h), -h))


def test_windows_lose_no_id_and_need_no_padding():
    rng = np.random.default_rng(5)
    for most in (0, 3, 2048):
        windows = level_packing.Windows(level_packing.Settings(tokens=64, open_windows=most))
        docs = [rng.integers(0, 999, rng.integers(1, 200)) for _ in range(300)]
        for k, ids in enumerate(docs):
            windows.add(k, ids)
        windows.finish()
        check_pieces(
            [(p.doc_id, p.start, len(p.ids), p.doc_tokens, n, o, tuple(p.ids)) for p, n, o in windows.closed],
            {k: tuple(x) for k, x in enumerate(docs)}, 64,
        )


def check_pieces(rows, docs, size):
    pieces, windows = defaultdict(list), defaultdict(list)
    for doc_id, start, length, tokens, number, offset, ids in rows:
        pieces[doc_id].append((start, length, ids))
        windows[number].append((offset, length))
        assert tokens == len(docs[doc_id])
    for doc_id, ids in docs.items():
        at = 0
        for start, length, part in sorted(pieces.pop(doc_id)):
            assert start == at and length > 0 and tuple(part) == tuple(ids[at : at + length])
            at += length
        assert at == len(ids)
    assert not pieces
    for held in windows.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at == size or at < size and at & (at - 1) == 0


def test_level_packing_of_the_given_documents(spark):
    coder = Tokenizer.from_file(JSON)
    texts = ship(spark).read.parquet(f"{SMALL}/documents.parquet").collect()
    docs = {r.doc_id: [*coder.encode(r.text or "", add_special_tokens=False).ids, 0] for r in texts}
    rows = QUERIES["op13_level_packing"](spark, SMALL).collect()
    for r in rows:
        part = np.array(docs[r.doc_id][r.start : r.start + r.length], dtype="<u4")
        assert zlib.crc32(part.tobytes()) == r.ids_crc32
    check_pieces(
        [(r.doc_id, r.start, r.length, r.doc_tokens, r.sequence_id, r.offset, docs[r.doc_id][r.start : r.start + r.length]) for r in rows],
        docs, 1024,
    )


def test_level_packing_of_awkward_tables(spark):
    schema = "start int, doc_id long, text string, ids int"
    long = " ".join(f"w{k}" for k in range(30_000))
    rows = [(1, 1, None, 1), (None, 2, "", None), (1, None, "a b", 1), (1, 3, "a b", 1), (1, 3, "a b", 1), (1, 4, long, 1)]
    got = level_packing.pack(ship(spark).createDataFrame(rows, schema).coalesce(1), JSON).collect()
    docs = defaultdict(list)
    for r in sorted(got, key=lambda r: r.start):
        docs[r.doc_id].append((r.start, r.length, r.doc_tokens))
    assert docs[1] == docs[2] == [(0, 1, 1)] and docs[None] == [(0, 3, 3)] and docs[3] == [(0, 3, 3)] * 2
    assert sum(n for _, n, _ in docs[4]) == docs[4][0][2] > 60_000
    totals = Counter()
    for r in got:
        totals[r.sequence_id] += r.length
    assert all(n == 1024 or n & (n - 1) == 0 for n in totals.values())
    assert level_packing.pack(spark.createDataFrame([], schema), JSON).count() == 0
