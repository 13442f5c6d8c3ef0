"""Every operator against brute force or an exact round trip, and on awkward tables."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from daybook.llm import (
    bpe,
    embeddings,
    lines,
    minhash,
    packing,
    quality,
    secrets,
    sharding,
    substrings,
    toxicity,
)
from daybook.llm.common import ship
from daybook.llm.graph import components

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
LONG = " ".join(f"w{i % 977} x{i}" for i in range(20_000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept boolean, uid long"


@pytest.fixture(scope="module")
def docs(spark):
    return ship(spark).read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="module")
def texts(docs):
    return sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())


@pytest.fixture(scope="module")
def awkward(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, clashing columns."""
    run = " ".join(f"t{i}" for i in range(40))
    rows = [
        (1, run, "en", "a", 1, True, 9), (1, run, "en", "a", 1, True, 9), (1, run + " other", None, None, None, None, None),
        (2, None, "en", "a", 0, True, 9), (3, "", "de", "b", 0, True, 9), (4, " \n\t ", "de", "b", 0, True, 9),
        (None, run, "en", "a", 1, False, 1), (None, None, None, None, None, None, None),
        (5, LONG, "en", "a", 9, True, 9), (6, LONG, "en", "a", 9, True, 9), (7, "short", "fr", "c", 5, False, 2),
        (8, "short", "fr", "c", 5, False, 2), (9, "é ſ 中 😀\x1c'll 　 x", "fr", "c", 5, False, 2),
    ]
    return ship(spark).createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def nothing(spark):
    return ship(spark).createDataFrame([], SCHEMA)


def every(spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    return {
        "op1": substrings.remove_repeats,
        "op2": lambda d: toxicity.score(d, toxicity.train(d, labels)),
        "op4": minhash.near_duplicates,
        "op5": lambda d: packing.pack(d, JSON),
        "op6": lambda d: quality.judge(d, quality.train(d, labels)),
        "op7": lambda d: bpe.round_trip(d, RANKS),
        "op8": lambda d: secrets.digest(secrets.scan(d)),
        "op9": lines.remove_lines,
        "op10": sharding.shard,
    }


@pytest.mark.parametrize("name", ["op1", "op2", "op4", "op5", "op6", "op7", "op8", "op9", "op10"])
def test_awkward_tables(spark, awkward, nothing, name):
    run = every(spark)[name]
    got = run(awkward).count()
    assert got >= awkward.count() if name == "op5" else got == awkward.count()
    assert run(nothing).count() == 0


def test_substrings_match_brute_force(docs, texts):
    first, words = {}, {i: WORD.findall(t or "") for i, t in texts}
    for i, w in words.items():
        for j in range(len(w) - 12):
            first.setdefault(tuple(w[j : j + 13]), i)
    for r in substrings.remove_repeats(docs).collect():
        w = words[r.doc_id]
        keep = [True] * len(w)
        for j in range(len(w) - 12):
            if first[tuple(w[j : j + 13])] < r.doc_id:
                keep[j : j + 13] = [False] * 13
        left = " ".join(x for x, k in zip(w, keep, strict=True) if k)
        assert (r.n_words, r.n_removed, r.text) == (len(w), keep.count(False), left)


def test_toxicity_finds_held_out_sentences():
    rng = random.Random(5)
    plain = [f"word{i}" for i in range(60)]

    def text(bad):
        bag = [" ".join(rng.choices(plain, k=9)) for _ in range(8)]
        if bad:
            bag[3] += " scoundrel"
        return ". ".join(bag) + "."

    labels = np.array([k % 2 for k in range(200)])
    model = toxicity.fit([text(y) for y in labels], labels)
    for y in labels[:40]:
        t = text(y)
        score, offending, start, end = model.judge(t)
        assert (score >= 0.3) == bool(y) and 0 <= score <= 1
        assert offending == y and (not y or "scoundrel" in t[start:end])
    assert model.judge("") == (0.0, 0, None, None)


def test_embeddings_match_brute_force(spark):
    ship(spark)
    rng = np.random.default_rng(3)
    base = rng.standard_normal((80, 16))
    rows = [*base, *(base[:40] + 0.05 * rng.standard_normal((40, 16))), *base[:5], *base[:5] * 3]
    rows = [[float(x) for x in r] for r in rows] + [None, [0.0] * 16, [None] * 16, [float("nan")] * 16, [1.0], [2.0]]
    frame = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embeddings.near_duplicates(frame).collect()}
    label, links = list(range(len(rows))), Counter()

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = embeddings._valid(rows[i]), embeddings._valid(rows[j])
            if a is not None and b is not None and len(a) == len(b):
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.95:
                    links[i] += 1
                    links[j] += 1
                    x, y = root(i), root(j)
                    label[max(x, y)] = min(x, y)
    assert got == {i: (links[i], root(i), root(i) == i) for i in range(len(rows))}


def test_dart_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(1)
    element = rng.integers(0, 2**63, 400, dtype=np.uint64)
    a = rng.integers(1, 6, 400).astype(float)
    b = np.where(rng.random(400) < 0.8, a, rng.integers(1, 6, 400)).astype(float)
    signs = minhash.dart_signatures(np.repeat([0, 1], 400), np.tile(element, 2), np.append(a, b), 2, 4000)
    assert (signs[0] == signs[1]).mean() == pytest.approx(np.minimum(a, b).sum() / np.maximum(a, b).sum(), abs=0.03)


def test_near_duplicates_match_brute_force(docs, texts):
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs).collect()}
    shingles = [minhash.shingle_counts(t or "", 5) for _, t in texts]
    label, seen = list(range(len(texts))), defaultdict(list)

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, own in enumerate(shingles):
        common = Counter()
        for s, n in own.items():
            for j, m in seen[s]:
                common[j] += min(n, m)
            seen[s].append((i, n))
        for j, n in common.items():
            if n / (own.total() + shingles[j].total() - n) >= 0.8:
                x, y = root(i), root(j)
                label[max(x, y)] = min(x, y)
    assert got == {d: texts[root(i)][0] for i, (d, _) in enumerate(texts)}


def test_near_duplicates_link_repeated_rows_and_null_ids(spark):
    words = [f"w{k}" for k in range(200)]
    near = [*words[:100], "other", *words[101:]]
    rows = [(0, words), (0, words), (None, near), (None, near), (7, words[::-1])]
    rows = [(doc_id, " ".join(w)) for doc_id, w in rows]
    made = spark.createDataFrame(rows, "doc_id long, text string")
    got = minhash.near_duplicates(made).collect()
    assert sorted((r.class_id, r.doc_id is None, r.kept) for r in got) == [
        (0, False, False), (0, False, True), (0, True, False), (0, True, False), (7, False, True)
    ]


def test_packing_ids_places_and_number(docs, texts):
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(JSON)
    rows = packing.pack(docs, JSON).collect()
    found = {(r.doc_id, r.piece): (r.start, r.length, r.ids_crc32) for r in rows}
    for doc_id, text in texts:
        ids = np.array([*coder.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4")
        begin, stop = 0, len(ids) - (len(ids) - 1) // 2048 * 2048
        for piece in range((len(ids) - 1) // 2048 + 1):
            part = ids[begin:stop]
            assert found.pop((doc_id, piece)) == (begin, len(part), zlib.crc32(part.tobytes()))
            begin, stop = stop, stop + 2048
    assert not found
    bins = defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(bins) <= 1.01 * sum(r.length for r in rows) / 2048 + 1


def test_packing_keeps_every_limit():
    lengths = np.sort(np.random.default_rng(2).integers(1, 500, 400))[::-1]
    for rule in ("norm", "dot"):
        limits = packing.Limits(tokens=1000, documents=4, attention=1000 * 1000, rule=rule)
        number = packing.best_fit(lengths, limits)
        for k in np.unique(number):
            held = lengths[number == k]
            assert held.sum() <= 1000 and len(held) <= 4 and (held**2).sum() <= 1000**2


def test_special_strings_are_tokenised_as_the_library_does():
    from tokenizers import Tokenizer

    text = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>x", "plain\u0085 text\x1c ok  two"]
    want = [Tokenizer.from_file(JSON).encode(t, add_special_tokens=False).ids for t in text]
    ids, ends = packing.Tokenizer(JSON).encode(text)
    assert [list(x) for x in np.split(ids, ends[:-1])] == want


def test_trees_are_monotonic():
    rng = np.random.default_rng(4)
    x = rng.random((2000, 3))
    y = (x[:, 0] + 0.4 * rng.standard_normal(2000) > 0.5).astype(float)
    trees = quality.fit_trees(x, y, np.array([1, -1, 0]))
    grid = np.linspace(0, 1, 60)
    for column, sign in ((0, 1), (1, -1)):
        probe = np.repeat(rng.random((20, 1, 3)), 60, axis=1)
        probe[:, :, column] = grid
        steps = np.diff(trees.score(probe.reshape(-1, 3)).reshape(20, 60), axis=1)
        assert (sign * steps >= -1e-12).all()


def test_repeat_words():
    rng = random.Random(1)
    for _ in range(300):
        w = rng.choices("ab", k=rng.randint(0, 24))
        windows = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
        marked = {k + j for k, x in enumerate(windows) if windows.count(x) > 1 for j in range(5)}
        assert quality.repeat_words(w) == len(marked)


def test_bpe_matches_tiktoken(docs, texts):
    ranks = bpe.rank_file(RANKS)
    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    coder = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
    rng = random.Random(1)
    parts = [" ", "  ", "\n", "\t", "a", "s", "t", "'", "'s", "'re", "'ve", "'ll", "e", "1", "²", "é", "中", "😀", ".",
             "\xa0", "　", "don't", "\x1c", "́", "''", "'r", "_", "X"]
    batch = ["".join(rng.choices(parts, k=rng.randint(0, 25))) for _ in range(3000)] + ["", "a" * 3000, " " * 99]
    ids, ends = ranks.encode(batch)
    for text, part in zip(batch, np.split(ids, ends[:-1]), strict=True):
        assert list(part) == coder.encode_ordinary(text)
    want = dict(texts)
    for r in bpe.round_trip(docs, RANKS).collect():
        expected = np.array(coder.encode_ordinary(want[r.doc_id] or ""), dtype="<u4")
        assert r.n_tokens == len(expected)
        assert r.ids_sha256 == hashlib.sha256(expected.tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((want[r.doc_id] or "").encode()).hexdigest()


ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)


def test_secrets_match_regular_expressions():
    find = secrets.scanner(secrets.RULES)
    rng = random.Random(3)
    parts = ["password", "PassWd", "secret", "token", "api_key", "APIKEY", '"', "'", " ", ":", "=", "abcdefgh",
             "0123456789abcdef", "AKIA", "AKIAABCDEFGH", "XYZ01234", "é", "ſecret", "\n", "-", "ghp_", "xoxb-", "eyJ",
             "abcdefghij0123456789", ".", "-----BEGIN ", "RSA ", "PRIVATE KEY-----"]
    for _ in range(6000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 16)))
        want = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
        want += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
        want += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
        for k, rule in enumerate(secrets.RULES[3:], 3):
            want += [(m.start(), k, m.end()) for m in re.finditer(rule.pattern, text)]
        assert find.spans(text) == sorted(want)


def test_secrets_of_very_long_texts_take_linear_time():
    find = secrets.scanner(secrets.RULES)
    text = "eyJabcdefgh" * 90_000
    assert find.spans(text) == []
    assert find.spans(text + "." + "x" * 9 + "." + "y" * 9) == [(0, 6, len(text) + 20)]


def test_lines_match_brute_force(spark):
    ship(spark)
    rng = random.Random(4)
    parts = ["a", "b c", "d", "e f g", "h", "", "  ", "i j k l m n", "o"]
    docs = [(i, "\n".join(rng.choices(parts, k=rng.randint(0, 12)))) for i in range(200)]
    first, runs = {}, []
    for i, text in docs:
        own = [(n, x, len(WORD.findall(x))) for n, x in enumerate(text.split("\n")) if WORD.search(x)]
        for a in range(len(own)):
            for b in range(a, len(own)):
                if sum(x[2] for x in own[a : b + 1]) >= 5:
                    key = tuple(x[1] for x in own[a : b + 1])
                    first.setdefault(key, (i, own[a][0]))
                    runs.append((key, i, own[a][0], [x[0] for x in own[a : b + 1]]))
    gone = defaultdict(set)
    for key, i, at, numbers in runs:
        if first[key] < (i, at):
            gone[i].update(numbers)
    for r in lines.remove_lines(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        kept = [x for n, x in enumerate(docs[r.doc_id][1].split("\n")) if n not in gone[r.doc_id]]
        assert (r.n_removed, r.text) == (len(gone[r.doc_id]), "\n".join(kept))


def test_hilbert_curve_visits_neighbours():
    points = np.array(np.meshgrid(*[np.arange(8)] * 3)).reshape(3, -1)
    index = sharding.hilbert_index(points, 3)
    assert sorted(index) == list(range(512))
    assert (np.abs(np.diff(points[:, np.argsort(index)], axis=1)).sum(axis=0) == 1).all()


def test_shards_are_even_and_gapless(docs):
    rows = sharding.shard(docs).groupBy("shard").agg(
        F.count("*").alias("n"), F.max("slot").alias("top"), F.count_distinct("slot").alias("d")
    ).collect()
    sizes = [r.n for r in rows]
    assert len(rows) == 24 and max(sizes) - min(sizes) <= 1
    assert all(r.n == r.d == r.top + 1 for r in rows)


def test_shards_match_brute_force(spark):
    ship(spark)
    rng = random.Random(6)
    rows = [
        (k, rng.choice(["same text", "other", None, "", f"own {k}", f"own {k}"]), rng.choice(["en", "de", None]),
         "https://example.org/" + rng.choice("abcdef"), k)
        for k in range(400)
    ]
    rows += rows[:5]
    got = sharding.shard(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, shard int"))
    got = got.collect()
    texts = {k: t for k, t, *_ in rows}
    assert Counter(r.doc_id for r in got) == Counter(k for k, *_ in rows)
    slots, places = defaultdict(list), defaultdict(list)
    for r in got:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 8, zlib.crc32(data), "rows", None)
        slots[r.shard].append(r.slot)
        places[data].append((r.shard, r.slot))
    assert set(slots) == set(range(24)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert {len(s) for s in slots.values()} <= {405 // 24, 405 // 24 + 1}
    before = {s: sum(len(slots[k]) for k in range(s)) for s in slots}
    for held in places.values():  # equal texts are neighbours
        at = sorted(before[s] + slot for s, slot in held)
        assert at == list(range(at[0], at[0] + len(at)))


def test_text_ranks_count_whole_values(spark):
    values = ["common_crawl/a", "common_crawl/b", "common_crawl/", "é", "z", None, "z"]
    frame = ship(spark).createDataFrame([(v,) for v in values], "source string")
    ranks = {r.source: r.source_rank for r in sharding.text_ranks(frame, "source").collect()}
    assert sorted(ranks, key=ranks.get) == ["common_crawl/", "common_crawl/a", "common_crawl/b", "z", "é"]


def test_components(spark):
    rng = random.Random(2)
    ids = [rng.randrange(8) * 2**33 + rng.randrange(300) for _ in range(300)]
    edges = [(rng.choice(ids), rng.choice(ids)) for _ in range(240)]
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in rows} == {x: root(x) for e in edges if e[0] != e[1] for x in e}


@pytest.mark.parametrize("hot", [1, 1000])
def test_line_intervals_match_brute_force(spark, monkeypatch, hot):
    """Every interval of the suffix array: members, order of ranks, first places; then the removed lines."""
    monkeypatch.setattr(lines, "HOT", hot)  # 1: all names are joined by shuffles
    rng = random.Random(5)
    block = [f"l{i}" for i in range(23)]
    docs = [[rng.choice(["a", "b", "c d", "e f g h i"]) for _ in range(rng.randrange(30))] for _ in range(12)]
    docs += [block, block[3:] + ["z"], ["y", *block[:19]], ["a"] * 21, ["only here"]]
    frame = spark.createDataFrame([(i, "\n\n".join(d)) for i, d in enumerate(docs)], "doc_id long, text string")
    keyed, repeated = lines._keyed(frame)
    table = lines.line_table(keyed, repeated)
    names = {}
    for r in table.collect():
        names[r.key, r.at] = (r.x, r.y)
    assert len(names) == sum(map(len, docs))
    depths = []
    for depth, members in lines.intervals(table):
        depths.append(depth)
        want = defaultdict(list)
        for key, d in enumerate(docs):
            for at in range(len(d) - depth + 1):
                want[tuple(names[key, at + j] for j in range(depth))].append((key, at))
        want = {n: places for n, places in want.items() if len(places) > 1}
        got = defaultdict(list)
        for r in members.collect():
            got[r.rank].append((r.key, r.at, r.later))
        # In the order of ranks the intervals are in the order of their first lines.
        assert [sorted(p[:2] for p in got[r]) for r in sorted(got)] == [want[n] for n in sorted(want)]
        assert all([later for *_, later in sorted(places)] == [False] + [True] * (len(places) - 1) for places in got.values())
    assert depths == [1, 2, 3, 4, 5, 8, 16]  # the longest repeat has 20 lines
    firsts, gone = {}, defaultdict(set)
    for key, d in enumerate(docs):
        for at in range(len(d)):
            for end in range(at + 1, len(d) + 1):
                run = tuple(d[at:end])
                if firsts.setdefault(run, (key, at)) != (key, at) and len(" ".join(run).split()) >= 5:
                    gone[key].update(range(at, end))
    left = {key: [x for i, x in enumerate(d) if i not in gone[key]] for key, d in enumerate(docs)}
    for r in lines.remove_lines(frame).collect():
        assert [x for x in r.text.split("\n") if x] == left[r.doc_id]
        assert r.n_removed == len(docs[r.doc_id]) - len(left[r.doc_id])
