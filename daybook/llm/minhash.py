"""Operator 4: near-duplicate documents by DartMinHash over weighted word shingles.

A document is a weighted set: its five-word shingles with their counts. Darts fall on the
half plane of weight and rank by a process that only the shingle seeds; a document gets
those below its shingles' weights. Each dart has one of k coordinates, and the dart of least
rank per coordinate is the document's signature there. Two signatures agree in a
coordinate with a chance equal to their weighted Jaccard similarity, and a document of
any size needs about k ln k darts, not k times its size.

Banded signatures propose pairs; the similarity of whole texts decides.
"""

from __future__ import annotations

import hashlib
from collections import Counter, OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.blocks import local_forest, pairs_within, tiles, whole_groups
from daybook.llm.common import WordTable, mix, packed_words, record, slices, texts
from daybook.llm.graph import components
from daybook.session import settle


@dataclass(frozen=True)
class Settings:
    """A pair at the threshold shares a band with a chance of 0.9999."""

    shingle: int = 5
    threshold: float = 0.8
    rows: int = 4
    bands: int = 18

    @property
    def coordinates(self) -> int:
        return self.rows * self.bands

    @property
    def least_agreement(self) -> int:
        """Coordinates in which a pair at the threshold agrees, less five deviations."""
        k, t = self.coordinates, self.threshold
        return int(k * t - 5 * np.sqrt(k * t * (1 - t)))


_STRIP, _DART = np.uint64(0xA24BAED4963EE407), np.uint64(0x9FB21C651E98DF25)
_UNIT = 2.0**-53


def _strip_bounds(weights: np.ndarray, strip: int) -> tuple[float, float]:
    return (0.0, 1.0) if strip == 0 else (2.0 ** (strip - 1), 2.0**strip)


def dart_signatures(
    owner: np.ndarray, element: np.ndarray, weight: np.ndarray, sets: int, k: int
) -> np.ndarray:
    """DartMinHash of weighted sets: a row of k 64-bit values per set; 0 throughout for an empty one.

    Element i of set ``owner[i]`` has a 64-bit hash and a positive weight. The weight axis is
    cut into strips [0, 1), [1, 2), [2, 4), ...; in each, the element's own process throws darts
    in order of rank at a rate of k times the strip's width. A dart counts where it lies below
    the element's weight. Sets whose rank limit leaves a coordinate empty go on to twice the rank.
    """
    out = np.zeros((sets, k), dtype=np.uint64)
    mass = np.bincount(owner, weight, sets)
    limit = np.where(mass > 0, (np.log(k) + 4) / np.maximum(mass, 1e-300), 0.0)
    open_sets = mass > 0
    while open_sets.any():
        live = np.flatnonzero(open_sets[owner])
        keys, ranks, values = [], [], []
        for strip in range(64):
            low, high = _strip_bounds(weight, strip)
            e = live[weight[live] > low]
            if not len(e):
                break
            seed = mix(element[e] + np.uint64(int(_STRIP) * (strip + 1) % 2**64))
            rank = np.zeros(len(e))
            number = 0
            while len(e):
                number += 1
                x = mix(seed + np.uint64(int(_DART) * number % 2**64))
                rank = rank - np.log1p(-(x >> np.uint64(11)).astype(np.float64) * _UNIT) / (k * (high - low))
                within = rank <= limit[owner[e]]
                e, seed, rank, x = e[within], seed[within], rank[within], x[within]
                more = mix(x)
                place = low + (more >> np.uint64(11)).astype(np.float64) * _UNIT * (high - low)
                hit = place < weight[e]
                coordinate = (mix(more) % np.uint64(k)).astype(np.int64)
                keys.append((owner[e] * k + coordinate)[hit])
                ranks.append(rank[hit])
                values.append(x[hit])
        key, rank, value = np.concatenate(keys), np.concatenate(ranks), np.concatenate(values)
        order = np.lexsort((value, rank, key))
        key, value = key[order], value[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        filled = np.bincount(key[first] // k, minlength=sets) == k
        done = open_sets & filled
        chosen = first[done[key[first] // k]]
        out.reshape(-1)[key[chosen]] = value[chosen]
        open_sets &= ~filled
        limit = limit * 2
    return out


def weighted_shingles(table: WordTable, sets: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Owner, hash and count of every distinct shingle; a shorter text is one shingle."""
    words = table.hashes()
    whole = packed_words(words, width)
    same = table.owner[: len(whole)] == table.owner[width - 1 :] if len(whole) else np.zeros(0, bool)
    owner, element = table.owner[: len(whole)][same], whole[same]
    count = np.diff(table.first)
    for n in range(1, width):
        short = np.flatnonzero(count == n)
        if len(short):
            owner = np.append(owner, short)
            element = np.append(element, packed_words(words, n)[table.first[short]])
    order = np.lexsort((element, owner))
    owner, element = owner[order], element[order]
    new = np.ones(len(owner), dtype=bool)
    new[1:] = (owner[1:] != owner[:-1]) | (element[1:] != element[:-1])
    at = np.flatnonzero(new)
    return owner[at], element[at], np.diff(np.append(at, len(owner))).astype(np.float64)


def shingle_counts(text: str, width: int) -> Counter:
    """Count of every shingle, as tuples of words."""
    words = WordTable([text])
    data = words.data.tobytes().split(b" ")[:-1]
    if len(data) < width:
        return Counter([tuple(data)] if data else [])
    return Counter(zip(*(data[k:] for k in range(width)), strict=False))


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard: the sum of smaller counts over the sum of larger ones."""
    if len(a) > len(b):
        a, b = b, a
    both = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return both / max(a.total() + b.total() - both, 1)


_SIGNED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("text_hash", pa.int64()),
        ("words_md5", pa.binary()),
        ("signature", pa.binary()),
        ("bands", pa.list_(pa.int64())),
    ]
)


def signatures(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, text_hash, words_md5, signature (16 bits a coordinate) and bands of every row; the last three null without words."""
    k = settings.coordinates

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            batch = texts(part)
            table = WordTable(batch)
            signs = dart_signatures(*weighted_shingles(table, len(batch), settings.shingle), len(batch), k)
            bands = signs.reshape(len(batch), settings.bands, settings.rows)
            total = np.zeros(bands.shape[:2], dtype=np.uint64)
            for r in range(settings.rows):
                total = mix(total * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, r])
            short = mix(signs).astype(np.uint16)
            some = np.diff(table.first) > 0
            ends = np.append(table.start + table.length, 0)
            data = table.data.tobytes()
            digest = [
                hashlib.md5(data[table.start[lo] : ends[hi - 1]]).digest() if hi > lo else None
                for lo, hi in zip(table.first[:-1], table.first[1:], strict=True)
            ]
            yield record(
                _SIGNED,
                part.column("doc_id"),
                part.column("text_hash"),
                digest,
                [s.tobytes() if ok else None for s, ok in zip(short, some, strict=True)],
                [t.view(np.int64) if ok else None for t, ok in zip(total, some, strict=True)],
            )

    return _keyed(docs).mapInArrow(
        run, "doc_id long, text_hash long, words_md5 binary, signature binary, bands array<long>"
    )


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        docs["doc_id"].cast("long").alias("doc_id"),
        docs["text"],
        F.xxhash64(docs["text"]).alias("text_hash"),
    )


def _with_plain_id(rows: DataFrame) -> DataFrame:
    """The id as two columns without nulls, so that a join and what follows it share a partitioning."""
    return rows.select("*", F.coalesce("doc_id", F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no_id"))


def _verified(pairs: DataFrame, written: DataFrame, settings: Settings) -> DataFrame:
    """Pairs (a, b) whose texts have at least the threshold's similarity; ``written`` has uid and text."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        recent: OrderedDict[int, Counter] = OrderedDict()  # a pivot's pairs come one after the other

        def counts(uid: int, text: str) -> Counter:
            if uid not in recent:
                recent[uid] = shingle_counts(text, settings.shingle)
                if len(recent) > 4:
                    recent.popitem(last=False)
            return recent[uid]

        for part in slices(batches, "text_b"):
            rows = zip(*(part.column(c).to_pylist() for c in ("a", "b", "text_a", "text_b")), strict=True)
            kept = [
                (a, b)
                for a, b, text_a, text_b in rows
                if similarity(counts(a, text_a), shingle_counts(text_b, settings.shingle)) >= settings.threshold
            ]
            yield record(schema, [a for a, _ in kept], [b for _, b in kept])

    full = pairs.join(written.select(F.col("uid").alias("b"), F.col("text").alias("text_b")), "b")
    full = full.join(written.select(F.col("uid").alias("a"), F.col("text").alias("text_a")), "a")
    return full.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _likely(pairs: DataFrame, signed: DataFrame, settings: Settings) -> DataFrame:
    """Pairs whose signatures agree often enough for the threshold."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            if not part.num_rows:
                continue
            x, y = (_signs(part.column(c), settings) for c in ("sign_a", "sign_b"))
            ok = (x == y).sum(axis=1) >= settings.least_agreement
            yield record(schema, *(part.column(c).filter(pa.array(ok)) for c in ("a", "b")))

    full = pairs.join(signed.select(F.col("uid").alias("b"), F.col("signature").alias("sign_b")), "b")
    full = full.join(signed.select(F.col("uid").alias("a"), F.col("signature").alias("sign_a")), "a")
    return full.mapInArrow(run, "a long, b long")


def _shingled(settings: Settings):
    """uid and text to uid and the sorted hashes of the text's shingles, each count a hash of its own."""
    schema = pa.schema([("uid", pa.int64()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            batch = texts(part)
            owner, element, weight = weighted_shingles(WordTable(batch), len(batch), settings.shingle)
            times = weight.astype(np.int64)
            owner, element = np.repeat(owner, times), np.repeat(element, times)
            copy = np.arange(len(owner)) - np.repeat(np.cumsum(times) - times, times)
            element = mix(element + copy.astype(np.uint64) * _STRIP)
            element = element[np.lexsort((element, owner))]
            at = np.searchsorted(owner, np.arange(len(batch) + 1))
            data = [element[lo:hi].tobytes() for lo, hi in zip(at[:-1], at[1:], strict=True)]
            yield record(schema, part.column("uid"), data)

    return run


def _overlaps(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Common elements of the sets of every pair (a, b)."""
    if len(a) < 2000:
        common = [len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(a, b, strict=True)]
        return np.array(common, dtype=np.float64)
    # Many pairs: products of the incidence matrix, a strip of shared elements at a time.
    used, place = np.unique(np.concatenate((a, b)), return_inverse=True)
    row = np.repeat(np.arange(len(used)), [len(sets[k]) for k in used])
    _, column, n = np.unique(np.concatenate([sets[k] for k in used]), return_inverse=True, return_counts=True)
    number = np.cumsum(n > 1) - 1
    shared = n[column] > 1
    row, column = row[shared], number[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((len(used), len(used)), dtype=np.float32)
    strip = 4096
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, strip):
        lo, hi = np.searchsorted(column, (low, low + strip))
        grid = np.zeros((len(used), strip), dtype=np.float32)
        grid[row[lo:hi], column[lo:hi] - low] = 1
        common += grid @ grid.T
    return common[place[: len(a)], place[len(a) :]].astype(np.float64)


def _unlike_classes(table: pa.Table, bounds: np.ndarray, settings: Settings) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row pairs of a tile in different classes whose signatures allow the threshold.

    Only the first band that two documents share proposes them.
    """
    component, block, band = (table.column(c).to_numpy() for c in ("component", "block", "band"))
    crossing = table.column("tile_a").to_numpy() != table.column("tile_b").to_numpy()
    signs = _signs(table.column("signature"), settings)
    bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, settings.bands)
    for a, b in pairs_within(bounds):
        ok = (component[a] != component[b]) & (~crossing[a] | (block[a] != block[b]))
        a, b = a[ok], b[ok]
        near = (signs[a] == signs[b]).sum(axis=1) >= settings.least_agreement
        a, b = a[near], b[near]
        first = (bands[a] == bands[b]).argmax(axis=1) == band[a]
        if first.any():
            yield a[first], b[first]


def _promising(settings: Settings, keys: list[str]):
    """Tiles of bucket members to the members that some other member of the bucket may be linked to."""
    schema = pa.schema([("band", pa.int32()), ("bucket", pa.int64()), ("uid", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, [*keys, "tile_a", "tile_b"], least=1024):
            some = np.zeros(table.num_rows, dtype=bool)
            for a, b in _unlike_classes(table, bounds, settings):
                some[a] = some[b] = True
            if some.any():
                yield record(schema, *(table.column(c).to_numpy()[some] for c in (*keys, "uid")))

    return run


def _across(settings: Settings, keys: list[str]):
    """Tiles of bucket members to links between those in different classes, a star per linked part."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, bounds in whole_groups(batches, [*keys, "tile_a", "tile_b"], least=1024):
            uid = table.column("uid").to_numpy()
            sets = [np.frombuffer(x, dtype=np.uint64) for x in table.column("shingles").to_pylist()]
            size = np.fromiter(map(len, sets), dtype=np.float64, count=len(sets))
            found: list[tuple[np.ndarray, np.ndarray]] = []
            for a, b in _unlike_classes(table, bounds, settings):
                common = _overlaps(sets, a, b)
                linked = common / (size[a] + size[b] - common) >= settings.threshold
                found.append((a[linked], b[linked]))
            if found:
                a, b = (np.concatenate(x) for x in zip(*found, strict=True))
                member, hub = local_forest(a, b, len(uid))
                yield record(schema, uid[hub], uid[member])

    return run


def _signs(column, settings: Settings) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint16).reshape(-1, settings.coordinates)


def near_duplicates(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Classes of near-duplicate documents among all rows of (doc_id, text).

    Two documents are linked where the weighted Jaccard similarity of their counted word
    shingles is at least the threshold; a class is what links connect. One row per input row:
    doc_id, class_id (the smallest doc_id of the class), kept. Documents with the same
    words are one node. A text of fewer words than a shingle is one shingle; a null text or one
    without words is a class of its own. Rows that repeat a doc_id are documents of their
    own. One row of each class is kept: one with the smallest doc_id. A null doc_id
    takes part, and class_id is null only where all ids of a class are. Other columns are
    ignored; an empty table gives no rows.

    Members of a bucket are first compared with one pivot, the member that shares most buckets
    with others. Then any two members that are still in different classes are compared, in tiles
    of bounded size, so no link between two members of a bucket is lost and a class of very
    similar documents costs as many comparisons as it has members.
    """
    signed = settle(signatures(docs, settings), "signatures").withColumn("uid", F.monotonically_increasing_id())
    lean = signed.select("uid", "doc_id", "text_hash", "words_md5")
    # One node for all texts with the same words.
    nodes = lean.where("words_md5 is not null").groupBy("words_md5").agg(F.min("uid").alias("uid"))
    nodes = settle(nodes, "nodes")
    single = settle(
        signed.drop("doc_id", "text_hash", "words_md5").join(nodes.select("uid"), "uid"), "distinct-signatures"
    )
    keys = ["band", "bucket"]
    banded = single.select("uid", F.posexplode("bands").alias("band", "bucket"))
    sizes = banded.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
    members = settle(banded.join(sizes, keys), "band-members")
    shared = members.groupBy("uid").agg(F.sum("n").alias("shared"))
    pivots = members.join(shared, "uid").groupBy(*keys).agg(
        F.max("shared").alias("shared"), F.max_by("uid", F.struct("shared", -F.col("uid"))).alias("pivot")
    )
    pivots = settle(pivots.select(*keys, "pivot"), "pivots")
    tried = members.join(pivots, keys).where("uid <> pivot").select(F.col("pivot").alias("a"), F.col("uid").alias("b"))
    tried = settle(tried.distinct(), "pivot-pairs")
    candidates = settle(_likely(tried, single, settings), "likely-pairs")

    # Texts of the documents that some bucket holds with others; the only time that texts move.
    wanted = members.select("uid").distinct().join(lean.select("uid", "doc_id", "text_hash"), "uid")
    at = ["text_hash", "id", "no_id"]
    source = _with_plain_id(_keyed(docs).where("text is not null")).select(*at, "text")
    # Repeated rows have the same text, so any of them will do. Each task sends one of them, and
    # the join takes the rows where they lie.
    written = source.dropDuplicates(at).join(_with_plain_id(wanted).select(*at, "uid").hint("merge"), at)
    written = settle(written.select("uid", "text"), "bucket-texts")
    links = settle(_verified(candidates, written, settings), "links")
    groups = settle(components(links), "classes")

    # Members of one bucket in different classes, each pair in one tile.
    placed = members.join(groups.withColumnRenamed("node", "uid"), "uid", "left")
    placed = placed.select(*keys, "uid", F.coalesce("component", "uid").alias("component"))
    mixed = placed.groupBy(*keys).agg(
        F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high")
    ).where("low <> high")
    mixed = settle(mixed, "mixed-buckets")
    apart = settle(placed.join(mixed.select(*keys), keys), "mixed-members")
    # Signatures first; only members that they leave in question carry their shingles.
    light = apart.join(single, "uid")
    dealt = tiles(light, mixed.select(*keys, "n"), keys)
    open_members = dealt.mapInArrow(_promising(settings, keys), "band int, bucket long, uid long").distinct()
    open_members = settle(open_members.join(apart, [*keys, "uid"]), "open-members")
    shingled = written.join(open_members.select("uid").distinct(), "uid").mapInArrow(
        _shingled(settings), "uid long, shingles binary"
    )
    shingled = settle(shingled.join(single, "uid"), "open-shingles")
    counts = open_members.groupBy(*keys).agg(F.count("*").alias("n"))
    dealt = tiles(open_members.join(shingled, "uid"), counts, keys)
    more = settle(dealt.mapInArrow(_across(settings, keys), "a long, b long"), "cross-links")
    groups = settle(components(links.unionByName(more)), "classes")

    classed = lean.join(nodes.withColumnRenamed("uid", "node"), "words_md5", "left")
    classed = classed.join(groups, "node", "left")
    classed = classed.withColumn("component", F.coalesce("component", "node", "uid"))
    best = classed.groupBy("component").agg(
        F.min("doc_id").alias("class_id"),
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "uid")).alias("first"),
    )
    return classed.join(best, "component").select(
        "doc_id", "class_id", (F.col("uid") == F.col("first.uid")).alias("kept"), "text_hash"
    )


def keep_one(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """The rows of ``docs``, all columns, of which one of each class stays.

    Of rows with one doc_id and text, one is left at most.
    """
    kept = near_duplicates(docs, settings).where("kept").select(
        F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")
    ).distinct()
    match = F.xxhash64(docs["text"]).eqNullSafe(F.col("__hash")) & docs["doc_id"].cast("long").eqNullSafe(F.col("__id"))
    chosen = docs.join(kept.hint("merge"), match, "left_semi")
    repeated = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    return chosen if repeated else chosen.dropDuplicates(["doc_id", "text"])
