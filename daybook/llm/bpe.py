"""Operator 7: byte-level BPE encoding and decoding.

Text becomes an array of symbol classes. A small automaton over these classes finds
where a piece begins. An automaton step is a function from state to state and the
composition of such functions is associative, so all states come from a scan: compose
the steps inside fixed blocks side by side, scan the blocks' functions by doubling,
then run every block from its now known state. No regular expression takes part.
Pieces are byte slices of the text; each is merged once and kept in a bounded cache.
"""

from __future__ import annotations

import base64
import heapq
import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import binary_rows, plain, ragged, record, slices, texts

#: Code points that the split pattern counts as white space (Unicode's White_Space). Fixed values.
WHITE = (
    *range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
)

# Symbol classes. The letters that contractions are made of have classes of their own.
SP, WS, LETTER, NUMBER, OTHER, APOS, STMD, R, V, L, E, END = range(12)
# States. START: what follows begins a piece; AFTER_SPACE: what follows joins the space.
START, AFTER_SPACE, IN_LETTERS, IN_NUMBERS, IN_OTHER, QUOTE, QUOTE_R, QUOTE_V, QUOTE_L = range(9)
_LETTERS = (LETTER, STMD, R, V, L, E)
_COMPLETES = {QUOTE_R: E, QUOTE_V: E, QUOTE_L: L}

#: Pieces of up to this many bytes are merged side by side in arrays, longer ones one by one.
SIDE_BY_SIDE = 48
#: Bytes that a cache of merged pieces holds in a worker, and what an entry takes besides its own.
CACHE_BYTES = 24_000_000
ENTRY_BYTES = 120
#: Pieces longer than this are not cached.
KEPT_PIECE = 64
_BLOCK = 64
#: Bytes of text encoded at a time.
SLICE = 1_000_000


def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state, and whether a piece begins at the symbol, by state * 12 + symbol."""
    nxt, begins = np.zeros((9, 12), np.uint8), np.zeros((9, 12), bool)
    for state in range(9):
        joins = state == AFTER_SPACE
        for s in _LETTERS:
            nxt[state, s], begins[state, s] = IN_LETTERS, not joins and state != IN_LETTERS
            if state == QUOTE and s in (STMD, R, V, L):
                nxt[state, s] = {STMD: START, R: QUOTE_R, V: QUOTE_V, L: QUOTE_L}[s]
                begins[state, s] = False
            elif state in _COMPLETES:
                nxt[state, s] = START if s == _COMPLETES[state] else IN_LETTERS
                begins[state, s] = False
        nxt[state, NUMBER], begins[state, NUMBER] = IN_NUMBERS, not joins and state != IN_NUMBERS
        inside = state in (IN_OTHER, QUOTE)
        nxt[state, OTHER], begins[state, OTHER] = IN_OTHER, not joins and not inside
        nxt[state, APOS] = IN_OTHER if joins or inside else QUOTE
        begins[state, APOS] = not joins and not inside
        nxt[state, SP], nxt[state, WS], nxt[state, END] = AFTER_SPACE, START, START
        begins[state, END] = True
    return nxt, begins


_NEXT, _BEGINS = _automaton()
_NEXT_FLAT, _BEGINS_FLAT = _NEXT.ravel(), _BEGINS.ravel()
_WIDE = np.uint8(12)


@lru_cache(maxsize=1)
def _classes() -> np.ndarray:
    """Class of every code point; one past the last stands for the end of a text."""
    table = np.full(0x110001, OTHER, dtype=np.uint8)
    points = "".join(map(chr, (*range(0xD800), *range(0xE000, 0x110000))))
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER)):
        found = "".join(regex.findall(pattern + "+", points))
        table[np.frombuffer(found.encode("utf-32-le"), dtype=np.uint32)] = kind
    table[list(WHITE)] = WS
    for chars, kind in ((" ", SP), ("'", APOS), ("stmd", STMD), ("r", R), ("v", V), ("l", L), ("e", E)):
        table[[ord(c) for c in chars]] = kind
    table[0x110000] = END
    return table


def scan(symbols: np.ndarray) -> np.ndarray:
    """The automaton's state after every symbol, from START, by composing step functions."""
    n = len(symbols)
    rows = -(-n // _BLOCK)
    grid = np.full(rows * _BLOCK, END, dtype=np.uint8)
    grid[:n] = symbols
    grid = np.ascontiguousarray(grid.reshape(rows, _BLOCK).T)  # column j: step j of every block
    whole = np.tile(np.arange(9, dtype=np.uint8)[:, None], (1, rows))
    for j in range(_BLOCK):
        whole *= _WIDE
        whole += grid[j]
        whole = np.take(_NEXT_FLAT, whole)
    apart = 1
    while apart < rows:  # doubling: each block's function after that of the blocks before it
        whole[:, apart:] = np.take_along_axis(whole[:, apart:], whole[:, :-apart], axis=0)
        apart *= 2
    state = np.zeros(rows, dtype=np.uint8)
    state[1:] = whole[START, :-1]
    after = np.empty((_BLOCK, rows), dtype=np.uint8)
    for j in range(_BLOCK):
        state = np.take(_NEXT_FLAT, state * _WIDE + grid[j])
        after[j] = state
    return after.T.reshape(-1)[:n]


def piece_starts(points: np.ndarray) -> np.ndarray:
    """Whether a piece begins at each code point; 0x110000 ends a text and is its own piece."""
    symbols = np.take(_classes(), points)
    after = scan(symbols)
    before = np.concatenate((np.zeros(1, np.uint8), after[:-1]))
    begins = np.take(_BEGINS_FLAT, before * _WIDE + symbols)
    following = np.concatenate((symbols[1:], np.full(1, END, np.uint8)))
    white = symbols <= WS
    white_before = np.concatenate((np.zeros(1, bool), white[:-1]))
    # The last of several white characters is a piece, or joins what follows.
    begins |= white & (~white_before | ((following > WS) & (following != END)))
    # A quote and r, v or l that no contraction follows from are two pieces.
    for state, symbol in _COMPLETES.items():
        begins |= (after == state) & (following != symbol)
    return begins


class KnownIds:
    """Ids of byte slices, each distinct one worked out once by ``fill`` and kept for later calls.

    ``fill`` turns a list of byte strings into all their ids and the number of ids of each.
    What is kept is bounded by bytes: beyond the bound the cache starts anew.
    """

    def __init__(self, fill: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray]]):
        self.fill = fill
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.held = 0
        self.flat = np.zeros(0, dtype=np.int32)
        self.sizes = np.zeros(0, dtype=np.int64)

    def __call__(
        self, data: np.ndarray, cuts: np.ndarray, real: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the slices of ``data`` between neighbouring cuts, and how many each slice has.

        ``real`` says which slices count; all do without it.
        """
        if self.held > CACHE_BYTES:
            self._forget()
        offsets = pa.py_buffer(cuts.astype(np.int32))
        column = pa.BinaryArray.from_buffers(pa.binary(), len(cuts) - 1, [None, offsets, pa.py_buffer(data)])
        coded = column.dictionary_encode()
        which, bounds = coded.indices.to_numpy(), np.frombuffer(coded.dictionary.buffers()[1], dtype=np.int32)
        bounds = bounds[: len(coded.dictionary) + 1].tolist()
        held = memoryview(coded.dictionary.buffers()[2] or b"")
        distinct = [held[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
        if real is not None:
            which = which[real]
        new = [p for p in distinct if p not in self.numbers]
        if keep := [p for p in new if len(p) <= KEPT_PIECE]:
            flat, sizes = self.fill(keep)
            self.numbers.update(zip(keep, range(len(self.sizes), len(self.sizes) + len(keep)), strict=True))
            self.flat, self.sizes = np.concatenate((self.flat, flat)), np.concatenate((self.sizes, sizes))
            self.held += sum(map(len, keep)) + ENTRY_BYTES * len(keep)
        flat, sizes, numbers = self.flat, self.sizes, self.numbers
        if once := [p for p in new if len(p) > KEPT_PIECE]:
            more, more_sizes = self.fill(once)
            numbers = numbers | dict(zip(once, range(len(sizes), len(sizes) + len(once)), strict=True))
            flat, sizes = np.concatenate((flat, more)), np.concatenate((sizes, more_sizes))
        place = np.fromiter(map(numbers.__getitem__, distinct), dtype=np.int64, count=len(distinct))[which]
        counts = sizes[place]
        return flat[ragged((np.cumsum(sizes) - sizes)[place], counts)], counts


class ByteBPE:
    """Encoder and decoder of one vocabulary of byte strings with ranks."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        top = max(ranks.values()) + 1
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        tokens = [b""] * top
        for token, rank in ranks.items():
            tokens[rank] = token
        self.token_bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        self.token_length = np.fromiter(map(len, tokens), dtype=np.int64, count=top)
        self.token_start = np.cumsum(self.token_length) - self.token_length
        pairs = {}
        for token, rank in ranks.items():
            for k in range(1, len(token)):
                left, right = ranks.get(token[:k]), ranks.get(token[k:])
                if left is not None and right is not None:
                    pairs[left << 20 | right] = rank
        self.none = top
        self.pairs = pairs
        self._levels = self._hashed(pairs)
        self.known = KnownIds(self._merge)

    @staticmethod
    def _hashed(pairs: dict[int, int]) -> list[tuple[np.uint64, np.uint64, np.ndarray, np.ndarray]]:
        """Tables from pair to rank: keys that share a slot go on to the next, smaller table."""
        keys = np.fromiter(pairs, dtype=np.int64, count=len(pairs))
        ranks = np.fromiter(pairs.values(), dtype=np.int32, count=len(pairs))
        levels, factor = [], 0x9E3779B97F4A7C15
        while len(keys):
            bits = max(8, int(np.ceil(np.log2(len(keys)))) + 2)
            shift = np.uint64(64 - bits)
            slot = ((keys.astype(np.uint64) * np.uint64(factor)) >> shift).astype(np.int64)
            table, value = np.full(1 << bits, -1, np.int64), np.zeros(1 << bits, np.int32)
            table[slot] = keys  # one of those that share a slot stays
            rest = table[slot] != keys
            value[slot[~rest]] = ranks[~rest]
            levels.append((np.uint64(factor), shift, table, value))
            keys, ranks, factor = keys[rest], ranks[rest], (factor * 0xD1342543DE82EF95 + 2) % 2**64 | 1
        return levels

    def _pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left.astype(np.int64) << 20) | right
        hashed, out = key.astype(np.uint64), np.full(key.shape, self.none, dtype=np.int32)
        for factor, shift, table, value in self._levels:
            slot = ((hashed * factor) >> shift).astype(np.int64)
            hit = np.take(table, slot) == key
            out[hit] = np.take(value, slot[hit])
        return out

    def _merge_grid(self, block: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge pieces, a padded row of bytes each; ids in a grid and how many count."""
        rows, width = block.shape
        ids = self.byte_ids[block].astype(np.int32)
        out = ids.copy()
        count = length.copy()
        if width == 1:
            return out, count
        live = np.arange(rows)
        columns = np.arange(width)
        rank = self._pair_rank(ids[:, :-1], ids[:, 1:])
        rank[columns[:-1] >= (length - 1)[:, None]] = self.none
        while True:
            at = rank.argmin(axis=1)
            best = rank[np.arange(len(live)), at]
            going = best < self.none
            if not going.all():
                done = live[~going]
                out[done] = ids[~going]
                live, ids, rank, at, best = live[going], ids[going], rank[going], at[going], best[going]
            if not len(live):
                return out, count
            count[live] -= 1
            each = np.arange(len(live))
            move = np.minimum(columns + (columns > at[:, None]), width - 1)
            ids = np.take_along_axis(ids, move, axis=1)
            ids[each, at] = best
            rank = np.take_along_axis(rank, np.minimum(move[:, :-1], width - 2), axis=1)
            length = count[live]
            rank[columns[:-1] >= (length - 1)[:, None]] = self.none
            for offset in (-1, 0):
                place = at + offset
                ok = (place >= 0) & (place < length - 1)
                e, p = each[ok], place[ok]
                rank[e, p] = self._pair_rank(ids[e, p], ids[e, p + 1])

    def _merge_long(self, piece: bytes) -> list[int]:
        """Merge one long piece with a heap of pairs, in time near its length."""
        ids = [int(self.byte_ids[b]) for b in piece]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        alive = [True] * n
        get = self.pairs.get
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := get(ids[i] << 20 | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if not alive[i] or j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], alive[j] = r, False
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                if (x := get(r << 20 | ids[after[j]])) is not None:
                    heapq.heappush(heap, (x, i, r, ids[after[j]]))
            if (h := before[i]) >= 0 and (x := get(ids[h] << 20 | r)) is not None:
                heapq.heappush(heap, (x, h, ids[h], r))
        return [ids[i] for i in range(n) if alive[i]]

    def _merge(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces one after the other, and how many each has."""
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        counts = np.zeros(len(pieces), dtype=np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        width_of = np.where(lengths > 1, -(-lengths // 4) * 4, 1)
        order = np.argsort(width_of, kind="stable")
        bounds = np.flatnonzero(np.diff(width_of[order], prepend=-1, append=-1))
        for lo, hi in zip(bounds[:-1], bounds[1:], strict=True):
            rows = order[lo:hi]
            width = int(width_of[rows[0]])
            if width <= SIDE_BY_SIDE:
                joined = b"".join([pieces[r].ljust(width, b"\0") for r in rows.tolist()])
                grid = np.frombuffer(joined, np.uint8).reshape(len(rows), width)
                ids, count = self._merge_grid(grid, lengths[rows])
                counts[rows] = count
                parts.append((rows, ids[np.arange(width) < count[:, None]]))
            else:
                for r in rows.tolist():
                    ids = np.array(self._merge_long(pieces[r]), dtype=np.int32)
                    counts[r] = len(ids)
                    parts.append((np.array([r]), ids))
        start = np.cumsum(counts) - counts
        flat = np.empty(int(counts.sum()), dtype=np.int32)
        for rows, ids in parts:
            flat[ragged(start[rows], counts[rows])] = ids
        return flat, counts

    def encode(self, batch: list[str] | list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and the end of each text among them."""
        batch = [t if isinstance(t, bytes) else t.encode("utf-8", "surrogatepass") for t in batch]
        data = b"\0".join(batch) + b"\0"
        text = data.decode("utf-8", "surrogatepass")
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).copy()
        width = (1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)).astype(np.int64)
        byte_at = np.cumsum(width) - width
        byte_ends = np.cumsum(np.fromiter(map(len, batch), dtype=np.int64, count=len(batch)) + 1) - 1
        ends = np.searchsorted(byte_at, byte_ends)
        points[ends] = 0x110000
        begins = np.flatnonzero(piece_starts(points))
        real = points[begins] != 0x110000
        cuts = np.append(byte_at[begins], len(data))
        ids, counts = self.known(np.frombuffer(data, dtype=np.uint8), cuts, real)
        upto = np.cumsum(counts)
        per_text = np.searchsorted(begins[real], ends, "left")
        return ids, np.where(per_text > 0, upto[np.maximum(per_text, 1) - 1] if len(upto) else 0, 0)

    def decode(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of the ids one after the other, and the number of bytes of each id."""
        lengths = self.token_length[ids]
        return self.token_bytes[ragged(self.token_start[ids], lengths)], lengths


@lru_cache(maxsize=4)
def rank_file(path: str) -> ByteBPE:
    """The encoder of a file with one base64 token and its rank a line."""
    with open(path, "rb") as lines:
        rows = (line.split() for line in lines if line.strip())
        return ByteBPE({base64.b64decode(token): int(rank) for token, rank in rows})


@lru_cache(maxsize=4)
def json_file(path: str) -> tuple[ByteBPE, dict[str, int]]:
    """The encoder of a byte-level tokenizer file, and its special tokens."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
    # The usual stand-ins for bytes: printable characters stand for themselves, others are shifted.
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown}
    byte_of |= {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in set(shown))}
    ranks = {
        bytes(byte_of[c] for c in token): rank
        for token, rank in spec["model"]["vocab"].items()
        if token not in special
    }
    return ByteBPE(ranks), special


ENCODED = "doc_id long, ids binary"
_ENCODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary())])


def encode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Encode every text of ``docs`` (doc_id, text); ``vocabulary`` is the path of a rank file.

    One row per input row: doc_id, ids (little-endian unsigned 32-bit integers). A null
    or empty text has no ids. Repeated rows and ids give a row each, other columns are
    ignored, an empty table gives an empty one. A text is handled whole whatever its length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = rank_file(vocabulary)
        for part in slices(batches, limit=SLICE):
            ids, ends = bpe.encode(texts(part))
            data = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8)
            yield record(_ENCODED, part.column("doc_id"), binary_rows(data, ends * 4))

    return plain(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id", "text").mapInArrow(run, ENCODED)


_DECODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("data", pa.binary())])


def decode(encoded: DataFrame, vocabulary: str) -> DataFrame:
    """Add the decoded bytes (data) to rows of doc_id and ids; a null has no bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = rank_file(vocabulary)
        for part in slices(batches, "ids"):
            rows = [i or b"" for i in part.column("ids").to_pylist()]
            data, lengths = bpe.decode(np.frombuffer(b"".join(rows), dtype="<u4").astype(np.int64))
            upto = np.concatenate(([0], np.cumsum(lengths)))
            ends = np.cumsum(np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))) // 4
            yield record(_DECODED, part.column("doc_id"), part.column("ids"), binary_rows(data, upto[ends]))

    return plain(encoded, "doc_id", "ids").mapInArrow(run, ENCODED + ", data binary")


def encode_and_decode(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``decode(encode(docs))`` in one pass, so that a task needs one Python worker, not two."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = rank_file(vocabulary)
        for part in slices(batches, limit=SLICE):
            ids, ends = bpe.encode(texts(part))
            data, lengths = bpe.decode(ids)
            upto = np.concatenate(([0], np.cumsum(lengths)))
            stored = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8)
            yield record(
                _DECODED, part.column("doc_id"), binary_rows(stored, ends * 4), binary_rows(data, upto[ends])
            )

    named = plain(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id", "text")
    return named.mapInArrow(run, ENCODED + ", data binary")


def round_trip(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Encode, decode, and reduce both to digests: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    both = encode_and_decode(docs, vocabulary)
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("data", 256).alias("decoded_sha256"),
    )
