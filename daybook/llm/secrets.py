"""Operator 8: secret scans by one combined deterministic automaton.

The rules' regular expressions become one nondeterministic automaton over bytes. Subset
construction makes it deterministic, with the set of rules that end in each state, and
partition refinement makes it minimal. Its transition array finds, in one pass over the
bytes of a text, which rules occur at all. Only where a rule occurs is its own reversed automaton
run for where matches begin, and its own forwards from there for the leftmost longest ones.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import plain, record, slices, texts


@dataclass(frozen=True)
class Rule:
    """A kind of secret. Matches of ``pattern`` with fewer than ``least`` characters are dropped.

    With ``assigned``, only the value counts: what follows the first ``:`` or ``=``, spaces
    and one quote. A dropped match still uses up its text. ``pattern`` may use literals,
    classes, groups, alternatives and repeats, over ASCII. ``base`` marks the rules whose
    spans the contract fixes; the others only add spans.

    ``sign`` is the pattern that the combined automaton looks for, if not ``pattern`` itself;
    it must match within every match that counts. Long counted repeats of different rules
    would multiply in the combined automaton, so a sign leaves them to the rule's own.
    """

    kind: str
    pattern: str
    least: int = 0
    assigned: bool = False
    base: bool = False
    sign: str | None = None


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYWORDS = "|".join(_either_case(w) for w in ("password", "passwd", "secret", "token"))
_API_KEY = _either_case("api") + "_?" + _either_case("key")

#: The base rules are fixed values of the contract.
RULES = (
    Rule(
        "assign",
        f"({_KEYWORDS}|{_API_KEY})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        least=8,
        assigned=True,
        base=True,
    ),
    Rule("access", "AKIA[A-Z0-9]+", least=16, base=True),
    Rule("hex", "[0-9a-f]+", least=32, base=True, sign="[0-9a-f]{32}"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}", sign="gh[pousr]_[A-Za-z0-9]"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", sign="xox[abprs]-"),
    Rule("private_key", "-----BEGIN ([A-Z]+ )*PRIVATE KEY-----", sign="-----BEGIN "),
    Rule(
        "jwt",
        r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}",
        sign=r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]",
    ),
)


class _Nfa:
    """A nondeterministic automaton: edges on sets of bytes, and edges that take nothing."""

    def __init__(self, backwards: bool = False):
        self.backwards = backwards
        self.on: list[list[tuple[frozenset[int], int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.on.append([])
        self.free.append([])
        return len(self.on) - 1

    def add(self, items, start: int) -> int:
        """Append parsed items after ``start``; the state after them."""
        for op, value in reversed(items) if self.backwards else items:
            start = self._one(op, value, start)
        return start

    def _one(self, op, value, start: int) -> int:
        if op is sre.LITERAL or op is sre.IN:
            end = self.state()
            self.on[start].append((_bytes_of(op, value), end))
            return end
        if op is sre.SUBPATTERN:
            return self.add(value[3], start)
        if op is sre.BRANCH:
            end = self.state()
            for branch in value[1]:
                first = self.state()
                self.free[start].append(first)
                self.free[self.add(branch, first)].append(end)
            return end
        if op is sre.MAX_REPEAT:
            low, high, items = value
            for _ in range(low):
                start = self.add(items, start)
            if high is sre.MAXREPEAT:
                loop, end = self.state(), self.state()
                self.free[start].append(loop)
                self.free[self.add(items, loop)].append(loop)
                self.free[loop].append(end)
                return end
            end = self.state()
            for _ in range(high - low):
                self.free[start].append(end)
                start = self.add(items, start)
            self.free[start].append(end)
            return end
        raise ValueError(f"a rule uses {op}, which is not supported")

    def closed(self, states) -> frozenset[int]:
        found, todo = set(states), list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in found:
                    found.add(s)
                    todo.append(s)
        return frozenset(found)


def _bytes_of(op, value) -> frozenset[int]:
    if op is sre.LITERAL:
        found = {value}
    else:
        found = set()
        for kind, x in value:
            if kind is sre.LITERAL:
                found.add(x)
            elif kind is sre.RANGE:
                found.update(range(x[0], x[1] + 1))
            else:
                raise ValueError(f"a rule uses {kind} in a class, which is not supported")
    if max(found) > 127:
        raise ValueError("rules are over ASCII")
    return frozenset(found)


@dataclass
class Dfa:
    """Minimal deterministic automaton: next state by state * 256 + byte, rules ending by state."""

    step: list[int]
    ends: list[int]
    start: int
    #: the state that nothing leads out of, or -1
    dead: int


def automaton(patterns: Sequence[str], anywhere: bool, backwards: bool = False) -> Dfa:
    """Subset construction over all patterns, then minimisation.

    ``anywhere``: matches may begin at every byte; otherwise only at the start.
    ``backwards``: for reading the bytes from the last to the first.
    Bit r of ``ends`` tells that pattern r ends in the state.
    """
    nfa, first, rule_of = _Nfa(backwards), [], {}
    for r, pattern in enumerate(patterns):
        begin = nfa.state()
        first.append(begin)
        rule_of[nfa.add(sre_parser.parse(pattern), begin)] = 1 << r
    # Bytes that no set of bytes tells apart are one symbol.
    sets = {s for edges in nfa.on for s, _ in edges}
    alike = defaultdict(list)
    for b in range(256):
        alike[frozenset(s for s in sets if b in s)].append(b)
    symbols = list(alike.values())
    moves = [[frozenset(k for k, g in enumerate(symbols) if g[0] in s) for s, _ in edges] for edges in nfa.on]
    again = nfa.closed(first) if anywhere else frozenset()
    start = nfa.closed(first)
    number, order, rows = {start: 0}, [start], []
    closures: dict[int, frozenset[int]] = {}
    for states in order:
        targets = [set(again) for _ in symbols]
        for s in states:
            for (_, to), on in zip(nfa.on[s], moves[s], strict=True):
                if to not in closures:
                    closures[to] = nfa.closed([to])
                for k in on:
                    targets[k] |= closures[to]
        row = []
        for t in map(frozenset, targets):
            if t not in number:
                number[t] = len(order)
                order.append(t)
            row.append(number[t])
        rows.append(row)
    ends = [0] * len(order)
    for k, states in enumerate(order):
        for s in states:
            ends[k] |= rule_of.get(s, 0)
    # Refine: states stay together while they end the same rules and lead to the same parts.
    part, parts = ends, len(set(ends))
    while True:
        keys: dict[tuple, int] = {}
        refined = [keys.setdefault((part[k], *[part[t] for t in row]), len(keys)) for k, row in enumerate(rows)]
        part = refined
        if len(keys) == parts:
            break
        parts = len(keys)
    small_ends, small_rows = [0] * parts, [[]] * parts
    for k, p in enumerate(part):
        small_ends[p], small_rows[p] = ends[k], [part[t] for t in rows[k]]
    symbol_of = [0] * 256
    for k, group in enumerate(symbols):
        for b in group:
            symbol_of[b] = k
    step = [row[symbol_of[b]] for row in small_rows for b in range(256)]
    dead = next((p for p in range(parts) if not small_ends[p] and set(small_rows[p]) == {p}), -1)
    return Dfa(step, small_ends, part[0], dead)


class Scanner:
    """Finds the spans of a set of rules in texts."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules = tuple(rules)
        whole = automaton([r.sign or r.pattern for r in self.rules], anywhere=True)
        # States are numbered so that those that end a rule come last: one comparison finds them.
        order = sorted(range(len(whole.ends)), key=lambda s: whole.ends[s] != 0)
        new = {s: k for k, s in enumerate(order)}
        self.first_end = sum(not e for e in whole.ends)
        self.ends = [whole.ends[s] for s in order]
        self.start = new[whole.start]
        self.rows: list = [None] * len(order)
        for s in order:
            self.rows[new[s]] = [new[t] for t in whole.step[s * 256 : s * 256 + 256]]
        self.states = len(order)
        self.single = [automaton([r.pattern], anywhere=False) for r in self.rules]
        self.reverse = [automaton([r.pattern], anywhere=True, backwards=True) for r in self.rules]

    def seen(self, data: bytes) -> int:
        """The rules that end anywhere in the bytes, as bits: the one pass over every text."""
        rows, limit, found = self.rows, self.first_end, 0
        state, row = self.start, self.rows[self.start]
        for b in data:
            state = row[b]
            if state >= limit:
                found |= self.ends[state]
            row = rows[state]
        return found

    def begins(self, rule: int, data: bytes) -> list[int]:
        """Where a match of one rule begins, from the last to the first: a pass of its reversed automaton."""
        step, ends, state = self.reverse[rule].step, self.reverse[rule].ends, self.reverse[rule].start
        found, at = [], len(data)
        for b in reversed(data):
            at -= 1
            state = step[state * 256 + b]
            if ends[state]:
                found.append(at)
        return found

    def matches(self, rule: int, data: bytes) -> Iterator[tuple[int, int]]:
        """Leftmost longest matches of one rule, each after the end of the one before.

        Only from where a match begins is the rule's automaton run, so no byte is tried in vain
        and the time is linear in the text.
        """
        dfa, n, upto = self.single[rule], len(data), 0
        step, ends, dead = dfa.step, dfa.ends, dfa.dead
        for at in reversed(self.begins(rule, data)):
            if at < upto:
                continue
            state, k = dfa.start, at
            while k < n:
                state = step[state * 256 + data[k]]
                if state == dead:
                    break
                k += 1
                if ends[state]:
                    upto = k
            yield at, upto

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(start, rule number, end) of every match that counts, in code points, in order."""
        data = text.encode("utf-8", "surrogatepass")
        found, seen = [], self.seen(data)
        for r, rule in enumerate(self.rules):
            if not seen >> r & 1:
                continue
            for start, end in self.matches(r, data):
                piece = data[start:end].decode("ascii")
                if len(_value(piece) if rule.assigned else piece) >= rule.least:
                    found.append((start, r, end))
        if len(data) != len(text):
            at = {}
            point = before = 0
            for place in sorted({p for s, _, e in found for p in (s, e)}):
                point += len(data[before:place].decode("utf-8", "surrogatepass"))
                at[place], before = point, place
            found = [(at[s], r, at[e]) for s, r, e in found]
        return sorted(found)


def _value(match: str) -> str:
    sign = min(k for k in (match.find(":"), match.find("=")) if k >= 0)
    value = match[sign + 1 :].lstrip(" ")
    return value[1:] if value[:1] in ("'", '"') else value


@lru_cache(maxsize=4)
def scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


SPANS = "doc_id long, spans array<struct<start:int,end:int,kind:string,base:boolean>>"
_SPANS = pa.schema(
    [
        ("doc_id", pa.int64()),
        (
            "spans",
            pa.list_(
                pa.struct([("start", pa.int32()), ("end", pa.int32()), ("kind", pa.string()), ("base", pa.bool_())])
            ),
        ),
    ]
)


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """All secrets in the whole text of every row of (doc_id, text).

    One row per input row: doc_id and spans (start, end in code points, end exclusive; kind;
    base), ordered by start, then by the order of the rules. A null or empty text has none.
    Repeated rows give a row each; an empty table gives no rows; other columns are ignored.
    """
    rules = tuple(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = scanner(rules)
        for part in slices(batches):
            found = [
                [{"start": s, "end": e, "kind": rules[r].kind, "base": rules[r].base} for s, r, e in find.spans(t)]
                for t in texts(part)
            ]
            yield record(_SPANS, part.column("doc_id"), found)

    return plain(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id", "text").mapInArrow(run, SPANS)


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts and digests of the spans of :func:`scan`."""
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in ("assign", "access", "hex")],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )


def redact(docs: DataFrame, rules: Sequence[Rule] = RULES, mark: str = "[{}]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by its kind; overlapping spans become one.

    All columns stay; a null text stays null, a text without secrets is unchanged.
    """
    rules = tuple(rules)

    @F.pandas_udf("string")
    def clean(column):
        find = scanner(rules)

        def one(text):
            if not text or not (spans := find.spans(text)):
                return text
            parts, at = [], 0
            for start, r, end in spans:
                if start >= at:
                    parts += [text[at:start], mark.format(rules[r].kind)]
                at = max(at, end)
            return "".join([*parts, text[at:]])

        return column.map(one)

    return docs.withColumn("text", clean("text"))
