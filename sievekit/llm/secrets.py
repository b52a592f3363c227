"""Secret scans by one combined deterministic automaton.

All rule patterns are compiled together: each pattern becomes a position
automaton, their union goes through subset construction over byte classes,
and partition refinement minimises the result into one transition array.
A document is scanned once, byte by byte from its end, by the automaton of
the reversed patterns; a state that accepts rule r at a byte says that a
match of r starts there.  Known starts are extended forwards by the rule's
own (anchored) automaton, so each rule gets its leftmost, longest,
non-overlapping matches.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held, id_text, id_text_batches, parts_of


@dataclass(frozen=True)
class Rule:
    """``pattern``: literals, escapes, classes, groups, ``|``, ``? * +`` and
    ``{m}``, ``{m,}``, ``{m,n}`` over ASCII.  A match counts if the part that
    ``value`` (a Python pattern with one group, applied to the match) captures,
    or else the whole match, has ``least`` characters or more."""

    kind: str
    pattern: str
    least: int = 1
    value: str | None = None


def either_case(word: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in word)


_KEYS = "|".join(f"{either_case(w)}{opt}" for w, opt in (
    ("password", ""), ("passwd", ""), ("secret", ""), ("token", ""), ("api", "_?" + either_case("key"))))
_VALUE = "[A-Za-z0-9+/_.=-]+"
#: The three kinds whose spans form the base digest, in this order.  A run of
#: hex digits counts from 24 on, which is the same as matching whole runs and
#: dropping shorter ones, and spares the automaton every lone letter.
BASE_RULES = (
    Rule("assign", f"({_KEYS})[\"']?\\x20*[:=]\\x20*[\"']?{_VALUE}", 6, f"^[^:=]*[:=]\\x20*[\"']?({_VALUE})$"),
    Rule("access", "AKIA[A-Z0-9]+", 20),
    Rule("hex", "[0-9a-f]{24,}", 24),
)
MORE_RULES = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES


# ------------------------------------------------------------- compilation
class _Parse:
    """Pattern text to a tree of ("set", mask), ("cat", [..]), ("alt", [..]),
    ("rep", node, least, most or None)."""

    def __init__(self, text: str):
        self.text, self.at = text, 0
        self.tree = self.alt()
        if self.at != len(text):
            raise ValueError(f"unbalanced pattern: {text}")

    def peek(self) -> str:
        return self.text[self.at:self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def alt(self):
        parts = [self.cat()]
        while self.peek() == "|":
            self.take()
            parts.append(self.cat())
        return parts[0] if len(parts) == 1 else ("alt", parts)

    def cat(self):
        parts = []
        while self.peek() not in ("", "|", ")"):
            parts.append(self.repeated(self.atom()))
        return ("cat", parts)

    def repeated(self, node):
        while self.peek() and self.peek() in "?*+{":
            c = self.take()
            if c == "{":
                low, _, high = (end := self.text[self.at:self.text.index("}", self.at)]).partition(",")
                self.at += len(end) + 1
                node = ("rep", node, int(low), int(high) if high else None if "," in end else int(low))
            else:
                node = ("rep", node, int(c == "+"), 1 if c == "?" else None)
        return node

    def atom(self):
        c = self.take()
        if c == "(":
            node = self.alt()
            if self.take() != ")":
                raise ValueError(f"unbalanced pattern: {self.text}")
            return node
        if c == "[":
            return ("set", self.klass())
        return ("set", 1 << self.char(c))

    def char(self, c: str) -> int:
        if c == "\\":
            c = self.take()
            if c == "x":
                self.at += 2
                return int(self.text[self.at - 2:self.at], 16)
        if ord(c) > 127:
            raise ValueError("patterns are ASCII")
        return ord(c)

    def klass(self) -> int:
        mask, last = 0, None
        while (c := self.take()) != "]":
            if c == "-" and last is not None and self.peek() != "]":
                high = self.char(self.take())
                mask |= sum(1 << b for b in range(last, high + 1))
                last = None
            else:
                last = self.char(c)
                mask |= 1 << last
        return mask


class _Positions:
    """Position automaton of several patterns; a set of positions is an int."""

    def __init__(self) -> None:
        self.sets: list[int] = []
        self.follow: list[int] = []
        self.first, self.last = 0, []

    def add(self, tree, reverse: bool) -> None:
        empty, first, last = self.build(tree, reverse)
        if empty:
            raise ValueError("a rule must not match the empty text")
        self.first |= first
        self.last.append(last)

    def link(self, a: int, b: int) -> None:
        for p in _bits(a):
            self.follow[p] |= b

    def build(self, node, reverse: bool) -> tuple[bool, int, int]:
        kind = node[0]
        if kind == "set":
            self.sets.append(node[1])
            self.follow.append(0)
            return False, (p := 1 << len(self.sets) - 1), p
        if kind == "alt":
            parts = [self.build(x, reverse) for x in node[1]]
            return any(p[0] for p in parts), _union(p[1] for p in parts), _union(p[2] for p in parts)
        if kind == "cat":
            return self.chain([self.build(x, reverse) for x in (node[1][::-1] if reverse else node[1])])
        _, inner, low, high = node
        parts = [self.build(inner, reverse) for _ in range(low)]
        if high is None:
            if not parts:
                e, f, last = self.build(inner, reverse)
                self.link(last, f)
                return True, f, last
            self.link(parts[-1][2], parts[-1][1])
        else:
            parts += [(True, f, last) for _, f, last in (self.build(inner, reverse) for _ in range(high - low))]
        return self.chain(parts)

    def chain(self, parts: list[tuple[bool, int, int]]) -> tuple[bool, int, int]:
        empty, first, last = True, 0, 0
        for e, f, m in parts:
            self.link(last, f)
            first |= f if empty else 0
            last = m | (last if e else 0)
            empty &= e
        return empty, first, last


def _bits(mask: int):
    while mask:
        low = mask & -mask
        yield low.bit_length() - 1
        mask ^= low


def _union(masks) -> int:
    out = 0
    for m in masks:
        out |= m
    return out


@dataclass(frozen=True)
class Automaton:
    """``table[state, byte]`` is the next state, ``accept[state]`` has a bit for
    each rule; state 0 is the start."""

    table: np.ndarray
    accept: np.ndarray


def compile_rules(patterns: tuple[str, ...], reverse: bool, anywhere: bool) -> Automaton:
    """Subset construction over byte classes, then minimisation.  ``anywhere``:
    a match may start at every byte (else only at the first)."""
    auto = _Positions()
    for p in patterns:
        auto.add(_Parse(p).tree, reverse)
    kinds: dict[tuple, int] = {}
    byte_class = np.array([kinds.setdefault(tuple(p for p, s in enumerate(auto.sets) if s >> b & 1), len(kinds))
                           for b in range(256)])
    allowed = [sum(1 << p for p in key) for key in kinds]
    begin = 1 << len(auto.sets)
    states, rows, todo = {begin: 0}, [], [begin]
    while todo:
        nxt = []
        for s in todo:
            reach = auto.first if anywhere or s == begin else 0
            reach |= _union(auto.follow[p] for p in _bits(s & (begin - 1)))
            row = []
            for mask in allowed:
                t = reach & mask
                if t not in states:
                    states[t] = len(states)
                    nxt.append(t)
                row.append(states[t])
            rows.append(row)
        todo = nxt
    table = np.array(rows)
    accept = np.array([sum(1 << r for r, last in enumerate(auto.last) if s & last) for s in states])
    # the states fall into blocks that no further byte tells apart
    block = np.unique(accept, return_inverse=True)[1].ravel()
    while True:
        finer = np.unique(np.column_stack([block, block[table]]), axis=0, return_inverse=True)[1].ravel()
        if finer.max() == block.max():
            break
        block = finer
    order = np.full(block.max() + 1, -1)
    order[block[0]] = 0
    k = 1
    for b in block:
        if order[b] < 0:
            order[b] = k
            k += 1
    block = order[block]
    small = np.zeros((k, len(allowed)), int)
    small[block] = block[table]
    flags = np.zeros(k, int)
    flags[block] = accept
    return Automaton(small[:, byte_class].astype(np.int32), flags)


def _linked(a: Automaton) -> list:
    """The table as lists that point at each other: 256 next states, then the
    accepted rules, then whether no byte leads elsewhere."""
    rows: list[list] = [[] for _ in range(len(a.table))]
    for k, row in enumerate(rows):
        row += [rows[n] for n in a.table[k]]
        row += [int(a.accept[k]), bool((a.table[k] == k).all())]
    return rows[0]


class Scanner:
    """Compiled rules; ``spans(text)`` gives (start, end, kind number)."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.starts = _linked(compile_rules(tuple(r.pattern for r in rules), True, True))
        self.extend = [_linked(compile_rules((r.pattern,), False, False)) for r in rules]
        self.value = [re.compile(r.value) if r.value else None for r in rules]

    def raw(self, data: bytes) -> list[tuple[int, int, int]]:
        """Byte spans of the leftmost non-overlapping matches of each rule."""
        row, runs, last, now = self.starts, [], len(data) - 1, 0
        for i, b in enumerate(data[::-1]):
            row = row[b]
            if row[256] != now:  # neighbouring starts of the same rules are one run: its last place, then its first
                if now:
                    runs[-1][1] = last - i + 1
                now = row[256]
                if now:
                    runs.append([last - i, 0, now])
        done, out = [0] * len(self.rules), []
        for last, first, found in reversed(runs):
            for r in _bits(found):
                at = max(first, done[r])
                while at <= last:
                    row, end, i = self.extend[r], at, at
                    while i < len(data):
                        row = row[data[i]]
                        i += 1
                        if row[256]:
                            end = i
                        elif row[257]:
                            break
                    done[r] = end
                    out.append((at, end, r))
                    at = max(end, at + 1)
        return out

    def spans(self, text: str | None) -> list[tuple[int, int, int]]:
        """Code-point spans of the matches that are long enough, by start, then kind."""
        if not text:
            return []
        data = text.encode("utf-8", "surrogatepass")
        found = self.raw(data)
        if found and len(data) != len(text):
            points, at, n = {}, 0, 0
            for p in sorted({x for s, e, _ in found for x in (s, e)}):
                n += len(data[at:p].decode("utf-8", "surrogatepass"))
                points[p], at = n, p
            found = [(points[s], points[e], r) for s, e, r in found]
        return sorted((s, e, r) for s, e, r in found if self.enough(text[s:e], r)) if found else []

    def enough(self, match: str, r: int) -> bool:
        if self.value[r]:
            match = self.value[r].search(match)[1]
        return len(match) >= self.rules[r].least

    def digest(self, spans: list[tuple[int, int, int]]) -> str:
        spans = sorted(spans, key=lambda x: (x[0], x[2]))
        return ",".join(f"{self.rules[r].kind}:{s}:{e}" for s, e, r in spans)


def scanner(rules: tuple[Rule, ...]) -> Scanner:
    """One compiled scanner per Python worker."""
    return held(("scanner", rules), lambda: Scanner(rules))


# ---------------------------------------------------------------- operators
def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row for each row of ``docs``: ``doc_id`` and ``spans``, an array of
    (kind, start, end) in code points, by start, then in the order of ``rules``.

    A null or empty text has no spans; repeated rows give repeated results; a
    null key stays null; other columns are not read.  One map over the rows, no
    shuffle; a text is scanned whole."""

    def run(batches):
        scan = scanner(rules)
        for ids, texts in id_text_batches(batches):
            found = [[{"kind": rules[r].kind, "start": s, "end": e}
                      for s, e, r in sorted(scan.spans(t), key=lambda x: (x[0], x[2]))] for t in texts]
            yield pa.RecordBatch.from_arrays([ids, pa.array(found, _SPANS)], ["doc_id", "spans"])

    return id_text(docs, id_col, text_col).mapInArrow(
        run, "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint>>")


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def redact_secrets(docs: DataFrame, text_col: str = "text", mask: str = "[SECRET]",
                   rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with every span of its text replaced by ``mask`` (overlapping
    spans by one); all columns and rows stay, also repeated ones, null keys and
    columns of any name.  A null text stays null, an empty one empty; texts are
    scanned whole; an empty table stays empty."""
    at = docs.columns.index(text_col)

    def run(batches):
        scan = scanner(rules)
        for b in parts_of(batches):
            out = []
            for t in b.column(at).to_pylist():
                parts, end = [], 0
                for s, e, _ in scan.spans(t):
                    if s >= end:
                        parts += [t[end:s], mask]
                    end = max(end, e)
                out.append("".join([*parts, t[end:]]) if parts else t)
            cols = list(b.columns)
            cols[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=[str(k) for k in range(len(cols))])

    plain = docs.toDF(*map(str, range(len(docs.columns))))
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def secrets_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns, from the spans of ``scan_secrets``, a row for each
    row of ``docs``; a null or empty text has no spans."""
    found = scan_secrets(docs)
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in BASE_RULES]))
    text = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select("doc_id", *(count(r.kind).alias(f"n_{r.kind}") for r in BASE_RULES),
                        F.sha2(text(base).cast("binary"), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))


def digest_of(text: str | None, rules: tuple[Rule, ...] = RULES) -> tuple[str, str]:
    """Base digest and span string of one text, without Spark."""
    scan = scanner(rules)
    spans = scan.spans(text)
    base = scan.digest([x for x in spans if x[2] < len(BASE_RULES)])
    return hashlib.sha256(base.encode()).hexdigest(), scan.digest(spans)
