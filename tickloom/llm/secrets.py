"""Secret scan with one combined deterministic automaton.

The rules' regular expressions are compiled to one automaton: positions and
jumps (Thompson), subset construction over byte classes, minimisation by
refining classes of states, and a transition array.  The array reads every
byte of every line once for all rules; a state that cannot be left marks a
line that holds a match.  Marked lines are read once more, backwards, by the
automaton of the reversed rules: its states are tagged with the rules of which a
match begins at the byte just read.  From these places alone, leftmost first, the
automaton of the rule runs to the longest end, so a line costs time in proportion
to its length, whatever it holds.  Matches stay inside a line; one of a rule in
``BLOCKS`` is then carried on over line ends: a private key goes up to its END mark, whatever lies
between, or, where that is missing before the next key or the end of the text,
over the headers and base64 lines that follow.

Defined results: NULL and empty texts have no spans; every row keeps its own
result, repeated rows too; other columns pass through, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F, types as T

from tickloom.llm.common import SPANS, free_name, per_text, prepare, replace_spans, spans_text, with_text

# Kind, expression, least length of the whole match.
# [..] classes, (..) groups, | ? * + {n}; (?i) makes a rule ignore case.
RULES = [
    ("assign", r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9+/_.=-]+", 0),
    ("access", r"AKIA[A-Z0-9]+", 20),
    ("hex", r"[0-9a-f]{24}[0-9a-f]*", 24),
    ("github", r"gh[pousr]_[A-Za-z0-9]+", 40),
    ("slack", r"xox[abprs]-[A-Za-z0-9-]+", 15),
    ("google", r"AIza[A-Za-z0-9_-]+", 39),
    ("stripe", r"[sr]k_(live|test)_[A-Za-z0-9]+", 24),
    ("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 40),
    ("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0),
]
BASE = ("assign", "access", "hex")
VALUE = frozenset(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-")
LEAST_VALUE = 6
# What a match opens, over line ends: the marks that end it, and what it takes without an END.
# A gap may also be a line end written as \n, a quote or the sign of a quoted line.
_GAP = rb"(?:[\s\"',;>#|*]|\\[nrt])*+"
BLOCKS = {"private_key": (
    re.compile(rb"-----(BEGIN|END) [A-Z ]*PRIVATE KEY-----"),
    re.compile(rb"(?:" + _GAP + rb"(?:Proc-Type|DEK-Info|Comment|Version): [^\n\\]*+)*+"
               rb"(?:(?:" + _GAP + rb"[A-Za-z0-9+/=]{16,}+)++"
               rb"(?:" + _GAP + rb"[A-Za-z0-9+/]{1,15}+={0,2}+(?=[ \t]*+(?:[\r\n\"']|\\[nr]|\Z)))?)?"))}
FEW = 6  # lines still long enough: below this many, one loop per line is quicker


class _Parser:
    """A regular expression over bytes as a nondeterministic automaton."""

    def __init__(self, pattern: str):
        self.fold = pattern.startswith("(?i)")
        self.text, self.i = pattern.removeprefix("(?i)"), 0
        self.edges: list[tuple[frozenset[int], int] | None] = []  # of each state: bytes, next
        self.jumps: list[list[int]] = []

    def state(self) -> int:
        self.edges.append(None)
        self.jumps.append([])
        return len(self.edges) - 1

    def peek(self) -> str:
        return self.text[self.i:self.i + 1]

    def either(self) -> tuple[int, int]:
        a, b = self.state(), self.state()
        while True:
            first, last = self.row()
            self.jumps[a].append(first)
            self.jumps[last].append(b)
            if self.peek() != "|":
                return a, b
            self.i += 1

    def row(self) -> tuple[int, int]:
        first = last = self.state()
        while self.peek() not in ("", "|", ")"):
            at = self.i
            a, b = self.one()
            if self.peek() == "{":
                times = int(self.text[self.i + 1:(close := self.text.index("}", self.i))])
                for _ in range(times - 1):  # the piece is read again for each repetition
                    self.i = at
                    c, d = self.one()
                    self.jumps[b].append(c)
                    b = d
                self.i = close + 1
            elif (sign := self.peek()) in ("?", "*", "+") and sign:
                self.i += 1
                c, d = self.state(), self.state()
                self.jumps[c].append(a)
                self.jumps[b].append(d)
                if sign != "+":
                    self.jumps[c].append(d)
                if sign != "?":
                    self.jumps[b].append(a)
                a, b = c, d
            self.jumps[last].append(a)
            last = b
        return first, last

    def one(self) -> tuple[int, int]:
        c = self.peek()
        if c == "(":
            self.i += 1
            inner = self.either()
            self.i += 1
            return inner
        chosen = self.choice() if c == "[" else frozenset([self.char()])
        if self.fold:
            chosen = frozenset(b for x in chosen for b in bytes([x]).lower() + bytes([x]).upper())
        a, b = self.state(), self.state()
        self.edges[a] = chosen, b
        return a, b

    def char(self) -> int:
        c = self.text[self.i]
        if c != "\\":
            self.i += 1
            return ord(c)
        if self.text[self.i + 1] == "x":
            self.i += 4
            return int(self.text[self.i - 2:self.i], 16)
        self.i += 2
        return ord(self.text[self.i - 1])

    def choice(self) -> frozenset[int]:
        self.i += 1
        out: set[int] = set()
        while self.peek() != "]":
            low = high = self.char()
            if self.peek() == "-" and self.text[self.i + 1] != "]":
                self.i += 1
                high = self.char()
            out.update(range(low, high + 1))
        self.i += 1
        return frozenset(out)


class Automaton:
    """Deterministic and minimal.  anywhere: a match may begin at any byte, and
    the state after a match is never left; else a match begins at the first byte."""

    def __init__(self, patterns: Iterable[str], anywhere: bool):
        edges: list[tuple[frozenset[int], int] | None] = []
        jumps: list[list[int]] = []
        starts, goals = [], set()
        for pattern in patterns:
            parser = _Parser(pattern)
            a, b = parser.either()
            shift = len(edges)
            starts.append(a + shift)
            goals.add(b + shift)
            edges += [e and (e[0], e[1] + shift) for e in parser.edges]
            jumps += [[j + shift for j in js] for js in parser.jumps]
        self.classes, samples = _byte_classes([e[0] for e in edges if e])
        self.width = len(samples)
        reach = [_reach(s, jumps) for s in range(len(edges))]
        first = frozenset().union(*(reach[s] for s in starts))
        table, accepts = _subsets(first, edges, reach, goals, samples, anywhere)
        self.table, self.accepts = _minimal(table, accepts)
        # Two states of note: 0 is the start; the dead state, if any, leads to itself only.
        self.flat = (np.array(self.table, np.int32) * self.width).ravel()
        self.accept_flat = np.zeros(len(self.flat), bool)
        self.accept_flat[np.flatnonzero(self.accepts) * self.width] = True
        self.dead = {s for s, row in enumerate(self.table) if not self.accepts[s] and set(row) == {s}}

    def longest(self, coded: bytes, start: int) -> int:
        """End of the longest match at start, or -1."""
        state, end = 0, -1
        for i in range(start, len(coded)):
            state = self.table[state][coded[i]]
            if self.accepts[state]:
                end = i + 1
            elif state in self.dead:
                break
        return end

    def hold_match(self, data: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Which lines of data hold a match: all lines step on together, the
        longest first, so that those still running stay in front."""
        order = np.argsort(-lengths, kind="stable")
        coded = np.frombuffer(data.translate(self.classes), np.uint8)
        at, left = starts[order].astype(np.int64), lengths[order]
        state = np.zeros(len(at), np.int32)
        running = len(left) - np.searchsorted(left[::-1], np.arange(left[0] if len(left) else 0), "right")
        for step, n in enumerate(running.tolist()):
            if n < FEW:
                for k in range(n):
                    state[k] = self._walk(coded[at[k]:at[k] + left[k] - step].tobytes(), int(state[k]))
                break
            state[:n] = self.flat[state[:n] + coded[at[:n]]]
            at[:n] += 1
        found = np.zeros(len(order), bool)
        found[order] = self.accept_flat[state]
        return found

    def _walk(self, coded: bytes, state: int) -> int:
        state //= self.width
        rows = self.table
        for c in coded:
            state = rows[state][c]
        return state * self.width


class Starts:
    """The combined automaton of the reversed rules: read backwards from the end of
    a line, a state tells the rules of which a match begins here."""

    def __init__(self, patterns: Iterable[str]):
        edges: list[tuple[frozenset[int], int] | None] = []
        jumps: list[list[int]] = []
        begins, rule_of = [], {}
        for k, pattern in enumerate(patterns):
            parser = _Parser(pattern)
            a, b = parser.either()
            shift = len(edges)
            own = len(parser.edges)
            edges += [None] * own
            jumps += [[] for _ in range(own)]
            for state, edge in enumerate(parser.edges):
                if edge:
                    # A state has one edge; those that end in one place get states of their own.
                    jumps[edge[1] + shift].append(len(edges))
                    edges.append((edge[0], state + shift))
                    jumps.append([])
            for state, targets in enumerate(parser.jumps):
                for target in targets:
                    jumps[target + shift].append(state + shift)
            begins.append(b + shift)
            rule_of[a + shift] = k
        self.classes, samples = _byte_classes([e[0] for e in edges if e])
        reach = [_reach(s, jumps) for s in range(len(edges))]
        first = frozenset().union(*(reach[s] for s in begins))
        tags: list[int] = []
        table, _ = _subsets(first, edges, reach, set(), samples, True, lambda subset: tags.append(
            sum(1 << k for s, k in rule_of.items() if s in subset)))
        self.table, self.tags = _minimal(table, tags)
        self.rules = [[k for k in range(len(begins)) if t >> k & 1] for t in self.tags]

    def of(self, line: bytes) -> dict[int, list[int]]:
        """rule -> places where a match of it begins, the last one first."""
        out: dict[int, list[int]] = {}
        state, table, rules = 0, self.table, self.rules
        coded = line.translate(self.classes)
        for i in range(len(coded) - 1, -1, -1):
            state = table[state][coded[i]]
            for k in rules[state]:
                out.setdefault(k, []).append(i)
        return out


def _byte_classes(sets: list[frozenset[int]]) -> tuple[bytes, list[int]]:
    """Bytes that no rule tells apart share a class; a sample byte of each."""
    seen: dict[tuple[bool, ...], int] = {}
    distinct = list(dict.fromkeys(sets))
    classes, samples = bytearray(256), []
    for b in range(256):
        k = seen.setdefault(tuple(b in s for s in distinct), len(seen))
        if k == len(samples):
            samples.append(b)
        classes[b] = k
    return bytes(classes), samples


def _reach(state: int, jumps: list[list[int]]) -> frozenset[int]:
    out, todo = {state}, [state]
    while todo:
        for nxt in jumps[todo.pop()]:
            if nxt not in out:
                out.add(nxt)
                todo.append(nxt)
    return frozenset(out)


def _subsets(first, edges, reach, goals, samples, anywhere, visit=lambda subset: None) -> tuple[list[list[int]], list[bool]]:
    number, todo, table, accepts = {first: 0}, [first], [], []
    while todo:
        subset = todo.pop(0)
        visit(subset)
        goal = not goals.isdisjoint(subset)
        accepts.append(goal)
        row = []
        for b in samples:
            if goal and anywhere:
                new = subset
            else:
                new = frozenset().union(*(reach[e[1]] for s in subset if (e := edges[s]) and b in e[0]), first if anywhere else ())
            if new not in number:
                number[new] = len(number)
                todo.append(new)
            row.append(number[new])
        table.append(row)
    return table, accepts


def _minimal(table: list[list[int]], accepts: list) -> tuple[list[list[int]], list]:
    """States with the same future, and the same flag or tag, become one; the start stays 0."""
    block = [int(a) for a in accepts]
    while True:
        seen: dict[tuple, int] = {}
        new = [seen.setdefault((block[s], *(block[t] for t in row)), len(seen)) for s, row in enumerate(table)]
        if len(seen) == len(set(block)):
            break
        block = new
    block = new
    rows: dict[int, list[int]] = {}
    flags: dict[int, object] = {}
    for s, row in enumerate(table):
        rows.setdefault(block[s], [block[t] for t in row])
        flags.setdefault(block[s], accepts[s])
    return [rows[k] for k in range(len(rows))], [flags[k] for k in range(len(rows))]


@lru_cache(maxsize=2)
def compiled(rules: tuple[tuple[str, str, int], ...]) -> tuple[Automaton, Starts, list[tuple[str, int, Automaton]]]:
    """One automaton for the pass over all bytes, one for the starts in a marked line, one per rule for the ends."""
    patterns = [p for _, p, _ in rules]
    return (Automaton(patterns, anywhere=True), Starts(patterns),
            [(kind, least, Automaton([p], anywhere=False)) for kind, p, least in rules])


def line_spans(line: bytes, starts: Starts, rules) -> list[tuple[int, int, int]]:
    """(start, rule, end) in bytes, leftmost and longest, without overlaps within a
    rule; matches that fail their length are gone, and not tried again."""
    out = []
    for k, places in sorted(starts.of(line).items()):
        kind, least, automaton = rules[k]
        coded, end = line.translate(automaton.classes), 0
        for start in reversed(places):
            if start < end:
                continue
            end = automaton.longest(coded, start)
            value = end - start
            if kind == "assign":  # the value is what follows the last sign of the match that no value holds
                value = _value_length(line[start:end])
                if value < LEAST_VALUE:
                    continue
            elif value < least:
                continue
            out.append((start, k, end))
    return out


def block_end(kind: str, data: bytes, end: int, last: int) -> int:
    """Where the block that a match up to end opens is over; last is the end of the text."""
    mark, body = BLOCKS[kind]
    other = mark.search(data, end, last)
    if other and other[1] == b"END":
        return other.end()
    return body.match(data, end, other.start() if other else last).end()


def _value_length(match: bytes) -> int:
    """Length of the value of an assignment: after the key, a quote, spaces,
    one sign, spaces and a quote."""
    i = 0
    while match[i:i + 1] not in (b":", b"="):
        i += 1
    i += 1
    while match[i:i + 1] == b" ":
        i += 1
    return len(match) - i - (match[i:i + 1] in (b'"', b"'"))


def _scanner(rules):
    detect, first, single = compiled(rules)

    def scan(texts: list[bytes | None]):
        data = b"\n".join(t or b"" for t in texts) + b"\n"
        byte = np.frombuffer(data, np.uint8)
        ends = np.flatnonzero(byte == 10)
        starts = np.concatenate(([0], ends[:-1] + 1))
        lengths = np.array([len(t or b"") for t in texts])
        begins = np.concatenate(([0], np.cumsum(lengths + 1)[:-1]))
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        last, at, shift = -1, 0, 0  # document, byte and code point up to which characters are counted
        for k in np.flatnonzero(detect.hold_match(data, starts, ends - starts)).tolist():
            d = int(np.searchsorted(begins, starts[k], "right")) - 1
            if d != last:
                last, at, shift = d, int(begins[d]), 0
            shift += int(np.count_nonzero((byte[at:starts[k]] & 0xC0) != 0x80))
            at = int(starts[k])
            line = data[at:ends[k]]
            if spans := line_spans(line, first, single):
                points = np.concatenate(([0], np.cumsum((byte[at:ends[k]] & 0xC0) != 0x80))) + shift
                for a, k2, b in spans:
                    to = int(points[b])
                    if single[k2][0] in BLOCKS:
                        over = block_end(single[k2][0], data, at + b, int(begins[d] + lengths[d]))
                        to += int(np.count_nonzero((byte[at + b:over] & 0xC0) != 0x80))
                    out[d].append((int(points[a]), k2, to))
        return ([[{"kind": single[k][0], "start": a, "end": b} for a, k, b in sorted(spans)] for spans in out],)

    return scan


def scan(docs: DataFrame, name: str, rules=tuple(RULES)) -> DataFrame:
    """docs with the struct column name, whose field spans lists kind, start
    and end (code points) by start, then by the order of the rules."""
    prepare(docs.sparkSession)
    return per_text(docs, "text", name, T.StructType([T.StructField("spans", SPANS)]), lambda: _scanner(rules))


def merged(spans):
    """Spans that overlap or touch as one, in order."""
    joined = lambda acc, s: F.when(
        (F.size(acc) > 0) & (F.element_at(acc, -1)["end"] >= s["start"]),
        F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(
            F.element_at(acc, -1)["start"].alias("start"),
            F.greatest(F.element_at(acc, -1)["end"], s["end"]).alias("end"))))
    ).otherwise(F.concat(acc, F.array(F.struct(s["start"].alias("start"), s["end"].alias("end")))))
    return F.aggregate(spans, F.array().cast("array<struct<start:bigint,end:bigint>>"), joined)


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """docs with every secret replaced by mark."""
    name = free_name(docs.columns, "found")
    found = scan(docs, name)
    return with_text(found, replace_spans(F.col("text"), merged(F.col(name)["spans"]), mark), drop=name)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    found = scan(docs.select("doc_id", "text"), "found")
    spans = F.col("found")["spans"]
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", *[count(kind) for kind in BASE],
        F.sha2(spans_text(F.filter(spans, lambda s: s["kind"].isin(*BASE))), 256).alias("base_sha256"),
        spans_text(spans).alias("spans"))
