"""Benchmark decontamination with a broadcast set of normalised word windows.

A word is a run of ASCII letters (A-Z lower-cased), digits and characters from
U+0080 on.  An item of the benchmark gives every window of ten consecutive
words, a shorter item with words one window of all its words, an item without
words (NULL, empty) none.  A document word inside any occurrence of a window
is hit.

The windows of at most ``BLOCK_BYTES`` of benchmark text are broadcast at a
time; a larger benchmark goes over the documents in several such blocks, and
the hits are united.  Hash hits are confirmed word by word.

Defined results: NULL and empty texts have no words and no hits; repeated
documents and repeated item ids each count once per row or id; a NULL item id
is written as empty text; an empty benchmark hits nothing; other columns of
the documents pass through, whatever their names.
"""

from __future__ import annotations

import re
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F, types as T

from tickloom.llm.common import blocks_for, free_name, per_text, prepare, replace_spans, with_text, written

WINDOW = 10
BLOCK_BYTES = 8 << 20
# Lower-cases A-Z and turns every other ASCII character that ends a word into a space.
NORMALISE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
WORD = re.compile(rb"[^ ]+")
BETWEEN = b"~"  # cannot be a word

RANGES = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
FOUND = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("words", RANGES),  # runs of hit words, counted in words
    T.StructField("spans", RANGES),  # the same runs in code points
])


class Windows:
    """The windows of one block of the benchmark as sorted hashes."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.ids: dict[bytes, int] = {BETWEEN: -2}
        self.names = sorted({name for name, _ in items})
        number = {name: i for i, name in enumerate(self.names)}
        starts: dict[int, list[tuple[int, int]]] = {}
        stream: list[int] = []
        for name, text in items:
            words = text.translate(NORMALISE).split()
            if not words:
                continue
            size = min(window, len(words))
            first = len(stream)
            stream += [self.ids.setdefault(w, len(self.ids) - 1) for w in words]
            starts.setdefault(size, []).extend(
                (first + i, number[name]) for i in range(len(words) - size + 1))
        self.stream = np.array(stream, np.int64)
        self.code = np.random.default_rng(7).integers(1, 2**63, len(self.ids) + 1, dtype=np.uint64)
        self.by_size = {}
        for size, where in starts.items():
            at, item = np.array(where, np.int64).T
            hashes = self.hashes(self.stream, at, size)
            order = np.argsort(hashes, kind="stable")
            self.by_size[size] = hashes[order], at[order], item[order]

    def hashes(self, ids: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
        out = np.zeros(len(at), np.uint64)
        for i in range(size):
            out = out * np.uint64(0x9E3779B97F4A7C15) + self.code[ids[at + i]]
        return out

    def occurrences(self, ids: np.ndarray):
        """(position, size, item) of every window in a row of word ids."""
        known = np.concatenate(([0], np.cumsum(ids >= 0)))
        for size, (hashes, at, item) in self.by_size.items():
            if len(ids) < size:
                continue
            here = np.flatnonzero(known[size:] - known[:-size] == size)
            if not len(here):
                continue
            wanted = self.hashes(ids, here, size)
            low = np.searchsorted(hashes, wanted, "left")
            hit = low < len(hashes)
            hit[hit] = hashes[low[hit]] == wanted[hit]
            here, low = here[hit], low[hit]
            count = np.searchsorted(hashes, wanted[hit], "right") - low
            here, entry = np.repeat(here, count), np.repeat(low - np.cumsum(count) + count, count) + np.arange(count.sum())
            same = np.ones(len(here), bool)
            for i in range(size):
                same &= ids[here + i] == self.stream[at[entry] + i]
            yield here[same], size, item[entry[same]]


def _scanner(windows: Windows, spans: bool):
    """Texts, and what earlier blocks found in them, to the fields of FOUND."""

    def scan(texts: list[bytes | None], earlier: list[dict] | None = None):
        normal = [(t or b"").translate(NORMALISE) for t in texts]
        words = (b" " + BETWEEN + b" ").join(normal).split()
        ids = np.fromiter(map(windows.ids.get, words, repeat(-1)), np.int64, len(words))
        ends = np.append(np.flatnonzero(ids == -2), len(ids))
        starts = np.append(0, ends[:-1] + 1)
        edge = np.zeros(len(ids) + 1, np.int64)
        pairs = []
        for here, size, item in windows.occurrences(ids):
            np.add.at(edge, here, 1)
            np.add.at(edge, here + size, -1)
            pairs.append(np.unique(np.searchsorted(ends, here, "right") * len(windows.names) + item))
        items: list[list[str]] = [[] for _ in texts]
        for pair in np.unique(np.concatenate(pairs)) if pairs else ():
            items[pair // len(windows.names)].append(windows.names[pair % len(windows.names)])
        for d, old in enumerate(earlier or ()):
            for run in old["words"]:
                edge[starts[d] + run["start"]] += 1
                edge[starts[d] + run["end"]] -= 1
            items[d] = sorted({*items[d], *old["items"]})
        hit = np.cumsum(edge[:-1]) > 0
        before = np.concatenate(([0], np.cumsum(hit)))
        n_hit = before[ends] - before[starts]
        runs: list[list[dict]] = [[] for _ in texts]
        places: list[list[dict]] = [[] for _ in texts]
        for d in np.flatnonzero(n_hit):
            turns = np.flatnonzero(np.diff(np.concatenate(([0], hit[starts[d]:ends[d]], [0])))).tolist()
            runs[d] = [{"start": a, "end": b} for a, b in zip(turns[::2], turns[1::2])]
            if spans:
                places[d] = _places(texts[d], normal[d], runs[d])
        return ends - starts, n_hit, items, runs, places

    return scan


def _places(text: bytes, normal: bytes, runs: list[dict]) -> list[dict]:
    """Runs of words as code points of the text."""
    points = np.concatenate(([0], np.cumsum((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)))
    words = [m.span() for m in WORD.finditer(normal)]
    return [{"start": int(points[words[r["start"]][0]]), "end": int(points[words[r["end"] - 1][1]])} for r in runs]


def find(docs: DataFrame, benchmark: DataFrame, name: str, spans: bool = True, window: int = WINDOW,
         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """docs with the struct column name: n_words, n_hit, items (ids as sorted
    strings), words and, if asked for, spans of the hits."""
    spark = prepare(docs.sparkSession)
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("binary").alias("text")
    ).where(F.length("text") > 0)
    blocks = blocks_for(items.agg(F.sum(F.length("text"))).first()[0] or 0, block_bytes)
    out = docs
    for k in range(blocks):
        part = items if blocks == 1 else items.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == k)
        sent = spark.sparkContext.broadcast(Windows([(r["item"], bytes(r["text"])) for r in part.collect()], window))
        start = lambda sent=sent: _scanner(sent.value, spans)
        if k == 0:
            out = per_text(out, "text", name, FOUND, start)
        else:
            more = free_name(out.columns, "more")
            out = per_text(written(out), "text", more, FOUND, start, also=[name]).drop(name).withColumnRenamed(more, name)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", window: int = WINDOW) -> DataFrame:
    """docs without benchmark passages: remove "documents" drops every document
    with a hit, "spans" cuts the runs of hit words out of the text."""
    name = free_name(docs.columns, "found")
    found = find(docs, benchmark, name, spans=remove == "spans", window=window)
    if remove == "spans":
        return with_text(found, replace_spans(F.col("text"), F.col(name)["spans"], " "), drop=name)
    return found.where(F.col(name)["n_hit"] == 0).drop(name)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find(docs.select("doc_id", "text"), benchmark, "found", spans=False)
    r = F.col("found")
    return found.select(
        "doc_id", r["n_words"].alias("n_words"), r["n_hit"].alias("n_hit"),
        F.size(r["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(r["items"], ","), 256).alias("items_sha256"),
        (r["n_hit"] > 0).alias("contaminated"))
