"""Ordinal quality grades by cumulative-link regression on hashed text.

Documents are graded 0, 1, 2, ...; one vector of weights over hashed features
of the text is shared by all grades, and ordered thresholds cut its score:
P(grade <= k) = logistic(threshold_k - score).  Selection uses the expected
grade and the tail probability of the grades from ``TAIL`` on.

Features are the share of words per hash bucket: the lower-case word without
its outer marks, and the word's form (letters, capitals, figures and signs).
The fit uses at most ``MOST_LABELLED`` labelled rows (documented bound, chosen
by a hash of doc_id); scores cover all rows.

Defined results: NULL and empty texts have score zero before the thresholds;
without labels every grade is as likely as any other; the label is the largest
where rows of ``labels`` repeat; repeated documents count once per row; other
columns pass through, whatever their names.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F, types as T

from tickloom.llm.common import free_name, per_text, prepare
from tickloom.llm.labelled import bounded_sample, of_sample, part_of

MOST_LABELLED = 20_000
BUCKETS = 1 << 16
GRADES = 3
TAIL = 1  # grades from here on are worth keeping
KEEP = 0.5
RIDGE = 1e-3
STEPS = 120
EDGES = b".,;:?!\"'()[]{}<>%&*#~`^\\/=_-|$+@"
FORM = bytes(
    97 if 97 <= c <= 122 or c >= 128 else 65 if 65 <= c <= 90 else 57 if 48 <= c <= 57 else c for c in range(256))
RUNS = re.compile(rb"(.)\1+", re.S)
REMEMBERED = 300_000


def buckets(word: bytes) -> tuple[int, int]:
    """The hash buckets of a word: what it says, and its form."""
    form = RUNS.sub(rb"\1", word.translate(FORM))
    return zlib.crc32(word.lower().strip(EDGES)) % BUCKETS, zlib.crc32(b"\n" + form) % BUCKETS


class Hashed(dict):
    """word -> value of its buckets; remembers words, within bounds."""

    def __init__(self, value):
        self.value = value

    def __missing__(self, word: bytes):
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = out = self.value(*buckets(word))
        return out


def _bags():
    """Texts to distinct buckets and their shares."""
    hashed = Hashed(lambda a, b: a << 16 | b)

    def bags(texts: list[bytes | None]):
        ids, shares = [], []
        for text in texts:
            words = (text or b"").split()
            both = np.fromiter(map(hashed.__getitem__, words), np.int64, len(words))
            at, n = np.unique(np.concatenate([both >> 16, both & 0xFFFF]), return_counts=True)
            ids.append(at.astype(np.int32))
            shares.append((n / max(1, len(words))).astype(np.float32))
        return ids, shares

    return bags


BAG = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("shares", T.ArrayType(T.FloatType()))])


class CumulativeLink:
    """Weights shared by all grades, ordered thresholds."""

    def __init__(self, weights: np.ndarray, thresholds: np.ndarray):
        self.weights, self.thresholds = weights, thresholds

    @staticmethod
    def untrained(grades: int = GRADES) -> "CumulativeLink":
        share = np.arange(1, grades) / grades
        return CumulativeLink(np.zeros(BUCKETS, np.float32), np.log(share / (1 - share)))

    @staticmethod
    def fit(doc: np.ndarray, ids: np.ndarray, shares: np.ndarray, grade: np.ndarray, grades: int = GRADES) -> "CumulativeLink":
        """Maximum likelihood with a ridge, by Adam steps over all rows; the
        thresholds are a first one and logarithms of the gaps after it."""
        n = len(grade)
        upto = np.array([(np.sum(grade <= k) + 0.5) / (n + 1) for k in range(grades - 1)])
        first = np.log(upto / (1 - upto))
        cut = np.concatenate((first[:1], np.log(np.maximum(np.diff(first), 1e-2))))
        x = np.concatenate((np.zeros(BUCKETS), cut))
        m, v = np.zeros_like(x), np.zeros_like(x)
        for step in range(1, STEPS + 1):
            score = np.bincount(doc, shares * x[ids], n)
            gaps = np.exp(x[BUCKETS + 1:])
            edge = np.concatenate(([-np.inf], x[BUCKETS] + np.concatenate(([0], np.cumsum(gaps))), [np.inf]))
            low, high = _logistic(edge[grade] - score), _logistic(edge[grade + 1] - score)
            p = np.maximum(high - low, 1e-9)
            d_low, d_high = low * (1 - low) / p, high * (1 - high) / p
            slope = np.empty_like(x)
            slope[:BUCKETS] = np.bincount(ids, shares * (d_high - d_low)[doc], BUCKETS) / n + RIDGE * x[:BUCKETS] / 100
            by_edge = np.array([np.sum(d_low[grade == k + 1]) - np.sum(d_high[grade == k]) for k in range(grades - 1)]) / n
            after = np.cumsum(by_edge[::-1])[::-1]
            slope[BUCKETS:] = np.concatenate((after[:1], after[1:] * gaps))
            m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
            rate = 0.5 * (1 - step / STEPS) + 0.02
            x -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        return CumulativeLink(x[:BUCKETS].astype(np.float32), x[BUCKETS] + np.concatenate(([0], np.cumsum(np.exp(x[BUCKETS + 1:])))))

    def scorer(self):
        weights = self.weights.astype(float)
        hashed = Hashed(lambda a, b: float(weights[a] + weights[b]))

        def score(texts: list[bytes | None]):
            return ([sum(map(hashed.__getitem__, words)) / max(1, len(words))
                     for words in ((t or b"").split() for t in texts)],)

        return score


def _logistic(x):
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit(docs: DataFrame, grades: DataFrame, most: int = MOST_LABELLED) -> CumulativeLink:
    """Learns from grades (doc_id, grade), one row per document."""
    prepare(docs.sparkSession)
    texts = of_sample(docs.select("doc_id", "text"), bounded_sample(grades, most))
    # Repeated documents of a labelled row count as often as they are there; the order is fixed for the sums.
    rows = per_text(texts, "text", "bag", BAG, _bags).select("doc_id", "grade", "bag.*").toArrow()
    if not rows.num_rows:
        return CumulativeLink.untrained()
    order = np.argsort(rows["doc_id"].to_numpy(), kind="stable")
    rows = rows.take(order)
    ids, shares = rows["ids"].combine_chunks(), rows["shares"].combine_chunks()
    return CumulativeLink.fit(
        np.repeat(np.arange(rows.num_rows), np.diff(ids.offsets.to_numpy())), ids.flatten().to_numpy(),
        shares.flatten().to_numpy().astype(float), rows["grade"].to_numpy().astype(np.int64))


SCORED = T.StructType([T.StructField("score", T.DoubleType())])


def score(docs: DataFrame, model: CumulativeLink, name: str) -> DataFrame:
    """docs with the struct column name, whose field score is the shared linear score."""
    prepare(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return per_text(docs, "text", name, SCORED, lambda: sent.value.scorer())


def tail(total: Column, model: CumulativeLink, grade: int) -> Column:
    """P(grade or more)."""
    return 1 / (1 + F.exp(F.lit(float(model.thresholds[grade - 1])) - total))


def expected(total: Column, model: CumulativeLink) -> Column:
    out = F.lit(0.0)
    for k in range(1, len(model.thresholds) + 1):
        out = out + tail(total, model, k)
    return out


def graded(labels: DataFrame) -> DataFrame:
    """Grade 0: poor; 1: good but toxic; 2: good.  Rows whose doc_id is NULL or
    whose quality is NULL give no grade; an unknown toxic counts as 0."""
    grade = F.when(F.col("quality") == 0, 0).when(F.coalesce("toxic", F.lit(0)) == 1, 1).otherwise(2)
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    return known.groupBy("doc_id").agg(F.max(grade).alias("grade"))


def select(docs: DataFrame, labels: DataFrame, keep: float = KEEP) -> DataFrame:
    """docs whose tail probability is at least keep."""
    model = fit(docs, graded(labels))
    name = free_name(docs.columns, "r")
    return score(docs, model, name).where(tail(F.col(name)["score"], model, TAIL) >= keep).drop(name)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, expected_grade, p_tail, kept; one document in four is held out of the fit."""
    model = fit(docs, graded(labels.where(part_of(F.col("doc_id"), 4) != 2)))
    out = score(docs.select("doc_id", "text"), model, "r")
    p = tail(F.col("r")["score"], model, TAIL)
    return out.select("doc_id", (part_of(F.col("doc_id"), 4) == 2).alias("held_out"),
                      expected(F.col("r")["score"], model).alias("expected_grade"), p.alias("p_tail"), (p >= KEEP).alias("kept"))
