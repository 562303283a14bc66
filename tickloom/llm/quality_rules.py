"""Quality rules judged by host.

Every document is measured and held against a few rules.  Failures are counted
per host and rule; a beta distribution fitted to all hosts by moments is the
prior that shrinks the rate of each host, so that a host with few documents
lies near the rate of all.  A host is rejected when the shrunk rate of a rule
is surely above that rule's bar: ``TIMES`` the rate of all documents, but not
less than ``LEAST`` and not more than ``LIMIT``.  Its verdict is joined back to
its documents and is the only one beyond the base rules: a document that fails
the other rules stays where its host is good, and goes with a bad host even
where it fails none.  Hosts that differ by chance only are shrunk to one rate
and all stay.

Defined results: NULL and empty texts have no words and fail the base rule;
a NULL host is a host of its own; repeated documents count once per row; a
host whose documents fail only the base rules is judged like any other; an
empty table gives no rows; other columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F, types as T

from tickloom.llm.common import free_name, per_text, prepare, written

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")
MEASURED = T.StructType([T.StructField(n, T.LongType()) for n in MEASURES])
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\r\x0b\x0c"
# A host is rejected when its shrunk rate less SURE standard deviations is above the bar of a rule.
SURE = 2.0
TIMES, LEAST, LIMIT = 2.0, 0.1, 0.5


def measure(text: bytes | None) -> tuple[int, ...]:
    """The values of MEASURES for one text."""
    text = text or b""
    words = text.split()
    inside = text.translate(None, SPACES)
    chars = len(inside) - len(inside.translate(None, bytes(range(0x80, 0xC0)))) if not inside.isascii() else 0
    lines = [x for x in text.split(b"\n") if x.strip(SPACES)]
    return (len(words), len(inside) - chars, len(text) - len(text.translate(None, SYMBOLS)),
            len(lines) - len(set(lines)), repeated(words), len(lines))


def repeated(words: list[bytes], window: int = 3) -> int:
    """Words inside windows that are found twice or more in the text."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    code = ids[:n]
    for i in range(1, window):  # each step numbers the windows anew, so that no code overflows
        code = np.unique(code * len(numbers) + ids[i:n + i], return_inverse=True)[1]
    often = np.flatnonzero(np.bincount(code)[code] > 1)
    edge = np.zeros(len(words) + 1, np.int64)
    edge[:n][often] += 1
    edge[window:][often] -= 1
    return int(np.count_nonzero(np.cumsum(edge)))


def _measurer():
    return lambda texts: list(zip(*map(measure, texts)))


def rules(m: Column) -> dict[str, Column]:
    """Rule -> fails, from the struct of measures."""
    return {
        "short": m["n_words"] < 50,
        "repeats": 100 * m["n_repeat_words"] > 50 * m["n_words"],
        "symbols": 10 * m["n_symbols"] > m["n_words"],
        "dup_lines": 10 * m["n_dup_lines"] > 3 * m["n_lines"],
        "word_length": (m["word_chars"] < 3 * m["n_words"]) | (m["word_chars"] > 10 * m["n_words"]),
    }


BASE_RULES = ("short", "repeats")


def measured(docs: DataFrame, name: str) -> DataFrame:
    """docs with the struct column name: the measures of each text."""
    prepare(docs.sparkSession)
    return per_text(docs, "text", name, MEASURED, _measurer)


def host_verdicts(docs: DataFrame, measures: str, host: str, limit: float = LIMIT) -> DataFrame:
    """One row per host: host, n_docs, the shrunk failure rate of each rule, rejected."""
    names = list(rules(F.col(measures)))
    counts = docs.groupBy(F.col(host).alias("host")).agg(
        F.count(F.lit(1)).alias("n_docs"),
        *[F.sum(fails.cast("long")).alias(rule) for rule, fails in rules(F.col(measures)).items()])
    counts = written(counts)
    # One row of sums over all hosts gives the moments.
    sums = counts.agg(F.count(F.lit(1)).alias("hosts"), F.sum("n_docs").alias("docs"), *[
        f for r in names for f in (F.sum(r).alias(f"{r}_sum"), F.sum(F.col(r) * F.col(r) / F.col("n_docs")).alias(f"{r}_square"))
    ]).first()
    bad = F.lit(False)
    columns = []
    for rule in names:
        a, b = prior(sums["hosts"], sums["docs"] or 0, sums[f"{rule}_sum"] or 0, sums[f"{rule}_square"] or 0.0)
        total = F.col("n_docs") + a + b
        rate = (F.col(rule) + a) / total
        columns.append(rate.alias(f"rate_{rule}"))
        mean = (sums[f"{rule}_sum"] or 0) / max(sums["docs"] or 0, 1)
        bar = min(limit, max(TIMES * mean, LEAST))
        bad = bad | (rate - SURE * F.sqrt(rate * (1 - rate) / (total + 1)) > bar)
    return counts.select("host", "n_docs", *columns, bad.alias("rejected"))


def prior(hosts: int, docs: int, fails: float, square: float) -> tuple[float, float]:
    """Beta prior from the failures of all hosts: square is the sum of fails^2 / docs per host."""
    if not docs:
        return 1.0, 1.0
    mean = min(max(fails / docs, 1e-6), 1 - 1e-6)
    within = mean * (1 - mean)
    # The spread of the rates, weighted by documents, less what chance alone gives.
    spread = (square - docs * (fails / docs) ** 2) / docs
    between = max(spread - within * max(hosts - 1, 0) / docs, within * 1e-6)
    strength = min(max(within / between - 1, 2.0), 1e6)
    return mean * strength, (1 - mean) * strength


def judged(docs: DataFrame, host: str = "source", limit: float = LIMIT) -> DataFrame:
    """doc_id, the measures, base_failed, soft_failed, host_rejected, kept."""
    m = F.col("m")
    rows = written(measured(docs.select("doc_id", "text", F.col(host).alias("host")), "m").select("doc_id", "host", "m"))
    verdicts = host_verdicts(rows, "m", "host", limit).select(F.col("host").alias("of"), "rejected")
    fails = rules(m)
    base = fails["short"] | fails["repeats"]
    soft = fails["symbols"] | fails["dup_lines"] | fails["word_length"]
    return rows.join(verdicts, F.col("host").eqNullSafe(F.col("of")), "left").select(
        "doc_id", *[m[n].alias(n) for n in MEASURES], base.alias("base_failed"), soft.alias("soft_failed"),
        F.col("rejected").alias("host_rejected"),
        (~base & ~F.col("rejected")).alias("kept"))


def report(docs: DataFrame) -> DataFrame:
    return judged(docs).select(
        "doc_id", *MEASURES[:5], "base_failed", "kept", "soft_failed", "host_rejected")
