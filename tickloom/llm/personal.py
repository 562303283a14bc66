"""Personal data by weak supervision.

Strict patterns give the base spans, which always stay.  They and looser
candidates (addresses written out, numbers without a plus sign, numbers whose
check digit fails, identity numbers, names after a title) are put before five
labelers: pattern, gazetteer, context, boundary and shape.  Each votes yes, no
or abstains.  The votes of all documents are counted by kind and pattern of
votes, a table of bounded size; expectation-maximisation over it estimates
prior and reliabilities for each kind, and its posteriors train the final
classifier, a logistic regression over votes, kind and length, that says which
further candidates become spans.

Defined results: NULL and empty texts have no spans; without any candidate in
the corpus the classifier accepts nothing more; every row keeps its own result,
repeated rows too; other columns pass through, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F, types as T

from tickloom.llm.common import SPANS, aggregated_in_tasks, free_name, per_text, prepare, replace_spans, spans_text, with_text
from tickloom.llm.secrets import merged

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "identity", "name")
LABELERS = ("pattern", "gazetteer", "context", "boundary", "shape")

LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# The guards in front change no match: a run of digits that fails at its first
# digit fails at the others.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
WRITTEN = re.compile(
    r"[A-Za-z0-9._%+-]{1,64} ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63}(?: ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z0-9-]{1,63})+")
LABEL_ENDS = re.compile(r"[. )\]]")  # dots, written out or not
PLAIN_PHONE = re.compile(r"(?<![0-9+.-])(?:00[1-9][0-9]{0,2}[ .-]?|\([0-9]{2,4}\) ?|0[0-9]{2,4}[ /-]|[0-9]{3}[.-])[0-9]{3,4}[ .-][0-9]{2,4}(?:[ .-]?[0-9]{2,4})?(?![0-9])")
IDENTITY = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
TITLES = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Herr", "Frau", "Mme", "Sra")
NAME = re.compile(r"\b(?:" + "|".join(TITLES) + r")\.? ([A-Z][^\W\d_]{1,20}(?: [A-Z][^\W\d_]{1,20})?)")

# Fixed values.
ENDINGS = frozenset("com org net edu gov int io co info biz de fr es uk eu us ca mx ar it nl ch at be".split())
COUNTRY = ("1", "33", "34", "44", "49", "52", "54", "39", "31", "41", "43", "32")
ISSUERS = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6011|65|35|30|36")
GIVEN = frozenset("anna maria juan jose luis carmen pierre jean marie hans peter paul john mary james robert michael david sarah thomas laura julia".split())
CUES = {
    "email": ("mail", "contact", "write to", "correo", "courriel"),
    "ip": ("ip", "host", "server", "address", "adresse"),
    "card": ("card", "visa", "master", "amex", "credit", "karte", "carte", "tarjeta"),
    "phone": ("phone", "tel", "call", "fax", "mobile", "handy"),
    "identity": ("ssn", "social", "identity", "passport"),
    "name": ("name", "dear", "regards", "signed"),
}
AGAINST = ("version", "isbn", "order", "invoice", "figure", "total", "serial", "chapter", "ticket", "part no")
NEAR = 40
LENGTHS = (8, 12, 16, 24)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of the e-mail pattern, found from their signs: a local part that
    fails at its first character fails at all of them."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and LOCAL.match(text, start - 1):
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            out.append((start, domain.end()))
            last = domain.end()
        else:
            last = at + 1
        at = text.find("@", last)
    return out


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """(kind, start, end) of the strict patterns; of number runs that fail their check."""
    out, failed = [(0, a, b) for a, b in emails(text)] if "@" in text else [], []
    if DIGIT.search(text):
        for m in IP.finditer(text):
            fine = all(len(p) <= 3 and int(p or "0") <= 255 for p in (part.lstrip("0") for part in m[0].split(".")))
            (out if fine else failed).append((1, *m.span()))
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19:
                (out if luhn(digits) else failed).append((2, *m.span()))
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(map(str.isdigit, m[0])) <= 15:
                    out.append((3, *m.span()))
    return out, failed


def candidates(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Base spans, and further candidates that touch none of them."""
    base, more = base_spans(text)
    if "(dot)" in text or "[dot]" in text or " dot " in text:  # a match needs one of them
        more += [(0, *m.span()) for m in WRITTEN.finditer(text)]
    if DIGIT.search(text):
        more += [(3, *m.span()) for m in PLAIN_PHONE.finditer(text)]
        more += [(4, *m.span()) for m in IDENTITY.finditer(text)]
    if any(title in text for title in TITLES):
        more += [(5, *m.span(1)) for m in NAME.finditer(text)]
    taken = sorted((a, b) for _, a, b in base)
    free, end = [], -1
    for kind, a, b in sorted(more, key=lambda x: (x[1], -x[2], x[0])):
        if a >= end and not _overlaps(taken, a, b):
            free.append((kind, a, b))
            end = b
    return sorted(base), free


def _overlaps(taken: list[tuple[int, int]], a: int, b: int) -> bool:
    from bisect import bisect_left

    i = bisect_left(taken, (b,))
    return any(taken[j][1] > a for j in range(max(0, i - 4), i))


def votes(text: str, kind: int, a: int, b: int, strict: bool) -> tuple[int, ...]:
    """-1, 0 or 1 of each labeler, then the length class."""
    name, span = KINDS[kind], text[a:b]
    digits = "".join(filter(str.isdigit, span)) if kind in (1, 2, 3, 4) else ""
    if kind == 0:
        known = LABEL_ENDS.split(span.rstrip(".-"))[-1].lower() in ENDINGS
        shape = len(span.split("@")[0]) <= 64
    elif kind == 1:
        head = span.split(".")[0]
        known, shape = head.isdigit() and len(head) < 4 and 1 <= int(head) <= 223, len(span) <= 15
    elif kind == 2:
        known, shape = bool(ISSUERS.match(digits)), len(digits) in (15, 16) or " " in span or "-" in span
    elif kind == 3:
        known = digits.lstrip("0").startswith(COUNTRY)
        shape = any(c in span for c in " ().-") and 9 <= len(digits) <= 15
    elif kind == 4:
        known, shape = digits[:3] not in ("000", "666") and digits[0] != "9", True
    else:
        known, shape = span.split(" ")[0].lower() in GIVEN, " " in span
    before = text[max(0, a - NEAR):a].lower()
    context = 1 if any(c in before for c in CUES[name]) else -1 if any(c in before for c in AGAINST) else 0
    glued = a > 0 and text[a - 1].isalnum() or b < len(text) and text[b].isalnum()
    return (1 if strict else -1 if kind in (1, 2) else 0, 1 if known else -1, context, -1 if glued else 1,
            1 if shape else -1, sum(b - a > n for n in LENGTHS))


def _decode(text: bytes | None) -> str:
    return (text or b"").decode("utf-8", "replace")


def vote_counts(docs: DataFrame) -> DataFrame:
    """kind, one column per labeler, size, n: over all candidates of all documents."""

    def start():
        counts: Counter = Counter()

        def take(batch):
            for raw in batch.column(0).to_pylist():
                text = _decode(raw)
                base, free = candidates(text)
                counts.update((k, *votes(text, k, a, b, True)) for k, a, b in base)
                counts.update((k, *votes(text, k, a, b, False)) for k, a, b in free)

        def give(end):
            if not end or not counts:
                return None
            columns = [*zip(*counts), tuple(counts.values())]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

        return take, give

    names = ["kind", *LABELERS, "size", "n"]
    gathered = aggregated_in_tasks(
        docs.select(F.col("text").cast("binary").alias("text")), ", ".join(f"{n} long" for n in names), start)
    return gathered.groupBy(*names[:-1]).agg(F.sum("n").alias("n"))


TRUST = 10.0  # of the check of a kind that has one


def reliabilities(votes: np.ndarray, counts: np.ndarray, trusted: int | None = None, rounds: int = 50) -> np.ndarray:
    """Posterior of "personal data" for each pattern of votes (rows), by
    expectation-maximisation from the majority vote.

    Each labeler starts with one pseudo-vote of each kind in each class.  The one
    numbered trusted has a stronger prior: TRUST pseudo-votes per candidate, no
    in the negative class and yes in the positive one, and that weight at the start."""
    pseudo = np.ones((votes.shape[1], 3, 2))  # labeler, vote, class
    start = votes.sum(1).astype(float)
    if trusted is not None:
        pseudo[trusted, 0, 0] += TRUST * counts.sum()
        pseudo[trusted, 2, 1] += TRUST * counts.sum()
        start += TRUST * votes[:, trusted]
    post = 1 / (1 + np.exp(-start))
    for _ in range(rounds):
        weight = np.stack([(1 - post) * counts, post * counts])
        prior = (weight.sum(1) + 1) / (weight.sum() + 2)
        logs = np.log(prior)[:, None] + np.zeros_like(weight)
        for column, before in zip(votes.T, pseudo):
            share = np.stack([weight[:, column == v].sum(1) for v in (-1, 0, 1)]) + before
            logs += np.log(share / share.sum(0))[column + 1].T
        new = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -50, 50)))
        if np.abs(new - post).max(initial=0) < 1e-9:
            break
        post = new
    return post


def features(rows: np.ndarray) -> np.ndarray:
    """Kind, votes and length class of candidates as 0/1 columns."""
    columns = [rows[:, 0] == k for k in range(len(KINDS))]
    columns += [rows[:, 1 + i] == v for i in range(len(LABELERS)) for v in (-1, 1)]
    columns += [rows[:, -1] == s for s in range(len(LENGTHS) + 1)]
    return np.stack(columns, 1).astype(float)


def fit(docs: DataFrame, ridge: float = 1.0) -> np.ndarray:
    """Weights of the final classifier, learned from the votes of all documents."""
    prepare(docs.sparkSession)
    table = np.array([tuple(r) for r in vote_counts(docs).collect()], np.int64).reshape(-1, len(LABELERS) + 3)
    table = table[np.lexsort(table.T)]
    rows, counts = table[:, :-1], table[:, -1].astype(float)
    post = np.zeros(len(rows))
    pattern = LABELERS.index("pattern")
    for kind in np.unique(rows[:, 0]):
        of = rows[:, 0] == kind
        # Where all candidates of a kind vote alike, nothing tells the classes apart;
        # so a check that candidates can fail is trusted from the start.
        checked = (rows[of, 1 + pattern] < 0).any()
        post[of] = reliabilities(rows[of, 1:-1], counts[of], pattern if checked else None)
    x = features(rows)
    weights = np.zeros(x.shape[1])
    for _ in range(30):  # Newton steps of the ridge regression
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (counts * (post - p)) - ridge * weights
        curve = (x * (counts * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(weights))
        step = np.linalg.solve(curve, slope)
        weights += np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return weights


def _finder(weights: np.ndarray, least: float):
    accepted: dict[tuple[int, ...], bool] = {}

    def accept(row: tuple[int, ...]) -> bool:
        if row not in accepted:
            score = float(features(np.array([row])) @ weights)
            accepted[row] = 1 / (1 + np.exp(-score)) > least
        return accepted[row]

    def find(texts: list[bytes | None]):
        out = []
        for raw in texts:
            text = _decode(raw)
            base, free = candidates(text)
            more = [(k, a, b) for k, a, b in free if accept((k, *votes(text, k, a, b, False)))]
            out.append([{"kind": KINDS[k], "start": a, "end": b, "base": strict}
                        for k, a, b, strict in sorted([(*s, True) for s in base] + [(*s, False) for s in more])])
        return (out,)

    return find


FOUND = T.StructType([T.StructField("spans", T.ArrayType(T.StructType([*SPANS.elementType.fields, T.StructField("base", T.BooleanType())])))])


def find(docs: DataFrame, name: str, weights: np.ndarray | None = None, least: float = 0.5) -> DataFrame:
    """docs with the struct column name: spans (kind, start, end, base) by kind and start."""
    prepare(docs.sparkSession)
    weights = fit(docs) if weights is None else weights
    return per_text(docs, "text", name, FOUND, lambda: _finder(weights, least))


def redact(docs: DataFrame, mark: str = "[PERSONAL]") -> DataFrame:
    """docs with every span replaced by mark."""
    name = free_name(docs.columns, "found")
    found = find(docs, name)
    spans = merged(F.array_sort(F.transform(F.col(name)["spans"], lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))))
    return with_text(found, replace_spans(F.col("text"), spans, mark), drop=name)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans."""
    found = find(docs.select("doc_id", "text"), "found")
    spans = F.col("found")["spans"]
    base = F.filter(spans, lambda s: s["base"])
    count = lambda kind: F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(kind) for kind in BASE],
                        F.sha2(spans_text(base), 256).alias("base_sha256"), spans_text(spans).alias("spans"))
