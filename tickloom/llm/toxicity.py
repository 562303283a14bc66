"""Toxicity behind disguises: a noisy channel before a word score.

A token that is no known word, of any length, or a run of single characters with
gaps is a lattice: each character may stand for itself, for letters it is used
for, for a repetition or for nothing, and at a gap a word may end.  Viterbi
decoding under a character language model, with fixed costs of the channel,
restores the likeliest word or words.  A word of letters that the labelled sample
holds mostly in clean documents is known; figures alone are a number.  Tokens that
no path of the lattice leads to a telling word are not decoded, as their result
could not count.  Restored words are scored with log odds
learned from labelled rows: a word tells something when the lower bound of the
share of toxic documents among its documents is high enough, and that bound is
the stricter the more words are tried.  Copies would make chance words look
sure, so of documents with the same least shingle hash one teaches.  The sum of
log odds is turned into a probability by a rising step curve, calibrated on
labelled rows that taught no words.

Words are learned from at most ``MOST_LABELLED`` labelled rows (documented
bound, chosen by a hash) of three quarters of the training rows; of the other
quarter at most as many calibrate, the same rows in every use; the character
model counts the words of all documents; scores cover all rows.

Defined results: NULL and empty texts get the score of a text without any
telling word; without labels every score is the prior of one half; a label is
the largest where rows of ``labels`` repeat; repeated documents count once per
row; other columns pass through, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F, types as T

from tickloom.llm.common import aggregated_in_tasks, free_name, per_text, prepare, written
from tickloom.llm.labelled import HELD_WORDS, bounded_sample, of_sample, part_of, unique_labels, word_counter
from tickloom.llm.minhash import Words, shingles

MOST_LABELLED = 60_000
MOST_WORDS = 4096  # words with a weight, the most telling first
LEAST_SHARE = 0.5  # lower bound of the toxic share of a word's documents
STRICTNESS = 0.5  # the square of the bound's width is this times ln(words tried)
REJECT = 0.3
ORDER = 4  # of the character model
SYMBOLS = 28  # word end, a to z, any other letter

# Signs and the letters they are used for.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "€": "e",
}
GAPS = " .-_*"
# Costs of the channel in natural logarithms.
SELF, SIGN, AGAIN, GAP, WORD_END, KEEP_SIGN = 0.0, 1.0, 1.5, 0.7, 0.7, 6.0
EDGES = ".,;:?\"'()[]{}<>%&*#~`^\\/=_-"
JUNK = re.compile(r"([^\w\s])\1{2,}")
TRIED = re.compile(r"[^\W\d_]|[@$!|+€]")
AGAIN_LETTER = re.compile(r"(.)\1+", re.S)
THRICE = re.compile(r"(.)\1\1", re.S)
# Single characters with gaps; marks may stand around them.
SPACED = re.compile(r"(?<![^\s\"'(\[{<])[a-z0-9@$!|+€._*-](?:\s++[a-z0-9@$!|+€._*-]){2,}(?=[.,;:?!\"')\]}>]*+(?:\s|\Z))")


def symbol(c: str) -> int:
    return ord(c) - 96 if "a" <= c <= "z" else 27


def bare(token: str) -> str:
    """A lower-case token without the marks around it."""
    if token.isalpha():
        return token
    return JUNK.sub("", token).strip(EDGES).rstrip("!|+")


# Letters that some sign may mean both are one letter in a skeleton.
_ONE = {"l": "i", "g": "b"}
_SKELETON = str.maketrans({**_ONE, **{c: _ONE.get(v[0], v[0]) for c, v in STANDS_FOR.items()}, **dict.fromkeys(GAPS, None)})


def skeleton(token: str) -> str:
    """What all paths of a token's lattice share: the words of a path, put
    together, have the skeleton of the token."""
    return AGAIN_LETTER.sub(r"\1", "".join(token.split()).translate(_SKELETON))


class Channel:
    """Viterbi decoder over the lattice of a token; costs[a, b, c, d] is the
    cost of symbol d after a, b, c."""

    def __init__(self, costs: np.ndarray):
        self.flat = costs.ravel()

    def restore(self, token: str) -> str:
        """The likeliest word, or words with spaces between."""
        # State: the last three symbols and the last letter, "" at the start of a word.
        # Value: cost, letters so far as a chain from the last one, so that a step costs the same in a long token.
        states: dict[tuple[int, str], tuple[float, tuple | None]] = {(0, ""): (0.0, None)}
        base = SYMBOLS ** (ORDER - 2)
        for c in token:
            gap = c in GAPS or c.isspace()
            arcs: list[tuple[str, float]] = []
            if c.isalpha():
                arcs.append((c, SELF))
            elif not c.isspace():
                arcs += [(letter, SIGN) for letter in STANDS_FOR.get(c, "")]
                arcs.append((c, KEEP_SIGN))
            new: dict[tuple[int, str], tuple[float, tuple | None]] = {}
            for (history, last), (cost, letters) in states.items():
                if gap:
                    _better(new, (history, last), cost + GAP, letters)
                    if last:
                        _better(new, (0, ""), cost + WORD_END + float(self.flat[history * SYMBOLS]), (" ", letters))
                for letter, extra in arcs:
                    if letter == last:  # the same letter again may be a repetition
                        _better(new, (history, last), cost + AGAIN, letters)
                    s = symbol(letter)
                    step = extra + float(self.flat[history * SYMBOLS + s])
                    _better(new, (history % base * SYMBOLS + s, letter), cost + step, (letter, letters))
            states = new
        ends = [(cost + (float(self.flat[history * SYMBOLS]) if last or not letters else 0.0), letters)
                for (history, last), (cost, letters) in states.items()]
        letters, out = min(ends, key=lambda x: x[0])[1], []
        while letters:
            letter, letters = letters
            out.append(letter)
        return "".join(reversed(out)).strip(" ")


def _better(states: dict, key, cost: float, letters: tuple | None) -> None:
    old = states.get(key)
    if old is None or cost < old[0]:
        states[key] = cost, letters


def restored_words(text: str, restore) -> set[str]:
    """The distinct words of a text, disguised ones restored as well."""
    low = text.lower()
    out = {w for token in set(low.split()) for w in restore(token).split()}
    for m in SPACED.finditer(low):
        out.update(restore(m[0]).split())
    return out


class Restorer(dict):
    """token -> its word or words; remembers tokens, within bounds.  known words
    are left alone; with telling, so are tokens that hide none of these."""

    MOST = 300_000

    def __init__(self, channel: Channel | None, telling=None, known=frozenset()):
        self.channel, self.known = channel, frozenset(known).union(telling or ())
        self.telling = None if telling is None else {skeleton(w) for w in telling} - {""}
        self.lengths = sorted({len(w) for w in self.telling or ()})

    def __missing__(self, token: str) -> str:
        core = bare(token)
        if self.channel and len(core) > 2 and self.may_hide(core):
            core = self.channel.restore(core)
        if len(self) >= self.MOST:
            self.clear()
        self[token] = core
        return core

    def may_hide(self, core: str) -> bool:
        if core in self.known or not (AGAIN_LETTER.search(core) if core.isalpha() else TRIED.search(core)):
            return False
        if self.telling is None:
            return True
        bones = skeleton(core)
        if bones in self.telling:
            return True
        if not any(c in GAPS or c.isspace() for c in core):
            return False
        return any(bones[i:i + n] in self.telling for n in self.lengths for i in range(len(bones) - n + 1))


def _text(raw: bytes | None) -> str:
    return (raw or b"").decode("utf-8", "replace")


def word_labels(texts: DataFrame) -> DataFrame:
    """word, docs, toxic: documents of a labelled sample that hold it."""

    def words_of(raw):
        return {w.encode() for w in map(bare, set(_text(raw).lower().split())) if w}

    start = word_counter(words_of, ["docs", "toxic"], lambda row: (1, row[0]))
    fed = texts.select(F.col("text").cast("binary").alias("text"), F.col("toxic").cast("long").alias("toxic"))
    gathered = aggregated_in_tasks(fed, "word binary, docs long, toxic long", start)
    return gathered.groupBy("word").agg(F.sum("docs").alias("docs"), F.sum("toxic").alias("toxic"))


def telling_words(counts: DataFrame, docs: int, toxic: int, most: int = MOST_WORDS, least: float = LEAST_SHARE) -> dict[str, float]:
    """Log odds of the words whose toxic share is surely above least (Wilson's lower bound)."""
    if not docs or not 0 < toxic < docs:
        return {}
    clean = docs - toxic
    square = STRICTNESS * float(np.log(max(3, counts.count())))
    a, n = F.col("toxic").cast("double"), F.col("docs").cast("double")
    share = a / n
    bound = (share + square / (2 * n) - F.sqrt(square * (share * (1 - share) / n + square / (4 * n * n)))) / (1 + square / n)
    odds = F.log((a + 0.5) / (toxic + 1)) - F.log((n - a + 0.5) / (clean + 1))
    best = counts.select("word", bound.alias("bound"), odds.alias("odds")).where((F.col("bound") >= least) & (F.col("odds") > 0))
    rows = best.orderBy(F.desc("bound"), "word").limit(most).collect()
    return {bytes(r["word"]).decode(): float(r["odds"]) for r in rows}


def teaches(key: Column) -> Column:
    """Three quarters of the labelled rows teach words, the others calibrate."""
    return F.pmod(F.xxhash64(key, F.lit(3)), F.lit(4)) != 0


def without_copies(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """The rows of a bounded labelled sample, one of those whose texts share their least shingle hash."""

    def start():
        words = Words()
        return lambda texts: ([int(s[0] >> np.uint64(1)) if len(s) else None for s in (shingles(t, words) for t in texts)],)

    least = T.StructType([T.StructField("least", T.LongType())])
    keyed = per_text(of_sample(docs.select("doc_id", "text"), sample.select("doc_id")), "text", "k", least, start)
    return sample.join(keyed.groupBy("k.least").agg(F.min("doc_id").alias("doc_id")).select("doc_id"), "doc_id", "left_semi")


def gram_codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the character ORDER-grams of words, each with its end, and the number of the word of each."""
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    letters = np.frombuffer("".join(w + "\n" for w in words).encode("utf-32-le"), np.uint32).astype(np.int64)
    symbols = np.where((letters >= 97) & (letters <= 122), letters - 96, np.where(letters == 10, 0, SYMBOLS - 1))
    place = np.arange(len(letters)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    code = symbols.copy()
    for back in range(1, ORDER):  # before the start of a word stand ends
        code[back:] += np.where(place[back:] >= back, symbols[:-back], 0) * SYMBOLS ** back
    return code, np.repeat(np.arange(len(words)), lengths)


def character_counts(docs: DataFrame) -> np.ndarray:
    """How often each ORDER-gram of characters is in the words of letters, none three times
    in a row, of all documents, a word once a document.  Tasks hold a table of fixed size."""
    codes = SYMBOLS ** ORDER

    def start():
        sums, words = np.zeros(codes), Counter()

        def add():
            plain = [w for w in words if not THRICE.search(w)]  # a stretched word is no language
            if plain:
                code, of = gram_codes(plain)
                np.add(sums, np.bincount(code, np.array([words[w] for w in plain], float)[of], codes), out=sums)
            words.clear()

        def take(batch):
            for raw in batch.column(0).to_pylist():
                words.update(filter(str.isalpha, set(_text(raw).lower().split())))
                if len(words) > HELD_WORDS:
                    add()

        def give(end):
            if not end:
                return None
            add()
            at = np.flatnonzero(sums)
            if not len(at):
                return None
            return pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(sums[at], pa.float64())], names=["gram", "n"])

        return take, give

    gathered = aggregated_in_tasks(docs.select(F.col("text").cast("binary").alias("text")), "gram long, n double", start)
    found = gathered.groupBy("gram").agg(F.sum("n").alias("n")).toArrow()  # at most SYMBOLS ** ORDER rows
    table = np.zeros(codes)
    table[found["gram"].to_numpy()] = found["n"].to_numpy()
    return table


def character_costs(table: np.ndarray, telling: dict[str, float]) -> np.ndarray:
    """Costs (-ln p) of a character model of ORDER over counts of ORDER-grams, the
    shorter orders mixed in; each telling word counts as one more word in a
    thousand, so that a restored word can be one the lists know."""
    extra = table.sum() / 1000 / max(1, sum(map(len, telling)))
    more = [w for w, odds in telling.items() if odds > 0 and w.isalpha()]
    table = (table + extra * np.bincount(gram_codes(more)[0], minlength=len(table))).reshape((SYMBOLS,) * ORDER)
    p = np.full(SYMBOLS, 1 / SYMBOLS)
    for order in range(1, ORDER + 1):  # Witten-Bell mixing from short to long histories
        n = table.sum(axis=tuple(range(ORDER - order))) if order < ORDER else table
        total, kinds = n.sum(-1, keepdims=True), (n > 0).sum(-1, keepdims=True)
        p = (n + kinds * p) / np.maximum(total + kinds, 1e-9) + (total == 0) * p
    return -np.log(p).astype(np.float32)


def known_words(counts: DataFrame, telling: dict[str, float]) -> set[str]:
    """Counted words of letters, none three times in a row, that are mostly in
    clean documents; only those that a telling word could be mistaken for."""
    hidden = {skeleton(w) for w in telling}

    def start():
        found: list[bytes] = []

        def take(batch):
            for raw in batch.column(0).to_pylist():
                word = raw.decode()
                if word.isalpha() and not THRICE.search(word) and skeleton(word) in hidden:
                    found.append(raw)

        def give(end):
            return pa.RecordBatch.from_arrays([pa.array(found, pa.binary())], names=["word"]) if end and found else None

        return take, give

    clean = counts.where(F.col("docs") > 2 * F.col("toxic")).select("word")
    return {bytes(r["word"]).decode() for r in aggregated_in_tasks(clean, "word binary", start).collect()}


class Model:
    """What scoring needs: costs of the character model, weights of words, known words like them."""

    def __init__(self, costs: np.ndarray, weights: dict[str, float], known: set[str] = frozenset()):
        self.costs, self.weights, self.known = costs, weights, known

    def scorer(self):
        restore = Restorer(Channel(self.costs), self.weights, self.known).__getitem__

        def score(texts: list[bytes | None]):
            sums, words = [], []
            for raw in texts:
                hits = sorted(self.weights.keys() & restored_words(_text(raw), restore))
                sums.append(sum(self.weights[w] for w in hits))
                words.append(hits)
            return sums, words

        return score


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Model:
    """Learns words from labels (doc_id, toxic) with one row per document."""
    sample = written(without_copies(docs, bounded_sample(labels.where(teaches(F.col("doc_id"))), most)))
    counts = written(word_labels(of_sample(docs.select("doc_id", "text"), sample)))
    of = of_sample(docs.select("doc_id"), sample).agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t")).first()
    telling = telling_words(counts, of["n"], of["t"] or 0)
    return Model(character_costs(character_counts(docs), telling), telling, known_words(counts, telling))


FOUND = T.StructType([T.StructField("sum", T.DoubleType()), T.StructField("words", T.ArrayType(T.StringType()))])


def score_words(docs: DataFrame, model: Model, name: str) -> DataFrame:
    """docs with the struct column name: sum of log odds, telling words found."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return per_text(docs, "text", name, FOUND, lambda: sent.value.scorer())


STEP, TOP = 4, 40  # the sum is read in quarters, up to 40


def in_bins(total: Column) -> Column:
    return F.round(F.least(total, F.lit(float(TOP))) * STEP)


def calibration(sums: DataFrame, labels: DataFrame) -> list[tuple[float, float]]:
    """Steps (least bin, probability), rising: bins of the sum in which a higher
    one is less often toxic are pooled.  A step lies halfway between the last bin
    of one pool and the first of the next.  The bins are bounded; each step is
    mixed with one row of the share of all."""
    rows = sums.join(labels, "doc_id").groupBy(in_bins(F.col("sum")).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("t")).orderBy("bin").collect()
    prior = sum(r["t"] for r in rows) / max(1, sum(r["n"] for r in rows))
    pools: list[list[float]] = []
    for r in rows:
        pools.append([r["bin"], r["n"], r["t"], r["bin"]])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            _, n, t, last = pools.pop()
            pools[-1] = [pools[-1][0], pools[-1][1] + n, pools[-1][2] + t, last]
    before = [pools[0][0], *(p[3] for p in pools[:-1])] if pools else []
    return [(float(first + last) / 2, float((t + prior) / (n + 1))) for (first, n, t, _), last in zip(pools, before)]


def probability(total: Column, curve: list[tuple[float, float]]) -> Column:
    """The step of the curve that a sum reaches; one half without a curve."""
    if not curve:
        return F.lit(0.5)
    out = F.lit(curve[0][1])
    for at, p in curve[1:]:
        out = F.when(in_bins(total) >= at, F.lit(p)).otherwise(out)
    return out


def calibrating(labels: DataFrame) -> DataFrame:
    """The labels that taught no words, at most MOST_LABELLED of them by hash; where
    there are too few to split, the labels that taught."""
    rest = labels.where(~teaches(F.col("doc_id")))
    return bounded_sample(labels if rest.isEmpty() else rest, MOST_LABELLED)


def training_labels(labels: DataFrame) -> DataFrame:
    """Labels that may be learned from: crc32 of doc_id modulo 4 is not 2."""
    return unique_labels(labels.where(part_of(F.col("doc_id"), 4) != 2), "toxic")


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, words."""
    prepare(docs.sparkSession)
    known = written(training_labels(labels))
    sums = written(score_words(docs.select("doc_id", "text"), fit(docs, known), "r").select("doc_id", "r.*"))
    score = probability(F.col("sum"), calibration(sums, calibrating(known)))
    return sums.select("doc_id", (part_of(F.col("doc_id"), 4) == 2).alias("held_out"), score.alias("score"),
                       (score >= REJECT).cast("int").alias("predicted"), F.array_join("words", " ").alias("words"))


def keep_clean(docs: DataFrame, labels: DataFrame, reject: float = REJECT) -> DataFrame:
    """docs whose score stays below reject."""
    prepare(docs.sparkSession)
    known = written(training_labels(labels))
    model = fit(docs, known)
    narrow = docs.select("doc_id", "text")
    # The curve is learned from labelled texts alone, so the other texts are decoded once, for the filter.
    rest = calibrating(known)
    train = score_words(of_sample(narrow, rest.select("doc_id")), model, "r").select("doc_id", "r.sum")
    curve = calibration(train, rest)
    name = free_name(docs.columns, "r")
    found = score_words(docs, model, name)
    return found.where(probability(F.col(name)["sum"], curve) < reject).drop(name)


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return scored(docs, labels)
