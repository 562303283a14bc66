"""Scores of texts under a log-bilinear neural language model.

The model reads classes of tokens: each of the ``SHORTLIST`` most frequent
tokens is a class, all other words share ``SUFFIXES`` classes by the hash of
their last bytes.  The vectors of the two classes before a token, each through
a matrix of its own position, predict the vector of the next class; with a bias
its products give the scores of all classes.  Inside a class of many words a
word has the share of its smoothed count, one unseen word included, so that
the probabilities of all words add up to one.

Training is noise-contrastive, in numpy, over all training texts: the class
trigrams of all texts are counted first, and the table of counts is cut by a hash
into shards of about ``SHARD`` trigrams, so that the layout of the files plays no
part.  Each shard takes steps against samples of the unigram distribution, and
the shards' parameters are averaged by their numbers of tokens.  Rounds, each from
the average of the one before, go on until the loss on all trigrams falls by less
than ``LEAST_GAIN`` of itself, ``ROUNDS`` at most; the best round counts.  Scoring
normalises by the whole softmax, whose table over all pairs of classes comes
from batched matrix products.

Counts of tokens cover all training texts.  The ``FREQUENT`` most frequent
tokens (a fixed bound) are sent to the tasks; every other word is joined with
the table of counts, so no count is left out.

Defined results: a NULL text is empty and holds only its end; a NULL doc_id
counts as empty text in the choice of training texts; repeated rows count and
are scored each; without training texts N is 0, V is 0 and the model is
uniform over classes; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from functools import cached_property
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F, types as T

from tickloom.llm.common import aggregated_in_tasks, per_text, prepare, written
from tickloom.llm.labelled import part_of, word_counter

SHORTLIST, SUFFIXES, SUFFIX_BYTES = 192, 64, 3
CLASSES = SHORTLIST + SUFFIXES
FREQUENT = 200_000
WIDTH = 32  # of the vectors
NOISE = 64  # samples that a batch of examples shares
BATCH = 8192
ROUNDS, EPOCHS, RATE = 8, 2, 0.1
SHARD = 400_000  # trigrams
LEAST_GAIN = 0.002
END = b""  # no word is empty


def tokens(text: bytes | None) -> list[bytes]:
    """Lower-case words and the end."""
    return [*(text or b"").lower().split(), END]


def suffix_class(word: bytes) -> int:
    return SHORTLIST + zlib.crc32(word[-SUFFIX_BYTES:]) % SUFFIXES


def context_codes(classes: np.ndarray, first: np.ndarray, end: int) -> np.ndarray:
    """Code of the two classes before each token; the end's class before a text."""
    one = np.concatenate(([end], classes[:-1]))
    two = np.concatenate(([end, end], classes[:-2]))[: len(classes)]
    one[first] = end
    two[first] = end
    second = first + 1
    two[second[second < len(classes)]] = end
    return two * CLASSES + one


class Network:
    """Parameters of the log-bilinear model."""

    SHAPES = {"vectors": (CLASSES, WIDTH), "near": (WIDTH, WIDTH), "far": (WIDTH, WIDTH), "targets": (CLASSES, WIDTH), "bias": (CLASSES,)}

    def __init__(self, values: dict[str, np.ndarray]):
        self.values = values

    @staticmethod
    def initial(noise: np.ndarray) -> "Network":
        rng = np.random.default_rng(5)
        values = {k: rng.normal(0, 0.1, s) for k, s in Network.SHAPES.items()}
        values["near"] += np.eye(WIDTH)
        values["far"] += 0.5 * np.eye(WIDTH)
        values["bias"] = np.log(noise)
        return Network(values)

    def flat(self) -> np.ndarray:
        return np.concatenate([self.values[k].ravel() for k in self.SHAPES])

    @staticmethod
    def of_flat(x: np.ndarray) -> "Network":
        values, at = {}, 0
        for name, shape in Network.SHAPES.items():
            size = int(np.prod(shape))
            values[name] = x[at:at + size].reshape(shape)
            at += size
        return Network(values)

    def log_table(self) -> np.ndarray:
        """log10 probability of each class after each pair of classes."""
        v = self.values
        near, far = v["vectors"] @ v["near"], v["vectors"] @ v["far"]
        out = np.empty((CLASSES, CLASSES, CLASSES), np.float32)
        for two in range(CLASSES):  # a batch of contexts a product
            logits = (near + far[two]) @ v["targets"].T + v["bias"]
            logits -= logits.max(1, keepdims=True)
            out[two] = (logits - np.log(np.exp(logits).sum(1, keepdims=True))) / np.log(10)
        return out.ravel()

    def train(self, code: np.ndarray, count: np.ndarray, noise: np.ndarray, seed: int) -> "Network":
        """Noise-contrastive steps over distinct trigrams, weighted by their counts."""
        v = {k: x.astype(np.float32) for k, x in self.values.items()}
        squares = {k: np.full_like(x, 1e-6) for k, x in v.items()}
        rng = np.random.default_rng(seed)
        log_noise = np.log(NOISE * noise).astype(np.float32)
        for _ in range(EPOCHS):
            order = rng.permutation(len(code))
            for start in range(0, len(order), BATCH):
                pick = order[start:start + BATCH]
                two, one, target = code[pick] // CLASSES**2, code[pick] // CLASSES % CLASSES, code[pick] % CLASSES
                weight = (count[pick] / count[pick].sum()).astype(np.float32)
                sample = rng.choice(CLASSES, NOISE, p=noise)
                near, far = v["vectors"] @ v["near"], v["vectors"] @ v["far"]
                predicted = near[one] + far[two]
                wanted, other = v["targets"][target], v["targets"][sample]
                right = _logistic((predicted * wanted).sum(1) + v["bias"][target] - log_noise[target])
                wrong = _logistic(predicted @ other.T + v["bias"][sample] - log_noise[sample])
                g_right, g_wrong = (right - 1) * weight, wrong * weight[:, None]
                g_pred = g_right[:, None] * wanted + g_wrong @ other
                g_near, g_far = _sums(one, g_pred), _sums(two, g_pred)
                g_targets = _sums(target, g_right[:, None] * predicted)
                np.add.at(g_targets, sample, g_wrong.T @ predicted)
                g_bias = np.bincount(target, g_right, CLASSES)
                np.add.at(g_bias, sample, g_wrong.sum(0))
                slopes = {
                    "vectors": g_near @ v["near"].T + g_far @ v["far"].T, "near": v["vectors"].T @ g_near,
                    "far": v["vectors"].T @ g_far, "targets": g_targets, "bias": g_bias}
                for k, g in slopes.items():
                    squares[k] += (g * g).astype(np.float32)
                    v[k] -= (RATE * g / np.sqrt(squares[k])).astype(np.float32)
        return Network({k: x.astype(float) for k, x in v.items()})


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _sums(row: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Sums of the rows of values by row number."""
    return np.stack([np.bincount(row, values[:, k], CLASSES) for k in range(values.shape[1])], 1)


class Model:
    """What a task needs to score: counts of frequent tokens, class totals, network."""

    def __init__(self, words: list[bytes], counts: list[int], totals: np.ndarray, kinds: np.ndarray, all_: int, distinct: int):
        self.words, self.counts = words, np.array(counts, float)
        # END is always a class of its own; where it was never counted it stands last on the list.
        listed = words[:SHORTLIST]
        if END not in listed:
            listed = [*listed[:SHORTLIST - 1], END]
        self.listed = listed
        self.totals, self.kinds, self.all, self.distinct = totals, kinds, all_, distinct
        self.network: Network | None = None

    @cached_property
    def index(self) -> dict[bytes, int]:
        return {w: i for i, w in enumerate(self.words)}

    @cached_property
    def class_of(self) -> dict[bytes, int]:
        return {w: i for i, w in enumerate(self.listed)}

    @cached_property
    def classes(self) -> np.ndarray:
        """Class of each frequent token."""
        own = self.class_of
        return np.array([own.get(w, -1) if w in own else suffix_class(w) for w in self.words], np.int64)

    @property
    def end(self) -> int:
        return self.class_of[END]

    @cached_property
    def log_share(self) -> np.ndarray:
        """log10 of the denominator inside each class; a listed token has its class alone."""
        out = np.zeros(CLASSES)
        out[SHORTLIST:] = np.log10(self.totals + 0.5 * (self.kinds + 1))
        return out

    @cached_property
    def noise(self) -> np.ndarray:
        """Unigram distribution over classes, smoothed."""
        n = np.ones(CLASSES)
        n[SHORTLIST:] += self.totals
        for w, c in zip(self.words, self.counts):
            if w in self.class_of:
                n[self.class_of[w]] += c
        return n / n.sum()

    @cached_property
    def table(self) -> np.ndarray:
        return self.network.log_table()

    def read(self, texts: list[bytes | None]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """All tokens of texts: words, number among the frequent or -1, class, text, first token of each text."""
        words: list[bytes] = []
        lengths = []
        for t in texts:
            own = tokens(t)
            words += own
            lengths.append(len(own))
        at = np.fromiter(map(self.index.get, words, repeat(-1)), np.int64, len(words))
        classes = self.classes[at] if len(self.words) else np.zeros(len(at), np.int64)
        for i in np.flatnonzero(at < 0).tolist():
            classes[i] = self.end if words[i] == END else suffix_class(words[i])
        lengths = np.array(lengths)
        return words, at, classes, np.repeat(np.arange(len(lengths)), lengths), np.cumsum(lengths) - lengths


def token_counts(docs: DataFrame) -> DataFrame:
    """word (bytes, empty: the end), c: over the rows of docs (text)."""
    fed = docs.select(F.col("text").cast("binary").alias("text"))
    gathered = aggregated_in_tasks(fed, "word binary, c long", word_counter(tokens, ["c"], lambda row: (1,)))
    return gathered.groupBy("word").agg(F.sum("c").alias("c"))


def frequent_tokens(counts: DataFrame) -> tuple[list[bytes], list[int]]:
    """The tokens above the count that leaves at most FREQUENT of them, and the
    shortlist, most frequent first.  That count comes from a histogram of a few
    thousand bins, so no task sorts or receives more than its share."""
    bins = counts.groupBy(F.floor(F.log2("c") * 64).alias("bin")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("least"))
    above, least = 0, None
    for r in sorted(bins.collect(), key=lambda r: -r["bin"]):
        above += r["n"]
        if above > FREQUENT:
            break
        least = r["least"]
    top = counts.orderBy(F.desc("c"), "word").limit(min(SHORTLIST, FREQUENT)).collect()
    many = counts.where(F.col("c") >= least).toArrow() if least is not None else counts.limit(0).toArrow()
    found = dict(zip(many["word"].to_pylist(), many["c"].to_pylist())) | {bytes(r["word"]): r["c"] for r in top}
    ordered = sorted(found.items(), key=lambda x: (-x[1], x[0]))
    return [w for w, _ in ordered], [c for _, c in ordered]


def fit(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The model and the table of counts of the training texts docs (text)."""
    spark = prepare(docs.sparkSession)
    counts = written(token_counts(docs))
    whole = counts.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    words, numbers = frequent_tokens(counts)
    totals, kinds = np.zeros(SUFFIXES), np.zeros(SUFFIXES)
    model = Model(words, numbers, totals, kinds, whole["n"] or 0, whole["v"])
    of = F.crc32(F.substring("word", -SUFFIX_BYTES, SUFFIX_BYTES)) % SUFFIXES
    shared = counts.where(~F.col("word").isin([F.lit(w) for w in model.listed]))
    for r in shared.groupBy(of.alias("k")).agg(F.sum("c").alias("c"), F.count(F.lit(1)).alias("v")).collect():
        totals[r["k"]], kinds[r["k"]] = r["c"], r["v"]
    model.network = Network.initial(model.noise)
    grams = written(gram_counts(docs.select(F.col("text").cast("binary").alias("text")), spark.sparkContext.broadcast(model)))
    shards = max(1, round(grams.count() / SHARD))
    network, least = model.network, np.inf
    for round_ in range(ROUNDS + 1):  # each also tells the loss of the network it starts from
        new, loss = _averaged(grams, shards, spark.sparkContext.broadcast((network, model.noise)), round_)
        if new is None:
            break
        falls = loss < least * (1 - LEAST_GAIN)
        if loss < least:
            model.network, least = network, loss
        if not falls:
            break
        network = new
    return model, counts


def gram_counts(fed: DataFrame, sent) -> DataFrame:
    """code, n: class trigrams of the texts of fed, at most CLASSES ** 3 rows."""

    def start():
        model = sent.value
        grams = np.zeros(CLASSES**3, np.int32)  # fixed size, however many texts the task reads

        def take(batch):
            if not batch.num_rows:
                return
            _, _, classes, _, first = model.read(batch.column(0).to_pylist())
            np.add.at(grams, context_codes(classes, first, model.end) * CLASSES + classes, 1)

        def give(end):
            code = np.flatnonzero(grams) if end else ()
            if not len(code):
                return None
            return pa.RecordBatch.from_arrays([pa.array(code, pa.int64()), pa.array(grams[code], pa.int64())], names=["code", "n"])

        return take, give

    return aggregated_in_tasks(fed, "code long, n long", start).groupBy("code").agg(F.sum("n").alias("n"))


def _averaged(grams: DataFrame, shards: int, sent, round_: int) -> tuple[Network | None, float]:
    """The mean of the networks that the shards have trained, weighted by tokens;
    the mean loss of the network they start from, over all tokens."""

    def train(table: pa.Table) -> pa.Table:
        network, noise = sent.value
        code, count = table["code"].to_numpy(), table["n"].to_numpy().astype(float)
        order = np.argsort(code)
        code, count = code[order], count[order]
        values = np.append(network.train(code, count, noise, 17 + round_).flat(), -float(count @ network.log_table()[code]) / count.sum())
        n = count.sum()
        return pa.table({"i": np.arange(len(values)), "x": values * n, "n": np.full(len(values), n)})

    trained = grams.withColumn("shard", F.pmod(F.xxhash64("code"), F.lit(shards))).groupBy("shard").applyInArrow(train, "i long, x double, n double")
    # As many rows as the network has parameters, and the loss; rounded, so that the order of the sums does not show.
    means = trained.groupBy("i").agg(F.round(F.sum("x") / F.sum("n"), 5).alias("x")).orderBy("i").toArrow()["x"].to_numpy()
    return (Network.of_flat(means[:-1]), float(means[-1])) if len(means) else (None, 0.0)


READ = T.StructType([
    T.StructField("n_tokens", T.LongType()), T.StructField("known", T.LongType()), T.StructField("counted", T.DoubleType()),
    T.StructField("model", T.DoubleType()), T.StructField("rare", T.ArrayType(T.BinaryType()))])


def _reader(model: Model):
    log_count = np.log10(np.append(model.counts, 1.0) + 0.5)

    def read(texts: list[bytes | None]):
        words, at, classes, text, first = model.read(texts)
        score = model.table[context_codes(classes, first, model.end) * CLASSES + classes].astype(float) - model.log_share[classes]
        frequent = at >= 0
        counted = np.where(frequent, log_count[at], 0.0)
        score += np.where(classes >= SHORTLIST, counted, 0.0)
        n = len(texts)
        rare: list[list[bytes]] = [[] for _ in texts]
        for i in np.flatnonzero(~frequent).tolist():
            rare[text[i]].append(words[i])
        return (np.bincount(text, minlength=n), np.bincount(text, frequent, n).astype(np.int64),
                np.bincount(text, counted, n), np.bincount(text, score, n), rare)

    return read


def scored(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score."""
    spark = prepare(docs.sparkSession)
    sent = spark.sparkContext.broadcast(model)
    read = per_text(docs.select("doc_id", "text"), "text", "r", READ, lambda: _reader(sent.value))
    rows = written(read.select("doc_id", "r.*").withColumn("row", F.monotonically_increasing_id()))
    # The words that are not sent along: their counts come from the table.  The end of a
    # text is among them only where there was no training text; then all classes are even.
    rare = rows.select("row", F.explode("rare").alias("word"))
    c = F.coalesce("c", F.lit(0))
    listed = F.col("word").isin([F.lit(w) for w in model.listed])
    more = rare.join(counts, "word", "left").groupBy("row").agg(
        F.sum(F.log10(c + 0.5)).alias("rare_counted"), F.sum((c > 0).cast("long")).alias("rare_known"),
        F.sum(F.when(listed, 0.0).otherwise(F.log10(c + 0.5))).alias("rare_score"))
    whole = F.lit(float(np.log10(model.all + 0.5 * (model.distinct + 1))))
    zero = lambda name, value: F.coalesce(name, F.lit(value))
    return rows.join(more, "row", "left").select(
        "doc_id", "n_tokens", (F.col("known") + zero("rare_known", 0)).alias("n_known"),
        F.lit(model.all).cast("long").alias("train_tokens"),
        (F.col("counted") + zero("rare_counted", 0.0) - F.col("n_tokens") * whole).alias("base_score"),
        (F.col("model") + zero("rare_score", 0.0)).alias("score"))


def report(docs: DataFrame) -> DataFrame:
    """All documents, learned from those whose crc32(doc_id) modulo 5 is not 1."""
    held_out = part_of(F.col("doc_id"), 5) == 1
    model, counts = fit(docs.where(~held_out).select("text"))
    return scored(docs, model, counts).select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
