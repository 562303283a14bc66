"""Operators that learn: held-out accuracy, exact counts, defined results."""

import random
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest

from tests.llm.conftest import by_id
from tickloom.llm import language_model, quality_classifier, toxicity

BAD = ["idiot", "moron", "trash"]


def part(i, n):
    return zlib.crc32(str(i).encode()) % n


@pytest.fixture(scope="module")
def words():
    rnd = random.Random(6)
    return ["".join(rnd.choice(["ta", "re", "lo", "mi", "sen", "dor"]) for _ in range(rnd.randint(1, 4))) for _ in range(200)]


def toxic_corpus(words, n=240):
    rnd = random.Random(7)
    texts, labels = [], []
    for i in range(n):
        said = [rnd.choice(words) for _ in range(40)]
        bad = i % 4 == 0
        if bad:
            for _ in range(3):
                said[rnd.randrange(40)] = rnd.choice(BAD)
        texts.append((i, " ".join(said)))
        labels.append((i, int(not i % 5 == 0), int(bad)))
    return texts, labels


def test_toxic_words_are_learned_and_disguises_undone(spark, docs, words):
    texts, labels = toxic_corpus(words)
    hidden = [(1000, "the 1d10t said"), (1001, "you m.o.r.o.n"), (1002, "what tr4sssh"), (1003, "i d i o t"), (1004, None), (1005, ""), (1006, words[3]), (1007, "MORON!!!"), (1007, "MORON!!!")]
    table = spark.createDataFrame(labels + [(3, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    rows = toxicity.report(docs(texts + hidden), table).collect()
    got = {r["doc_id"]: r for r in rows}
    assert len(rows) == len(texts) + len(hidden)
    assert all(got[i]["held_out"] == (part(i, 4) == 2) for i in got)
    held = [i for i, *_ in labels if got[i]["held_out"]]
    assert all(got[i]["predicted"] == int(i % 4 == 0) for i in held)
    assert all(got[i]["predicted"] == 1 for i in (1000, 1001, 1002, 1003, 1007))
    assert all(got[i]["predicted"] == 0 and 0 < got[i]["score"] < 0.3 for i in (1004, 1005, 1006))
    kept = toxicity.keep_clean(docs(texts + hidden), table)
    assert kept.columns == docs([]).columns
    assert set(by_id(kept)) == {i for i in got if got[i]["predicted"] == 0}


def test_spaced_long_and_doubled_disguises_are_undone(spark, docs, words):
    texts, labels = toxic_corpus(words)
    hidden = ["you are a m o r o n", "i d i o t m o r o n", "m  o  r  o  n   i d i o t.", "you id" + "i" * 30 + "o" * 30 + "t", "an iddiot",
              "m " * 12 + "o r o n", "! d | o t", "mo-ron", "trash-idiot"]
    clean = [words[3], "a b c", "t a r e", "455 " * 20, "x" * 50_000, "a-b" * 5000, " ".join("tare" * 9)]
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = by_id(toxicity.report(docs(texts + list(enumerate(hidden + clean, 1000))), table))
    predicted = {t[:40]: got[1000 + i]["predicted"] for i, t in enumerate(hidden + clean)}
    assert predicted == {t[:40]: int(t in hidden) for t in hidden + clean}
    assert got[1001]["words"] == got[1002]["words"] == "idiot moron"


def test_known_words_are_not_decoded_and_the_filter_loses_nothing():
    rnd = random.Random(10)
    costs = -np.log(np.random.default_rng(3).dirichlet(np.full(toxicity.SYMBOLS, 0.2), (toxicity.SYMBOLS,) * 3) + 1e-6).astype(np.float32)
    telling = {"lib", "abba", "ass", "b"}
    every, some = toxicity.Restorer(toxicity.Channel(costs)), toxicity.Restorer(toxicity.Channel(costs), telling, {"abbba"})
    for _ in range(3000):
        token = "".join(rnd.choice("aabbls$$68!1-. _") for _ in range(rnd.randint(3, 9)))
        if toxicity.bare(token) not in some.known:
            assert telling & set(every[token].split()) == telling & set(some[token].split()), token
    assert some["abbba"] == "abbba"


def test_toxicity_without_labels_or_texts(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r["score"] for r in toxicity.report(docs(["a", None]), none).collect()] == [0.5, 0.5]
    assert toxicity.report(docs([]), none).count() == 0


def test_decoder_prefers_what_the_model_knows(words):
    costs = np.full((toxicity.SYMBOLS,) * 4, 5.0, np.float32)
    code = 0
    for s in [*map(toxicity.symbol, "class"), 0]:
        code = code % toxicity.SYMBOLS**3 * toxicity.SYMBOLS + s
        costs.ravel()[code] = 0.1
    restore = toxicity.Restorer(toxicity.Channel(costs))
    assert restore["cl4$$"] == "class" and restore["claaass"] == "class" and restore["c.l.a.s.s"] == "class"
    assert restore["Word"] == "Word" and restore["the&&&"] == "the" and restore["the!!"] == "the"


def test_grades_on_held_out_documents(spark, docs, words):
    rnd = random.Random(8)
    texts, labels = [], []
    for i in range(300):
        grade = i % 3
        said = [rnd.choice(words) + ("###" if grade == 0 else "") for _ in range(50)]
        if grade == 1:
            said += ["moron"] * 4
        texts.append((i, " ".join(said)))
        labels.append((i, int(grade > 0), int(grade == 1)))
    table = spark.createDataFrame(labels + [(1, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = by_id(quality_classifier.report(docs(texts + [(500, None), (501, "")]), table))
    held = [i for i in range(300) if got[i]["held_out"]]
    assert all(got[i]["kept"] == (i % 3 > 0) for i in held)
    means = [np.mean([got[i]["expected_grade"] for i in held if i % 3 == g]) for g in range(3)]
    assert means[0] < means[1] < means[2]
    assert 0 < got[500]["p_tail"] < 1 and got[500]["p_tail"] == got[501]["p_tail"]
    assert all(0 <= r["expected_grade"] <= 2 for r in got.values())
    assert quality_classifier.select(docs(texts), table).columns == docs([]).columns
    even = by_id(quality_classifier.report(docs(["a"]), table.limit(0)))[0]
    assert even["expected_grade"] == pytest.approx(1.0) and even["p_tail"] == pytest.approx(2 / 3)


def test_slopes_of_the_cumulative_link_fit():
    """One feature that orders three grades: thresholds stay ordered and the score rises with it."""
    doc, ids = np.arange(90), np.zeros(90, np.int64)
    grade = np.repeat([0, 1, 2], 30)
    model = quality_classifier.CumulativeLink.fit(doc, ids, grade / 2.0, grade)
    assert model.weights[0] > 1 and model.thresholds[0] < model.thresholds[1]


@pytest.mark.parametrize("frequent", [200_000, 7])
def test_language_model_counts_and_beats_the_base(spark, docs, monkeypatch, words, frequent):
    """Also with most counts coming from the join."""
    monkeypatch.setattr(language_model, "FREQUENT", frequent)
    rnd = random.Random(9)
    texts = [(i, " ".join(f"{a} {a}x" for a in (rnd.choice(words[:30]) for _ in range(40)))) for i in range(120)]
    texts += [(500, None), (501, ""), (502, "Unseen words"), (502, "Unseen words"), (None, "tare")]
    rows = language_model.report(docs(texts)).collect()
    assert len(rows) == len(texts)
    tokens = [(i, [*(t or "").lower().split(), ""]) for i, t in texts]
    held = lambda i: part("" if i is None else i, 5) == 1
    c = Counter(w for i, t in tokens if not held(i) for w in t)
    n, v = sum(c.values()), len(c)
    expected = {i: (held(i), len(t), sum(c[w] > 0 for w in t), n, sum(log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)) for i, t in tokens}
    for r in rows:
        assert tuple(r)[1:5] == expected[r["doc_id"]][:4]
        assert r["base_score"] == pytest.approx(expected[r["doc_id"]][4])
    out = [r for r in rows if r["held_out"] and r["n_tokens"] > 5]
    if frequent > 7:  # with a full list of classes
        assert sum(r["score"] for r in out) > 0.8 * sum(r["base_score"] for r in out)


def test_layout_of_files_plays_no_part_in_the_language_model(spark, docs, words):
    rnd = random.Random(11)
    texts = [(i, " ".join(f"{a} {a}x" for a in (rnd.choice(words[:30]) for _ in range(40)))) for i in range(60)]
    one, many = (by_id(language_model.report(docs(texts).repartition(n))) for n in (1, 12))
    assert all(one[i]["score"] == pytest.approx(many[i]["score"], abs=0.01) for i in one)
    assert len(one) == len(many) == 60


def test_probabilities_add_up_to_one():
    words = [b"", b"the", *(b"w%d" % i for i in range(300))]
    counts = list(range(400, 400 - len(words), -1))
    totals, kinds = np.zeros(language_model.SUFFIXES), np.zeros(language_model.SUFFIXES)
    model = language_model.Model(words, counts, totals, kinds, sum(counts), len(words))
    for w, c in zip(words, counts):
        if w not in model.class_of:
            totals[language_model.suffix_class(w) - language_model.SHORTLIST] += c
            kinds[language_model.suffix_class(w) - language_model.SHORTLIST] += 1
    model.network = language_model.Network.initial(model.noise)
    table = 10 ** model.table.reshape(-1, language_model.CLASSES).astype(float)
    assert np.allclose(table.sum(1), 1, atol=1e-4)
    share = np.zeros(language_model.CLASSES)
    for w, c, k in zip(words, counts, model.classes):
        share[k] += 1 if w in model.class_of else (c + 0.5) / 10 ** model.log_share[k]
    unseen = 0.5 / 10 ** model.log_share[language_model.SHORTLIST:]
    assert np.allclose(share[language_model.SHORTLIST:] + unseen, 1)


def test_context_ends_with_the_text():
    code = language_model.context_codes(np.array([4, 5, 9, 6, 9]), np.array([0, 3]), 9)
    assert [divmod(int(c), language_model.CLASSES) for c in code] == [(9, 9), (9, 4), (4, 5), (9, 9), (9, 6)]


def test_language_model_of_empty_tables(spark, docs):
    assert language_model.report(docs([])).count() == 0
    rows = language_model.report(docs([(3, "only held out")])).collect() if part(3, 5) == 1 else []
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 for r in rows)


def test_character_counts_cover_all_documents(spark, docs):
    """Against plain loops; a word of letters counts once a document, labelled or not."""
    texts = ["the The cat!", "the éa", None, "", "a1 b", "cat", "caaat"]
    expected = Counter()
    for text in texts:
        for word in {w for w in (text or "").lower().split() if w.isalpha() and w != "caaat"}:
            code = 0
            for s in [*map(toxicity.symbol, word), 0]:
                code = code % toxicity.SYMBOLS**3 * toxicity.SYMBOLS + s
                expected[code] += 1
    table = toxicity.character_counts(docs(texts))
    assert {int(i): int(table[i]) for i in np.flatnonzero(table)} == expected
    assert toxicity.character_counts(docs([])).sum() == 0
    assert np.allclose(np.exp(-toxicity.character_costs(table, {"moron": 1.0})).sum(-1), 1, atol=1e-4)


def test_pipeline_and_report_reject_the_same_documents(spark, docs, words, monkeypatch):
    """Also where the bound on calibrating rows is reached."""
    monkeypatch.setattr(toxicity, "MOST_LABELLED", 60)
    rnd = random.Random(5)
    texts = [(i, " ".join(rnd.choice(words) for _ in range(30)) + (" moron idiot" if i % 4 == 0 else "")) for i in range(400)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i, _ in texts], "doc_id long, quality int, toxic int")
    rejected = {r["doc_id"] for r in toxicity.report(docs(texts), labels).where("predicted = 1").collect()}
    kept = {r["doc_id"] for r in toxicity.keep_clean(docs(texts), labels).collect()}
    assert rejected and kept == {i for i, _ in texts} - rejected
