import corpus_pipeline
import __spark_entry__ as entry
from tickloom.llm.queries import QUERIES
from verify.compare import compare, connect

SMALL = "/root/testdata/sf0.001"


def test_every_operator_has_one_query_and_the_entry_lists_them():
    numbers = sorted(int(name[2:].split("_")[0]) for name in QUERIES if name.startswith("op"))
    assert numbers == list(range(1, 11)) and "pipeline" in QUERIES
    assert set(QUERIES) <= set(entry.queries())


def test_sql_gives_the_same_rows(spark):
    for name, sql in entry.oracle_sql().items():
        if name in QUERIES:
            assert compare(QUERIES[name](spark, SMALL), connect(SMALL), sql) == "", name


def test_stages_pass_documents_on(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns, rows = docs.columns, docs.count()
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / str(i)))
        docs = spark.read.parquet(str(tmp_path / str(i)))
        assert docs.count() <= rows
        rows = docs.count()
        assert docs.columns == columns or name == "encoding"
    assert rows > 100 and docs.columns == [*columns, "token_ids"]
    assert docs.where("size(token_ids) = 0 and length(text) > 0").isEmpty()


def test_stages_take_tables_without_rows(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
    assert docs.count() == 0


def test_run_equals_brute_force_after_the_learned_stage(spark):
    """The score of the first stage is taken from its query; all else is recomputed in plain Python."""
    import re

    import sentencepiece

    from tests.llm.test_near_copies import brute
    from tests.llm.test_texts import brute_hits, brute_secrets
    from tickloom.llm import pieces

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    toxic = {r["doc_id"] for r in QUERIES["op9_toxicity"](spark, SMALL).collect() if r["predicted"]}
    left = {i: t for i, t in docs.items() if i not in toxic}
    left = {i: left[i] for i, (_, first) in brute(list(left.items())).items() if i == first}
    windows = {" ".join(w[k:k + 10]) for _, t in items for w in [re.findall("[0-9a-z\x80-\U0010ffff]+", t.lower())] for k in range(len(w) - 9)}
    said = lambda t: f" {' '.join(re.findall('[0-9a-z' + chr(128) + '-' + chr(0x10ffff) + ']+', t.lower()))} "
    left = {i: t for i, t in left.items() if not any(f" {w} " in said(t) for w in windows)}
    some = sorted(set(docs) - toxic)[:3]
    assert all((brute_hits(docs[i], items)[1] > 0) == any(f" {w} " in said(docs[i]) for w in windows) for i in some)
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    expected = {}
    for i, text in left.items():
        runs: list[list[int]] = []
        for a, _, b in brute_secrets(text):
            if runs and a <= runs[-1][1]:
                runs[-1][1] = max(b, runs[-1][1])
            else:
                runs.append([a, b])
        for a, b in reversed(runs):
            text = text[:a] + "[SECRET]" + text[b:]
        expected[i] = (text, len(text), library.encode(text))
    got = {r["doc_id"]: (r["text"], r["n_chars"], list(r["token_ids"])) for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert got == expected and len(got) > 100
