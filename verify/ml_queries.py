"""Registered queries for features, training, scoring, evaluation and rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions import fixed_values as fv, labels
from tickloom.ml import embed, evaluate, features, neighbours, rules, train
from tickloom.operators import filters
from tickloom.operators.aggregates import first_by
from tickloom.sources.tables import write_table, written_once
from verify.operator_queries import scratch
from verify.oracle import TEXT, half_up, in_list, q, rules as rules_sql, sql, values
from verify.queries import ORACLE, Models, register

c = F.col
SCALED = ["resolution_days", "summary_length", "description_length"]


def tickets(m: Models) -> DataFrame:
    return filters.in_splits(m.cleaned(), ["train", "validation"])


def predicted(m: Models) -> DataFrame:
    return rules.rule_predict(tickets(m), "summary", "description")


def _ml01(m: Models) -> DataFrame:
    rows = tickets(m)
    scaler = features.fit_scaler(rows.filter("split = 'train'"), SCALED)
    return scaler.transform(rows).select("key", *[F.round(f"{n}_scaled", 6).alias(n) for n in SCALED])


_fc = lambda n: f"least(coalesce({n}, 0), 1e6)::DOUBLE"
register("ml01_scale", _ml01, sql(
    "SELECT key, " + ", ".join(f"round(({_fc(n)} - m_{n}) / s_{n}, 6) AS {n}" for n in SCALED) + " FROM tickets, (SELECT "
    + ", ".join(f"avg({_fc(n)}) AS m_{n}, stddev_pop({_fc(n)}) AS s_{n}" for n in SCALED) + " FROM tickets WHERE split = 'train')"))


def vectors(m: Models) -> DataFrame:
    """Embeddings with two numbers of the order of the same id."""
    orders = m.table("orders").select(c("o_orderkey").alias("vec_id"), "o_totalprice", "o_custkey")
    rows = m.table("embeddings").join(orders, "vec_id", "left")
    scaler = features.fit_scaler(rows, ["o_totalprice", "o_custkey"])
    scaled = scaler.transform(rows)
    return features.assemble(scaled, "embedding", ["o_totalprice_scaled", "o_custkey_scaled"]).select("vec_id", "label", "features")


def _ml02(m: Models) -> DataFrame:
    from pyspark.ml.functions import vector_to_array

    values = F.transform(vector_to_array("features"), lambda x: F.round(x, 5))
    return vectors(m).select("vec_id", "label", values.alias("features"))


_scaled = lambda n: f"({_fc(n)} - avg({_fc(n)}) OVER ()) / stddev_pop({_fc(n)}) OVER ()"
ORDER_NUMBERS = ("o_totalprice", "o_custkey")
register("ml02_assemble", _ml02, f"""
    SELECT vec_id, label, list_transform(list_concat(embedding::DOUBLE[], [{', '.join(map(_scaled, ORDER_NUMBERS))}]), lambda x: round(x, 5)) AS features
    FROM embeddings LEFT JOIN orders ON vec_id = o_orderkey""")
register("ml03_class_weights", lambda m: features.with_class_weights(tickets(m), "issuetype")
         .select("key", "issuetype", F.round("weight", 6).alias("weight")),
         sql("""SELECT key, issuetype, round((SELECT count(*) FROM tickets)::DOUBLE
                  / ((SELECT count(DISTINCT issuetype) FROM tickets) * n), 6) AS weight
                FROM tickets JOIN (SELECT issuetype, count(*) AS n FROM tickets GROUP BY 1) USING (issuetype)"""))
register("ml04_oversample", lambda m: features.oversample(
    tickets(m).select("key", labels.merge_rare(c("issuetype"), fv.RARE_ISSUETYPES_5).alias("issuetype")), "issuetype"),
    sql("""SELECT key, issuetype, copy FROM (
             SELECT key, issuetype, unnest(range(1, target // n + CASE WHEN rn <= target % n THEN 1 ELSE 0 END + 1)) AS copy FROM (
               SELECT key, issuetype, n, greatest(n, med) AS target,
                 row_number() OVER (PARTITION BY issuetype ORDER BY md5(key || '#42'), key) AS rn
               FROM (SELECT key, CASE WHEN issuetype IN ('Task', 'Documentation', 'Test', 'Question') THEN 'Other' ELSE issuetype END AS issuetype FROM tickets)
               JOIN (SELECT *, CAST(floor(median(n) OVER ()) AS BIGINT) AS med FROM (
                 SELECT CASE WHEN issuetype IN ('Task', 'Documentation', 'Test', 'Question') THEN 'Other' ELSE issuetype END AS issuetype,
                   count(*) AS n FROM tickets GROUP BY 1)) USING (issuetype)))"""))


def _fitted(m: Models) -> tuple[DataFrame, train.Classifier]:
    # The weights, the fit and what follows read the vectors; they are joined and assembled once.
    rows = written_once(vectors(m).withColumn("label", c("label").cast("string")), "vectors")
    weighted = features.with_class_weights(rows, "label")
    return rows, train.fit_lr(weighted, "label", C=1.0, weight="weight")


def _ml05(m: Models) -> DataFrame:
    rows, model = _fitted(m)
    weights = [(k, i, float(v)) for k, row in enumerate(model.model.coefficientMatrix.toArray()) for i, v in enumerate(row)]
    return m.spark.createDataFrame(weights, "class int, feature int, weight double")


def _ml06(m: Models) -> DataFrame:
    rows, model = _fitted(m)
    return model.score(rows, "prediction_label", "confidence").select("vec_id", "label", "prediction_label", "confidence")


RUNS: dict[tuple[str, str, str], tuple[DataFrame, DataFrame]] = {}


def _trained(m: Models, run) -> tuple[DataFrame, DataFrame]:
    """The mart and the predictions of a training run with its own defaults; written once per session."""
    place = (m.spark.sparkContext.applicationId, m.sf_dir, run.__name__)
    if place not in RUNS:
        mart = m.mart_ml().withColumn("issuetype", labels.merge_rare(c("issuetype"), fv.RARE_ISSUETYPES_5))
        mart = write_table(mart, scratch(m, "mart"))
        by_type = write_table(embed.embed_tfidf(mart, "text_for_it", as_vector=True), scratch(m, "type_vectors"))
        by_resolution = write_table(embed.embed_tfidf(mart, "text_for_res", as_vector=True), scratch(m, "resolution_vectors"))
        RUNS[place] = mart, write_table(run(mart, by_type, by_resolution), scratch(m, "predictions"))
    return RUNS[place]


def _checked(m: Models, run) -> DataFrame:
    """One row per validation ticket: its labels, and whether the predictions are possible ones."""
    mart, rows = _trained(m, run)
    known = lambda label: F.array(*[F.lit(x) for x in train.label_classes(filters.in_splits(mart, ["train"]), label)])
    likely = lambda p: (c(p) > 0) & (c(p) <= 1)
    return rows.select(
        "key", "true_issuetype", "true_resolution", "method", "fix_summary",
        F.array_contains(known("issuetype"), c("pred_issuetype")).alias("known_issuetype"),
        F.array_contains(known("resolution"), c("pred_resolution")).alias("known_resolution"),
        (likely("conf_issuetype") & likely("conf_resolution")).alias("likely"))


def _checked_sql(method: str) -> str:
    return sql(f"""SELECT key, CASE WHEN issuetype IN {in_list(fv.RARE_ISSUETYPES_5)} THEN 'Other' ELSE issuetype END AS true_issuetype,
        resolution AS true_resolution, '{method}' AS method, '' AS fix_summary, true AS known_issuetype, true AS known_resolution, true AS likely
        FROM mart_ml WHERE split = 'validation'""")


def _products(rows: DataFrame) -> DataFrame:
    """class, feature, product: miss of the class times value of the feature, summed over
    the rows of a task; a task sends classes times features rows, however many it reads."""
    def multiply(batches):
        import numpy as np
        import pyarrow as pa

        total = 0.0
        for batch in batches:
            if batch.num_rows:
                miss, x = (column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) for column in batch.columns)
                total = total + miss.T @ x
        if np.ndim(total):
            kind, feature = np.indices(total.shape, dtype="int32")
            yield pa.RecordBatch.from_arrays([pa.array(v.ravel()) for v in (kind, feature, total)], names=["class", "feature", "product"])

    return rows.mapInArrow(multiply, "class int, feature int, product double")


def _fit_checks(m: Models) -> DataFrame:
    """Of the fitted weights: class set, probabilities that add up to 1, and the
    slope of the penalised loss at them, which is 0 at the best ones."""
    rows, model = _fitted(m)
    plain = train.LinearClassifier.of(model)
    from pyspark.ml.functions import vector_to_array

    scored = features.with_class_weights(rows, "label").withColumn("x", vector_to_array("features")).withColumn("p", plain.probabilities(c("x")))
    total = scored.agg(F.sum("weight")).first()[0]
    miss = F.transform("p", lambda p, i: (p - (F.element_at(F.array(*[F.lit(x) for x in plain.classes]), i + 1) == c("label")).cast("double")) * c("weight"))
    slopes = _products(scored.select(miss.alias("miss"), "x"))
    slopes = slopes.groupBy("class", "feature").agg((F.sum("product") / total).alias("slope"))
    weights = m.spark.createDataFrame(
        [(k, i, w) for k, row in enumerate(plain.coefficients) for i, w in enumerate(row)], "class int, feature int, w double")
    steep = slopes.join(weights, ["class", "feature"]).agg(F.max(F.abs(c("slope") + c("w") / total))).first()[0]
    return scored.agg(
        F.count_distinct("label").alias("n_classes"), F.count("*").alias("n_rows"),
        F.max(F.abs(F.aggregate("p", F.lit(0.0), lambda s, p: s + p) - 1) < 1e-9).alias("adds_up"),
        F.lit(steep < 1e-3).alias("flat"))


PINNED = train.LinearClassifier(
    [[round(((k + 2) * (i + 3) % 11 - 5) / 10, 2) for i in range(66)] for k in range(3)], [0.1, -0.2, 0.05], ["a", "b", "c"])


def _pinned_sql(x: str, model: train.LinearClassifier, label: str, confidence: str, source: str, keys: str) -> str:
    product = lambda row: f"list_inner_product({x}, [{', '.join(map(str, row))}]::DOUBLE[])"
    scores = ", ".join(f"{product(row)} + {b}" for row, b in zip(model.coefficients, model.intercepts))
    named = ", ".join(map(q, model.classes))
    return f"""SELECT {keys}, [{named}][list_position(s, list_max(s))] AS {label},
        round(1 / list_sum(list_transform(s, lambda v: exp(v - list_max(s)))), 4) AS {confidence}
        FROM (SELECT *, [{scores}] AS s FROM {source})"""


def _pinned(m: Models) -> DataFrame:
    return PINNED.score(_ml02(m), "features", "prediction_label", "confidence").select("vec_id", "prediction_label", "confidence")


register("ml06_train_and_predict", lambda m: _checked(m, train.train_and_predict), _checked_sql("LR_BALANCED"))
register("ml06_train_weighted", lambda m: _checked(m, train.train_weighted), _checked_sql("LR_WEIGHTED"))
register("ml05_fit_lr", _ml05)
register("ml05_fit_checks", _fit_checks, "SELECT count(DISTINCT label) AS n_classes, count(*) AS n_rows, true AS adds_up, true AS flat FROM embeddings")
register("ml06_score", _ml06)
register("ml06_score_pinned", _pinned, _pinned_sql("features", PINNED, "prediction_label", "confidence", "(" + ORACLE["ml02_assemble"] + ")", "vec_id"))
register("ml07_evaluate", lambda m: evaluate.evaluate(predicted(m), "issuetype", "pred_issuetype"), sql(
    """SELECT round(sum(CASE WHEN issuetype = pred_issuetype THEN 1 ELSE 0 END) / count(*)::DOUBLE, 4) AS accuracy,
         (SELECT round(avg(f1), 4) FROM (
            SELECT 2 * count(*) FILTER (issuetype = l AND pred_issuetype = l) /
              (count(*) FILTER (issuetype = l) + count(*) FILTER (pred_issuetype = l))::DOUBLE AS f1
            FROM predicted, (SELECT issuetype AS l FROM predicted UNION SELECT pred_issuetype FROM predicted) GROUP BY l)) AS macro_f1,
         count(*) AS n FROM predicted"""))

REPORT = """SELECT l AS label, coalesce(h / nullif(p, 0)::DOUBLE, 0) AS precision, coalesce(h / nullif(s, 0)::DOUBLE, 0) AS recall,
    coalesce(2 * h / nullif(s + p, 0)::DOUBLE, 0) AS f1, s AS support FROM (
      SELECT l, count(*) FILTER (resolution = l AND pred_resolution = l) AS h, count(*) FILTER (resolution = l) AS s,
        count(*) FILTER (pred_resolution = l) AS p
      FROM predicted, (SELECT resolution AS l FROM predicted UNION SELECT pred_resolution FROM predicted) GROUP BY l)"""
register("ml08_class_report", lambda m: evaluate.full_report(predicted(m), "resolution", "pred_resolution"), sql(
    f"""SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM (
        SELECT * FROM ({REPORT}) UNION ALL
        SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support)::BIGINT FROM ({REPORT}) UNION ALL
        SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
          sum(f1 * support) / sum(support), sum(support)::BIGINT FROM ({REPORT}))"""))
register("ml09_confusion", lambda m: evaluate.confusion(predicted(m), "resolution", "pred_resolution", fv.RESOLUTION_CLASSES), sql(
    "SELECT t AS true_label, " + ", ".join(
        f'count(*) FILTER (resolution = t AND pred_resolution = {q(x)}) AS "{x}"' for x in fv.RESOLUTION_CLASSES)
    + f" FROM predicted, ({values([(x,) for x in fv.RESOLUTION_CLASSES])}) v(t) GROUP BY t"))
register("ml10_class_distribution", lambda m: evaluate.class_distribution(tickets(m), "resolution"), sql(
    """SELECT resolution, count(*) FILTER (split = 'train') AS n_train, count(*) FILTER (split = 'validation') AS n_validation
       FROM tickets GROUP BY 1"""))
register("ml11_embed_tfidf", lambda m: embed.embed_tfidf(m.table("documents"), "text", "doc_id"))


def _embedding_checks(m: Models) -> DataFrame:
    """Per distinct text: documents, distinct vectors, their width and length."""
    docs = m.table("documents")
    both = embed.embed_tfidf(docs, "text", "doc_id").join(docs.select("doc_id", F.md5("text").alias("text_md5")), "doc_id")
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return both.groupBy("text_md5").agg(
        F.count("*").alias("n"), F.count_distinct("embedding").alias("n_vectors"), F.max(F.size("embedding")).alias("width"),
        F.round(F.min(norm), 5).alias("norm"))


register("ml11_embedding_checks", _embedding_checks,
         "SELECT md5(text) AS text_md5, count(*) AS n, 1::BIGINT AS n_vectors, 1024 AS width, 1.0::DOUBLE AS norm FROM documents GROUP BY 1")


def letter_encoder():
    """A stand-in model: letter counts."""
    import numpy as np

    def encode(texts):
        return np.array([[t.lower().count(chr(97 + i)) for i in range(26)] for t in texts], dtype="float64")

    return encode


def _ml11(m: Models) -> DataFrame:
    docs = m.table("documents")
    out = embed.embed(docs, "text", letter_encoder, "doc_id")
    return out.select("doc_id", F.transform("embedding", lambda x: F.round(x.cast("double"), 4)).alias("embedding"))


register("ml11_embed", _ml11, """
    SELECT doc_id, list_transform(v, lambda x: round((x / CASE WHEN n = 0 THEN 1 ELSE n END)::FLOAT::DOUBLE, 4)) AS embedding FROM (
      SELECT doc_id, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS n FROM (
        SELECT doc_id, list_transform(range(0, 26), lambda i:
          (length(lower(text)) - length(replace(lower(text), chr(CAST(97 + i AS INTEGER)), '')))::DOUBLE) AS v FROM documents))""")
def _ml11_merge(m: Models) -> DataFrame:
    """A table that lacks a quarter of the documents, holds older texts of another
    quarter and keys that are gone, brought up to date."""
    docs = m.table("documents").select("doc_id", "text")
    before = docs.filter("doc_id % 4 <> 0").withColumn("text", F.when(c("doc_id") % 4 == 1, F.concat(F.lit("old "), "text")).otherwise(c("text")))
    gone = docs.filter("doc_id % 4 = 2").select((c("doc_id") + 1_000_000_000).alias("doc_id"), "text")
    path = scratch(m, "embeddings")
    embed.update_embeddings(m.spark, path, before.unionByName(gone), "text", letter_encoder, "doc_id")
    out = embed.update_embeddings(m.spark, path, docs, "text", letter_encoder, "doc_id")
    return out.withColumn("embedding", F.transform("embedding", lambda x: F.round(x.cast("double"), 4)))


register("ml11_merge_embeddings", _ml11_merge, """
    SELECT doc_id, sha256(text) AS digest, text NOT IN (SELECT CASE WHEN doc_id % 4 = 1 THEN 'old ' || text ELSE text END FROM documents WHERE doc_id % 4 <> 0) AS encoded,
      list_transform(v, lambda x: round((x / CASE WHEN n = 0 THEN 1 ELSE n END)::FLOAT::DOUBLE, 4)) AS embedding FROM (
      SELECT doc_id, text, v, sqrt(list_sum(list_transform(v, lambda x: x * x))) AS n FROM (
        SELECT doc_id, text, list_transform(range(0, 26), lambda i:
          (length(lower(text)) - length(replace(lower(text), chr(CAST(97 + i AS INTEGER)), '')))::DOUBLE) AS v FROM documents))""")
register("ml12_rule_predict", lambda m: predicted(m).select("key", "pred_issuetype", "pred_resolution"),
         sql("SELECT key, pred_issuetype, pred_resolution FROM predicted"))


def _case(subject: str, groups: list[tuple[list[str], str]], default: str) -> str:
    arms = " ".join(f"WHEN {subject} IN ({', '.join(map(q, members))}) THEN {q(v)}" for members, v in groups)
    return f"CASE {arms} ELSE {q(default)} END"


def _recommendation() -> str:
    kind, res, prio = "lower(pred_issuetype)", "lower(pred_resolution)", "lower(trim(priority, ' '))"
    each = lambda d: [([k], v) for k, v in d.items()]
    step = lambda i: _case(kind, [(members, t[i]) for members, t in fv.STEPS_BY_TYPE], fv.STEPS_DEFAULT[i])
    parts = ["'Assignation : '", _case(kind, each(fv.ASSIGNMENT_BY_TYPE), fv.ASSIGNMENT_DEFAULT),
             "chr(10) || 'Contexte : '", rules_sql(TEXT, fv.CONTEXT_RULES, fv.CONTEXT_DEFAULT),
             "chr(10) || 'Action principale : '", _case(res, each(fv.ACTION_BY_RESOLUTION), fv.ACTION_DEFAULT),
             "chr(10) || 'Étapes concrètes :' || chr(10) || '1. '", step(0), "chr(10) || '2. '", step(1), "chr(10) || '3. '", step(2),
             "chr(10) || 'Priorité : '", _case(prio, fv.URGENCY_BY_PRIORITY, fv.URGENCY_DEFAULT)]
    return " || ".join(parts)


register("ml13_recommend", lambda m: rules.recommend(
    predicted(m), "summary", "description", "priority", "pred_issuetype", "pred_resolution")
    .select("key", "recommendation", "recommendation_source"),
    sql(f"SELECT key, {_recommendation()} AS recommendation, {q(fv.RECOMMENDATION_SOURCE)} AS recommendation_source FROM predicted"))

LIBRARY = values([
    (kind.lower(), str(i), *ref)
    for kind, refs in [*fv.FALLBACK_REFERENCES.items(), ("", fv.FALLBACK_GENERIC)] for i, ref in enumerate(refs)
])
FALLBACK = """SELECT ref_key AS key, ref_summary AS summary_clean, issuetype, ref_resolution AS resolution,
    round(0.9::DOUBLE - 0.1::DOUBLE * place::INTEGER, 3) AS similarity, 'fallback' AS source
    FROM (SELECT DISTINCT issuetype FROM {0}) JOIN lib ON type = CASE WHEN lower(issuetype) IN (SELECT type FROM lib) THEN lower(issuetype) ELSE '' END"""
WITH_LIB = f", lib AS (SELECT * FROM ({LIBRARY}) v(type, place, ref_key, ref_summary, ref_resolution)) "


def _with_lib(final: str) -> str:
    query = sql("SELECT * FROM tickets, predicted")
    return query[: query.rindex("SELECT * FROM tickets, predicted")].rstrip() + WITH_LIB + final


register("ml14_fallback_refs", lambda m: rules.fallback_refs(tickets(m).select("issuetype")), _with_lib(FALLBACK.format("tickets")))
register("ml14_references", lambda m: rules.references(
    predicted(m).select(c("pred_issuetype").alias("issuetype")),
    _past(m)),
    _with_lib(f"""SELECT key, summary AS summary_clean, issuetype, resolution, 0.0::DOUBLE AS similarity, 'mart' AS source
        FROM tickets WHERE issuetype IN (SELECT pred_issuetype FROM predicted)
        QUALIFY row_number() OVER (PARTITION BY issuetype ORDER BY key) <= 3
        UNION ALL SELECT * FROM ({FALLBACK.format('''(SELECT pred_issuetype AS issuetype FROM predicted WHERE pred_issuetype NOT IN
          (SELECT issuetype FROM tickets))''')})"""))


def _past(m: Models) -> DataFrame:
    return tickets(m).withColumnRenamed("summary", "summary_clean")


register("ml13_advise", lambda m: rules.advise(tickets(m), _past(m)), _with_lib(f"""
    SELECT key, pred_issuetype, pred_resolution, {_recommendation()} AS recommendation,
      {q(fv.RECOMMENDATION_SOURCE)} AS recommendation_source, reference_keys
    FROM predicted JOIN (SELECT issuetype AS pred_issuetype, string_agg(key, ', ' ORDER BY key) AS reference_keys FROM (
        SELECT issuetype, key FROM tickets QUALIFY row_number() OVER (PARTITION BY issuetype ORDER BY key) <= 3
        UNION ALL SELECT issuetype, key FROM ({FALLBACK.format('(SELECT pred_issuetype AS issuetype FROM predicted)')})
          WHERE issuetype NOT IN (SELECT issuetype FROM tickets)) GROUP BY 1) USING (pred_issuetype)"""))


def _described(m: Models) -> DataFrame:
    """Embeddings with the order of the same id as metadata."""
    orders = m.table("orders").select(
        c("o_orderkey").alias("vec_id"), c("o_orderpriority").alias("priority"), c("o_orderstatus").alias("status"),
        c("o_custkey").alias("reporter"))
    return m.table("embeddings").join(orders, "vec_id", "left")


def _ml15_nearest(m: Models) -> DataFrame:
    """The exact form, for the batch of queries whose id is a multiple of 20."""
    rows = _described(m)
    return neighbours.nearest(rows.filter("vec_id % 20 = 0"), rows, key="vec_id", boosts=fv.METADATA_BOOSTS)


def _ml15_recall(m: Models) -> DataFrame:
    """What the approximate form finds of the exact neighbours, for the same batch of queries."""
    rows = _described(m)
    probes = neighbours.probes_for(rows, rows, key="vec_id", boosts=fv.METADATA_BOOSTS)
    found = neighbours.nearest(rows.filter("vec_id % 20 = 0"), rows, key="vec_id", boosts=fv.METADATA_BOOSTS, probes=probes)
    return neighbours.recall(found, _ml15_nearest(m)).select("n", (c("recall") >= 0.9).alias("enough"))


NEAREST = """SELECT a.vec_id AS query, b.vec_id AS neighbour, b.label,
    round(list_inner_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[])
      / (sqrt(list_inner_product(a.embedding::DOUBLE[], a.embedding::DOUBLE[])) * sqrt(list_inner_product(b.embedding::DOUBLE[], b.embedding::DOUBLE[])))
      + CASE WHEN a.o_orderpriority = b.o_orderpriority THEN 0.10 ELSE 0 END
      + CASE WHEN a.o_orderstatus = b.o_orderstatus THEN 0.08 ELSE 0 END
      + CASE WHEN a.o_custkey = b.o_custkey THEN 0.05 ELSE 0 END, 6) AS score
    FROM (SELECT * FROM embeddings LEFT JOIN orders ON vec_id = o_orderkey) a JOIN (SELECT * FROM embeddings LEFT JOIN orders ON vec_id = o_orderkey) b
      ON a.vec_id <> b.vec_id AND a.vec_id % 20 = 0
    QUALIFY row_number() OVER (PARTITION BY a.vec_id ORDER BY score DESC, b.vec_id) <= 15"""
register("ml15_nearest", _ml15_nearest, NEAREST)
register("ml15_recall", _ml15_recall, """SELECT 15 * count(*)::BIGINT AS n, true AS enough
    FROM embeddings WHERE vec_id % 20 = 0""")
register("ml15_knn_vote", lambda m: neighbours.vote(_ml15_nearest(m)), f"""
    SELECT query, label AS prediction, round(weight / total, 4) AS confidence FROM (
      SELECT query, label, sum(score) AS weight, sum(sum(score)) OVER (PARTITION BY query) AS total FROM ({NEAREST}) GROUP BY query, label)
    QUALIFY row_number() OVER (PARTITION BY query ORDER BY round(weight, 6) DESC, label) = 1""")
register("ml16_request_features", lambda m: features.request_features(
    m.ops().select("key", "n_comments", "resolution_days"), ["n_links_total", "n_comments", "resolution_days", "has_parent"], 4),
    sql("""SELECT key, 0.0::DOUBLE AS n_links_total, n_comments::DOUBLE AS n_comments, coalesce(resolution_days, 0)::DOUBLE AS resolution_days,
           0.0::DOUBLE AS has_parent, [0.0, 0.0, 0.0, 0.0]::DOUBLE[] AS embedding FROM ops"""))
REQUEST_NAMES = ["n_comments", "resolution_days", "n_links_total"]
REQUEST_SCALER = features.Scaler(
    {"n_comments": 2.5, "resolution_days": 300.0, "n_links_total": 1.0}, {"n_comments": 2.0, "resolution_days": 250.0, "n_links_total": 0.0})
TYPE_MODEL = train.LinearClassifier([[0.5, 0.5, 0.7, -0.3, 0.2], [0.1, 0.2, -0.4, 0.6, 0.1]], [0.1, 0.0], ["Bug", "Improvement"])
RESOLUTION_MODEL = train.LinearClassifier(
    [[1.0, 1.0, 0.3, -0.8, 0.0], [0.0, 0.0, -0.2, 0.4, 0.5], [0.0, 1.0, 0.1, 0.1, 0.2]], [0.2, 0.1, -0.1], ["Fixed", "Invalid", "Won't Fix"])


def _score_requests(m: Models) -> DataFrame:
    return train.score_requests(m.ops().select("key", "n_comments", "resolution_days"), REQUEST_SCALER, REQUEST_NAMES, 2, TYPE_MODEL, RESOLUTION_MODEL)


_requests = """(SELECT key, [0.0, 0.0, (n_comments - 2.5) / 2.0, (coalesce(resolution_days, 0) - 300.0) / 250.0, -1.0]::DOUBLE[] AS x FROM ops)"""
register("ml16_score_requests", _score_requests, sql(
    "SELECT key, pred_issuetype, conf_issuetype, pred_resolution, conf_resolution FROM ("
    + _pinned_sql("x", TYPE_MODEL, "pred_issuetype", "conf_issuetype", _requests, "key") + ") JOIN ("
    + _pinned_sql("x", RESOLUTION_MODEL, "pred_resolution", "conf_resolution", _requests, "key") + ") USING (key)"))
register("ml17_encode_label", lambda m: m.analytics().select(
    "key", labels.encode_label(c("issuetype"), fv.CLASSES_5).alias("id"),
    labels.decode_label(labels.encode_label(c("issuetype"), fv.CLASSES_5), fv.CLASSES_5).alias("label")),
    sql(f"""SELECT key, CAST(nullif(list_position([{', '.join(map(q, fv.CLASSES_5))}], issuetype), 0) - 1 AS INTEGER) AS id,
            CASE WHEN issuetype IN ({', '.join(map(q, fv.CLASSES_5))}) THEN issuetype END AS label FROM analytics"""))
