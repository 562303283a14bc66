"""Keyword rules and recommendations over a whole ticket table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import fixed_values as fv
from tickloom.functions.text import first_match
from tickloom.operators.joins import checked_broadcast
from tickloom.operators.windows import first_n
from tickloom.sources.lookups import literal_table


def ticket_text(summary: Column, description: Column) -> Column:
    blank = F.lit("")
    return F.lower(F.concat(F.coalesce(summary, blank), F.lit(" "), F.coalesce(description, blank)))


def rule_predict(df: DataFrame, summary: str, description: str) -> DataFrame:
    """ML-12: type and resolution by keyword, first match wins."""
    text = ticket_text(F.col(summary), F.col(description))
    kind, resolution = fv.PREDICTION_DEFAULT
    return df.withColumns({
        "pred_issuetype": first_match(text, [(w, t) for w, t, _ in fv.PREDICTION_RULES], kind),
        "pred_resolution": first_match(text, [(w, r) for w, _, r in fv.PREDICTION_RULES], resolution),
    })


def _by_value(value: Column, options: dict[str, str], default: str) -> Column:
    chain = F
    for key, result in options.items():
        chain = chain.when(value == key, F.lit(result))
    return chain.otherwise(F.lit(default))


def _by_group(value: Column, groups: list[tuple[list[str], str]], default: str) -> Column:
    chain = F
    for members, result in groups:
        chain = chain.when(value.isin(members), F.lit(result))
    return chain.otherwise(F.lit(default))


def recommend(df: DataFrame, summary: str, description: str, priority: str, issuetype: str,
              resolution: str) -> DataFrame:
    """ML-13: assignment, context, action, three steps and urgency as one text."""
    normal = lambda c: F.lower(F.trim(F.col(c)))
    kind = normal(issuetype)
    steps = [
        _by_group(kind, [(members, texts[i]) for members, texts in fv.STEPS_BY_TYPE], fv.STEPS_DEFAULT[i])
        for i in range(3)
    ]
    text = F.concat(
        F.lit("Assignation : "), _by_value(kind, fv.ASSIGNMENT_BY_TYPE, fv.ASSIGNMENT_DEFAULT),
        F.lit("\nContexte : "),
        first_match(ticket_text(F.col(summary), F.col(description)), fv.CONTEXT_RULES, fv.CONTEXT_DEFAULT),
        F.lit("\nAction principale : "),
        _by_value(normal(resolution), fv.ACTION_BY_RESOLUTION, fv.ACTION_DEFAULT),
        F.lit("\nÉtapes concrètes :\n1. "), steps[0], F.lit("\n2. "), steps[1], F.lit("\n3. "), steps[2],
        F.lit("\nPriorité : "), _by_group(normal(priority), fv.URGENCY_BY_PRIORITY, fv.URGENCY_DEFAULT),
    )
    return df.withColumns({"recommendation": text, "recommendation_source": F.lit(fv.RECOMMENDATION_SOURCE)})


def fallback_library(spark: SparkSession) -> DataFrame:
    rows = [
        (kind, place, *reference)
        for kind, references in [*fv.FALLBACK_REFERENCES.items(), ("", fv.FALLBACK_GENERIC)]
        for place, reference in enumerate(references)
    ]
    return literal_table(spark, ["type", "place", "ref_key", "ref_summary", "ref_resolution"], rows)


def fallback_refs(types: DataFrame, k: int = 3) -> DataFrame:
    """ML-14: stock references for each distinct type, generic ones for an unknown type."""
    library = fallback_library(types.sparkSession).filter(F.col("place") < max(1, k))
    known = F.broadcast(library.select(F.lower("type").alias("_known")).filter("_known <> ''").distinct())
    wanted = types.select(F.trim("issuetype").alias("issuetype")).distinct()
    wanted = wanted.join(known, F.lower("issuetype") == F.col("_known"), "left")
    match = F.lower("type") == F.coalesce("_known", F.lit(""))
    return wanted.join(F.broadcast(library), match).select(
        F.col("ref_key").alias("key"),
        F.col("ref_summary").alias("summary_clean"),
        F.coalesce(F.nullif("issuetype", F.lit("")), F.lit("Other")).alias("issuetype"),
        F.col("ref_resolution").alias("resolution"),
        F.round(F.lit(0.9) - F.lit(0.1) * F.col("place"), 3).alias("similarity"),
        F.lit("fallback").alias("source"),
    )


def references(types: DataFrame, mart: DataFrame, k: int = 3) -> DataFrame:
    """Past tickets per type, stock references where the mart has none.

    The few wanted types are broadcast after a count: a join that shuffled by
    type would put a whole class into one task.
    """
    wanted = checked_broadcast(types.select("issuetype").distinct())
    past = first_n(
        mart.join(wanted, "issuetype", "left_semi").select("key", "summary_clean", "issuetype", "resolution"),
        ["issuetype"], ["key"], k,
    ).withColumns({"similarity": F.lit(0.0), "source": F.lit("mart")})
    missing = wanted.join(mart.select("issuetype").distinct(), "issuetype", "left_anti")
    return past.unionByName(fallback_refs(missing, k))


def advise(requests: DataFrame, mart: DataFrame, k: int = 3) -> DataFrame:
    """Rule prediction, recommendation and reference keys for a table of new tickets.

    ``requests`` has ``key``, ``summary``, ``description`` and ``priority``; it
    is read once, for references are looked up for every type the rules know.
    """
    predicted = rule_predict(requests, "summary", "description")
    advised = recommend(predicted, "summary", "description", "priority", "pred_issuetype", "pred_resolution")
    possible = sorted({kind for _, kind, _ in fv.PREDICTION_RULES} | {fv.PREDICTION_DEFAULT[0]})
    found = references(literal_table(requests.sparkSession, ["issuetype"], [(kind,) for kind in possible]), mart, k)
    # At most k references for each of these few types.
    per_type = found.groupBy(F.col("issuetype").alias("pred_issuetype")).agg(
        F.array_join(F.array_sort(F.collect_list("key")), ", ").alias("reference_keys")
    )
    return advised.join(F.broadcast(per_type), "pred_issuetype", "left").select(
        "key", "pred_issuetype", "pred_resolution", "recommendation", "recommendation_source", "reference_keys"
    )
