"""The registered queries of the operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tickloom.llm import chat, decontaminate, language_model, merkle, minhash, personal, pieces, quality_classifier, quality_rules, secrets, token_groups, toxicity, whitening


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_quality_rules": lambda s, d: quality_rules.report(table(s, d, "documents")),
    "op2_quality_classifier": lambda s, d: quality_classifier.report(table(s, d, "documents"), table(s, d, "labels")),
    "op3_minhash_near_dedup": lambda s, d: minhash.grouped(table(s, d, "documents")),
    "op4_sentencepiece": lambda s, d: pieces.report(table(s, d, "documents")),
    "op5_personal_data": lambda s, d: personal.report(table(s, d, "documents")),
    "op6_chat_formatting": lambda s, d: chat.report(chat.with_marks(table(s, d, "conversations"))),
    "op7_decontamination": lambda s, d: decontaminate.report(table(s, d, "documents"), table(s, d, "benchmark")),
    "op8_language_model": lambda s, d: language_model.report(table(s, d, "documents")),
    "op9_toxicity": lambda s, d: toxicity.report(table(s, d, "documents"), table(s, d, "labels")),
    "op10_secret_scan": lambda s, d: secrets.report(table(s, d, "documents")),
    "op11_merkle_manifest": lambda s, d: merkle.report(table(s, d, "documents")),
    "op12_embedding_whitening": lambda s, d: whitening.report(table(s, d, "embeddings")),
    "op13_token_group_join": lambda s, d: token_groups.joined(table(s, d, "documents")),
    "pipeline": corpus_pipeline.run,
}
ORACLE: dict[str, str] = {
    "op6_chat_formatting": chat.ORACLE,
    "op11_merkle_manifest": merkle.ORACLE,
}
