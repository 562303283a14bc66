"""Parent keys: nested payloads, clean flags, resumable appends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.joins import clip_flag, keep_new


def parse_parent(payload: Column) -> Column:
    """Parent key inside a nested ticket payload, NULL when there is none."""
    return F.get_json_object(payload, "$.fields.parent.key")


def parents_from_payloads(df: DataFrame, payload: str = "payload") -> DataFrame:
    """JSN-01: one row per fetched ticket.  A missing payload is a failed lookup (-1)."""
    parent = parse_parent(F.col(payload))
    flag = F.when(F.col(payload).isNull(), -1).otherwise(parent.isNotNull().cast("int"))
    return df.select("key", parent.alias("parent_key"), flag.alias("has_parent"))


def load_parent_keys(df: DataFrame) -> DataFrame:
    """SRC-07: flags as 0 or 1; empty and failed lookups count as 0."""
    return df.select("key", "parent_key", clip_flag(F.col("has_parent")).alias("has_parent"))


def append_new(existing: DataFrame, batch: DataFrame, key: str = "key") -> DataFrame:
    """SET-02: add rows of a batch whose key is not there yet, one per key."""
    fresh = keep_new(batch.dropDuplicates([key]), existing, key)
    return existing.unionByName(fresh.select(*existing.columns))
