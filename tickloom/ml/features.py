"""Feature preparation: scaling, assembling, weights, oversampling, scoring inputs."""

from __future__ import annotations

import math
import statistics
from dataclasses import dataclass
from functools import reduce

from pyspark.ml.feature import VectorAssembler, VectorSizeHint
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import fixed_values as fv
from tickloom.functions.numbers import fill_clip
from tickloom.operators.joins import checked_broadcast


@dataclass(frozen=True)
class Scaler:
    """Column means and population deviations of the train split."""

    mean: dict[str, float]
    std: dict[str, float]

    def transform(self, df: DataFrame, suffix: str = "_scaled") -> DataFrame:
        return df.withColumns({f"{c}{suffix}": self._scaled(c) for c in self.mean})

    def _scaled(self, column: str) -> Column:
        # A constant column has deviation 0 and becomes 0.
        centred = fill_clip(F.col(column), fv.FEATURE_CLIP) - F.lit(self.mean[column])
        return centred / F.lit(self.std[column] or 1.0)


def fit_scaler(train: DataFrame, columns: list[str]) -> Scaler:
    """ML-01: one aggregate over the train split; only its single row reaches the driver."""
    value = {c: fill_clip(F.col(c), fv.FEATURE_CLIP) for c in columns}
    row = train.agg(
        *[F.avg(v).alias(f"m_{c}") for c, v in value.items()],
        *[F.stddev_pop(v).alias(f"s_{c}") for c, v in value.items()],
    ).first()
    return Scaler({c: row[f"m_{c}"] or 0.0 for c in columns}, {c: row[f"s_{c}"] or 0.0 for c in columns})


def assemble(df: DataFrame, embedding: str, columns: list[str], output: str = "features", size: int | None = None) -> DataFrame:
    """ML-02: embedding, an array or a vector, and tabular columns as one vector.

    With ``size``, the length of all embeddings, no row is computed to learn it.
    """
    value = F.col(embedding)
    if not isinstance(df.schema[embedding].dataType, VectorUDT):
        value = array_to_vector(value.cast("array<double>"))
    with_vector = df.withColumn("_embedding", value)
    if size is not None:
        with_vector = VectorSizeHint(inputCol="_embedding", size=size, handleInvalid="error").transform(with_vector)
    assembler = VectorAssembler(inputCols=["_embedding", *columns], outputCol=output)
    return assembler.transform(with_vector).drop("_embedding")


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """ML-03: n / (classes * count) per class; the windows see one row per class."""
    everything = Window.partitionBy()
    total, classes = F.sum("n").over(everything), F.count("*").over(everything)
    weight = total.cast("double") / (classes * F.col("n"))
    return class_counts(df, label).select(label, "n", weight.alias("weight"))


def with_class_weights(df: DataFrame, label: str) -> DataFrame:
    """ML-03: every row beside the weight of its class; the classes are counted once."""
    weights = class_weights(df, label).select(F.col(label).alias("_label"), "weight")
    weights = checked_broadcast(weights)
    return df.join(weights, df[label].eqNullSafe(weights["_label"])).drop("_label")


MOST_CLASSES = 10_000
LISTED = 200  # classes that a filter names; more are joined
CELL_ROWS = 1000  # rows of a class that the last histogram cell may be expected to hold


def oversample(df: DataFrame, label: str, key: str = "key", seed: int = 42) -> DataFrame:
    """ML-04: raise each class to the median class count by repeating its rows.

    Every row is repeated target // n times and the remainder goes to the rows
    with the smallest hash, so class sizes are exact and the choice repeatable.
    Up to which hash that is, is found by histograms (:func:`smallest_hashes`): no
    class is sorted or numbered.  Rows that share a key are told apart only where
    the limit falls among them.
    """
    counts = {r[label]: r["n"] for r in class_counts(df, label).collect()}
    if not counts:
        return df.withColumn("copy", F.lit(1).cast("bigint"))
    median = math.floor(statistics.median(counts.values()))
    grow = {k: n for k, n in counts.items() if n < median}
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    hashed = df.withColumn("_hash", F.md5(F.concat(text, F.lit(f"#{seed}"))))
    limits = smallest_hashes(hashed, label, key, {k: (n, median % n) for k, n in grow.items()})
    kinds = T.StructType([T.StructField("_l", df.schema[label].dataType), T.StructField("_times", T.LongType()),
                          T.StructField("_limit", T.StringType()), T.StructField("_limit_key", df.schema[key].dataType),
                          T.StructField("_ties", T.LongType()), T.StructField("_shared", T.BooleanType())])
    table = df.sparkSession.createDataFrame(
        [(k, median // grow[k] if k in grow else 1, *limits.get(k, (None, None, None, False))) for k in counts], kinds)
    # A literal table of one row a class: its size is known to Spark.
    rows = hashed.join(F.broadcast(table) if len(counts) <= MOST_CLASSES else table, F.col(label).eqNullSafe(F.col("_l")))
    at = (F.col("_hash") == F.col("_limit")) & F.col(key).eqNullSafe(F.col("_limit_key"))
    below = (F.col("_hash") < F.col("_limit")) | ((F.col("_hash") == F.col("_limit")) & (F.col(key) < F.col("_limit_key")))
    extra = F.when(below | at, 1).otherwise(0)
    if any(shared for *_, shared in limits.values()):
        tie = Window.partitionBy(label, "_split").orderBy(F.lit(1))
        rows = rows.withColumn("_split", at & F.col("_shared"))
        apart = rows.filter(F.coalesce("_split", F.lit(False))).withColumn("_extra", F.when(F.row_number().over(tie) <= F.col("_ties"), 1).otherwise(0))
        rows = rows.filter(~F.coalesce("_split", F.lit(False))).withColumn("_extra", extra).unionByName(apart)
    else:
        rows = rows.withColumn("_extra", extra)
    rows = rows.withColumn("_copies", F.col("_times") + F.col("_extra"))
    once = rows.filter("_copies = 1").select(*df.columns, F.lit(1).cast("bigint").alias("copy"))
    return once.unionByName(_repeat(rows.filter("_copies > 1"), key, "_copies").select(*df.columns, "copy"))


def smallest_hashes(hashed: DataFrame, label: str, key: str, wanted: dict) -> dict:
    """For each class of wanted, label -> (n, r): the hash and key of its r-th row
    by (_hash, key), how many rows with this key are among the r, and whether not all are.

    Two rounds of histograms over digits of the hash, as many digits as the
    largest class needs, narrow every class down to one cell; the keys of these
    cells alone are looked at.  A class that fits a cell from the start has no
    rounds.  Three jobs at most, whatever the number of classes.
    """
    wanted = {k: (n, r) for k, (n, r) in wanted.items() if r}
    if not wanted:
        return {}
    largest = max(n for n, _ in wanted.values())
    rounds = 0 if largest <= CELL_ROWS else 1 if largest <= CELL_ROWS * 16**3 else 2
    digits = 3 if rounds < 2 else max(3, math.ceil(math.log(largest / CELL_ROWS, 16) / 2))
    prefix, left = dict.fromkeys(wanted, ""), {k: r for k, (_, r) in wanted.items()}
    kinds = T.StructType([T.StructField("_l", hashed.schema[label].dataType), T.StructField("_prefix", T.StringType())])

    def inside() -> DataFrame:
        if len(prefix) <= LISTED:  # a filter, and no join
            here = reduce(lambda a, b: a | b, [F.col(label).eqNullSafe(F.lit(k)) & F.startswith("_hash", F.lit(p)) for k, p in prefix.items()])
            return hashed.select(F.col(label).alias("_l"), key, "_hash").filter(here)
        cells = hashed.sparkSession.createDataFrame(list(prefix.items()), kinds)
        return hashed.select(label, key, "_hash").join(cells, F.col(label).eqNullSafe(F.col("_l"))).filter(F.startswith("_hash", "_prefix"))

    for step in range(rounds):
        cell = F.substring("_hash", 1 + step * digits, digits).alias("cell")
        for r in sorted(inside().groupBy("_l", cell).agg(F.count("*").alias("n")).collect(), key=lambda r: r["cell"]):
            if len(prefix[r["_l"]]) == step * digits:  # not found yet
                if r["n"] >= left[r["_l"]]:
                    prefix[r["_l"]] += r["cell"]
                else:
                    left[r["_l"]] -= r["n"]
    found = {}
    last = inside().groupBy("_l", "_hash", key).agg(F.count("*").alias("n")).collect()
    for r in sorted(last, key=lambda r: (r["_hash"], r[key] is not None, r[key])):
        if r["_l"] not in found:
            if r["n"] >= left[r["_l"]]:
                found[r["_l"]] = r["_hash"], r[key], left[r["_l"]], r["n"] > left[r["_l"]]
            else:
                left[r["_l"]] -= r["n"]
    return found


def _repeat(df: DataFrame, key: str, copies: str, step: int = 10_000) -> DataFrame:
    """Each row ``copies`` times, numbered from 1.

    In two steps with a shuffle between: no array is long, and no task writes
    all copies of a rare row.
    """
    one = F.lit(1).cast("bigint")
    starts = df.withColumn("_from", F.explode(F.sequence(one, F.col(copies), F.lit(step).cast("bigint"))))
    last = F.least(F.col("_from") + (step - 1), F.col(copies))
    return starts.repartition(key, "_from").withColumn("copy", F.explode(F.sequence("_from", last)))


def request_features(df: DataFrame, names: list[str], embedding_dim: int) -> DataFrame:
    """ML-16: scoring inputs by name; an absent or empty feature is 0, the embedding all zeros."""
    known = set(df.columns)
    columns = [
        (F.coalesce(F.col(n).cast("double"), F.lit(0.0)) if n in known else F.lit(0.0)).alias(n)
        for n in names
    ]
    rest = [c for c in df.columns if c not in names]
    return df.select(*rest, *columns, F.array_repeat(F.lit(0.0), embedding_dim).alias("embedding"))
