"""Training and scoring with MLlib."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions import fixed_values as fv
from tickloom.functions.labels import decode_label, encode_label
from tickloom.functions.numbers import fill_clip
from tickloom.ml.features import Scaler, assemble, fit_scaler, oversample, request_features, with_class_weights
from tickloom.sources.tables import written_once


@dataclass(frozen=True)
class Classifier:
    """A fitted model with its class order and feature column."""

    model: LogisticRegressionModel
    classes: list[str]
    features: str

    def score(self, df: DataFrame, label: str, confidence: str) -> DataFrame:
        """ML-06: predicted class and its probability rounded to four digits."""
        scored = self.model.transform(df)
        return scored.withColumns({
            label: decode_label(F.col("prediction").cast("int"), self.classes),
            confidence: F.round(F.array_max(vector_to_array("probability")), 4),
        }).drop("rawPrediction", "probability", "prediction")


@dataclass(frozen=True)
class LinearClassifier:
    """A fitted model as plain numbers: scoring is a column expression."""

    coefficients: list[list[float]]
    intercepts: list[float]
    classes: list[str]

    @staticmethod
    def of(classifier: Classifier) -> "LinearClassifier":
        model = classifier.model
        return LinearClassifier(
            [[float(x) for x in row] for row in model.coefficientMatrix.toArray()],
            [float(x) for x in model.interceptVector], list(classifier.classes))

    def probabilities(self, features: Column) -> Column:
        """Softmax of the linear scores of an array of numbers, one per class."""
        product = lambda row: F.aggregate(
            F.zip_with(features, F.array(*[F.lit(x) for x in row]), lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
        scores = F.array(*[product(row) + F.lit(b) for row, b in zip(self.coefficients, self.intercepts)])
        powers = F.transform(scores, lambda x: F.exp(x - F.array_max(scores)))
        return F.transform(powers, lambda x: x / F.aggregate(powers, F.lit(0.0), lambda s, y: s + y))

    def score(self, df: DataFrame, features: str, label: str, confidence: str) -> DataFrame:
        """ML-06: predicted class, the first one on a tie, and its probability rounded to four digits."""
        scored = df.withColumn("_p", self.probabilities(F.col(features)))
        best = F.array_position("_p", F.array_max("_p")).cast("int") - 1
        return scored.withColumns({
            label: decode_label(best, self.classes), confidence: F.round(F.array_max("_p"), 4)}).drop("_p")


def class_totals(df: DataFrame, label: str, weight: str | None = None) -> dict[str, float]:
    """Rows, or the sum of weights, of each class, in alphabetical order: a short list, one value per class."""
    total = F.sum(weight) if weight else F.count("*")
    rows = df.filter(F.col(label).isNotNull()).groupBy(label).agg(total.alias("_total")).orderBy(label).collect()
    return {r[label]: float(r["_total"] or 0) for r in rows}


def label_classes(df: DataFrame, label: str) -> list[str]:
    """Classes in alphabetical order."""
    return list(class_totals(df, label))


def fit_lr(df: DataFrame, label: str, C: float = 1.0, weight: str | None = None,
           features: str = "features", max_iter: int = 1000, classes: list[str] | None = None) -> Classifier:
    """ML-05: multinomial logistic regression with an L2 penalty.

    ``C`` multiplies a sum of losses and MLlib averages them, hence
    ``regParam = 1 / (C * sum of weights)``.  Classes and sum come from one pass
    over label and weight; the fit takes its own.
    """
    totals = class_totals(df, label, weight)
    classes = classes or list(totals)
    rows = df.withColumn("_y", encode_label(F.col(label), classes).cast("double")).filter("_y IS NOT NULL")
    total = math.fsum(totals.get(k, 0.0) for k in classes)
    estimator = LogisticRegression(
        featuresCol=features, labelCol="_y", family="multinomial", maxIter=max_iter, tol=1e-4,
        regParam=1.0 / (C * total), elasticNetParam=0.0, standardization=False,
    )
    if weight:
        estimator = estimator.setWeightCol(weight)
    return Classifier(estimator.fit(rows), classes, features)


def prepare(mart: DataFrame, embeddings: DataFrame, features: list[str],
            scaler: Scaler | None = None) -> tuple[DataFrame, Scaler]:
    """Scaled, assembled vectors; rows and embeddings meet on the key, not on row order.

    A ticket without an embedding keeps its place with a vector of zeros.
    Embeddings are arrays, or vectors, which stay sparse.
    """
    some = embeddings.filter(F.col("embedding").isNotNull()).select("embedding").first()
    if some is None:
        raise ValueError("there are no embeddings")
    size = len(some[0])
    if scaler is None:
        scaler = fit_scaler(mart.filter("split = 'train'"), features)
    filled = mart.withColumns({c: fill_clip(F.col(c), fv.FEATURE_CLIP) for c in features})
    joined = scaler.transform(filled).join(embeddings.select("key", "embedding"), "key", "left")
    if isinstance(embeddings.schema["embedding"].dataType, VectorUDT):
        joined = joined.withColumn("embedding", F.coalesce("embedding", array_to_vector(F.array_repeat(F.lit(0.0), size))))
    else:
        joined = joined.withColumn(
            "embedding", F.coalesce(F.col("embedding").cast("array<double>"), F.array_repeat(F.lit(0.0), size)))
    return assemble(joined, "embedding", [f"{c}_scaled" for c in features], size=size), scaler


def train_and_predict(mart: DataFrame, type_embeddings: DataFrame, resolution_embeddings: DataFrame,
                      features: list[str] = fv.TABULAR_FEATURES_17, C: float = 1.0,
                      max_iter: int = 1000, method: str = "LR_BALANCED", oversampled: bool = True) -> DataFrame:
    """The whole training run: predictions of both labels for the validation split.

    The type model learns from oversampled classes, or like the resolution
    model from class weights.  Two of the features are known only once a ticket
    is closed; ``fv.TABULAR_FEATURES_SAFE`` is the list without them.
    """
    def ready(df: DataFrame, label: str) -> DataFrame:
        """Vectors of both splits, joined, assembled and written once: class counts,
        hashes and weights read narrow columns of them."""
        return written_once(df.filter("split IN ('train', 'validation')").select("key", "split", "issuetype", "resolution", "features"), f"train-{label}")

    by_type, scaler = prepare(mart, type_embeddings, features)
    by_type = ready(by_type, "issuetype")
    by_resolution = ready(prepare(mart, resolution_embeddings, features, scaler)[0], "resolution")
    slim = lambda df, label: df.filter("split = 'train'").select("key", label, "features")

    if oversampled:
        type_model = fit_lr(oversample(slim(by_type, "issuetype"), "issuetype"), "issuetype", C, max_iter=max_iter)
    else:
        type_rows = with_class_weights(slim(by_type, "issuetype"), "issuetype")
        type_model = fit_lr(type_rows, "issuetype", C, weight="weight", max_iter=max_iter)
    resolution_rows = with_class_weights(slim(by_resolution, "resolution"), "resolution")
    resolution_model = fit_lr(resolution_rows, "resolution", C, weight="weight", max_iter=max_iter)

    validation = lambda df: df.filter("split = 'validation'")
    types = type_model.score(validation(by_type), "pred_issuetype", "conf_issuetype")
    resolutions = resolution_model.score(validation(by_resolution), "pred_resolution", "conf_resolution")
    return types.join(resolutions.select("key", "pred_resolution", "conf_resolution"), "key").select(
        "key",
        F.col("issuetype").alias("true_issuetype"),
        F.col("resolution").alias("true_resolution"),
        "pred_issuetype", "pred_resolution", "conf_issuetype", "conf_resolution",
        F.lit(method).alias("method"),
        F.lit("").alias("fix_summary"),
    )


def train_weighted(mart: DataFrame, type_embeddings: DataFrame, resolution_embeddings: DataFrame,
                   features: list[str] = fv.TABULAR_FEATURES_19, C: float = 3.0, max_iter: int = 1000) -> DataFrame:
    """The second training run: more features, a weaker penalty, class weights for both labels."""
    return train_and_predict(mart, type_embeddings, resolution_embeddings, features, C, max_iter,
                             method="LR_WEIGHTED", oversampled=False)


def score_requests(requests: DataFrame, scaler: Scaler, names: list[str], dim: int,
                   type_model: LinearClassifier, resolution_model: LinearClassifier) -> DataFrame:
    """ML-16: both labels for new tickets.  Absent features are 0 before they
    are scaled, and the embedding is a vector of zeros in front of them."""
    inputs = scaler.transform(request_features(requests, names, dim))
    vector = F.concat("embedding", F.array(*[F.col(f"{n}_scaled") for n in names]))
    ready = inputs.withColumn("features", vector)
    typed = type_model.score(ready, "features", "pred_issuetype", "conf_issuetype")
    return resolution_model.score(typed, "features", "pred_resolution", "conf_resolution").select(
        "key", "pred_issuetype", "conf_issuetype", "pred_resolution", "conf_resolution")
