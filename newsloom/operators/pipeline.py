"""The trained classifier as a `pyspark.ml` pipeline, and choosing the best one.

Every stage of a fitted pipeline works on single rows in the JVM, so scoring a
table is one pass over it with no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import IDF, HashingTF, SQLTransformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.staging import new_path

#: Cells that words are hashed to; a parameter of every fit.
HASH_FEATURES = 1 << 18


@dataclass(frozen=True)
class Candidate:
    max_iter: int = 3
    reg_param: float = 0.01


@dataclass(frozen=True)
class Regression:
    """A fitted pipeline with the names of its classes in label order."""

    model: PipelineModel
    categories: list[str]


@dataclass(frozen=True)
class Choice:
    model: PipelineModel
    candidate: Candidate
    accuracies: list[float]


def feature_pipeline(features: int = HASH_FEATURES) -> Pipeline:
    """Cleaned text to weighted hashed counts of all its words.

    Words share cells when there are more of them than `features`; choose it from
    the size of the vocabulary.
    """
    tokens = SQLTransformer(statement="SELECT *, array_remove(split(cleaned_text, ' '), '') AS words FROM __THIS__")
    hashed = HashingTF(inputCol="words", outputCol="word_counts", numFeatures=features)
    weighted = IDF(inputCol="word_counts", outputCol="features")
    return Pipeline(stages=[tokens, hashed, weighted])


def regression(candidate: Candidate) -> LogisticRegression:
    return LogisticRegression(
        featuresCol="features",
        labelCol="label_idx",
        predictionCol="prediction",
        probabilityCol="probability",
        family="multinomial",
        maxIter=candidate.max_iter,
        regParam=candidate.reg_param,
        aggregationDepth=3,
    )


def _trained(candidate: Candidate, vectors: DataFrame) -> LogisticRegressionModel:
    """A fitted regression as read back from the shared folder.

    A model fresh from training carries its training summary, and with it the
    session, into every task that scores with it; a loaded one does not.
    """
    path = new_path(vectors.sparkSession, "regression")
    regression(candidate).fit(vectors).write().save(path)
    return LogisticRegressionModel.load(path)


def _usable(df: DataFrame) -> DataFrame:
    return df.filter(F.col("label_idx").isNotNull() & (F.col("cleaned_text") != ""))


def fit(train: DataFrame, candidate: Candidate = Candidate(), features: int = HASH_FEATURES) -> PipelineModel:
    """Fit features and regression on `(label_idx, cleaned_text)`."""
    rows = _usable(train)
    prepared = feature_pipeline(features).fit(rows)
    classifier = _trained(candidate, prepared.transform(rows).select("label_idx", "features"))
    return PipelineModel(stages=[*prepared.stages, classifier])


def select_best(
    train: DataFrame,
    validation: DataFrame,
    candidates: Sequence[Candidate],
    features: int = HASH_FEATURES,
) -> Choice:
    """Fit every candidate on the same features and keep the most accurate one,
    the earlier among equals."""
    rows = _usable(train)
    prepared = feature_pipeline(features).fit(rows)
    vectors = prepared.transform(rows).select("label_idx", "features").persist(StorageLevel.MEMORY_AND_DISK)
    held_out = (
        prepared.transform(validation.filter("cleaned_text is not null"))
        .select("label_idx", "features")
        .persist(StorageLevel.MEMORY_AND_DISK)
    )
    right = F.coalesce(F.avg((F.col("prediction") == F.col("label_idx")).cast("double")), F.lit(0.0))
    try:
        fitted = [_trained(c, vectors) for c in candidates]
        accuracies = [m.transform(held_out).agg(right.alias("accuracy")).first().accuracy for m in fitted]
    finally:
        vectors.unpersist()
        held_out.unpersist()
    best = max(range(len(candidates)), key=lambda i: (accuracies[i], -i))
    model = PipelineModel(stages=[*prepared.stages, fitted[best]])
    return Choice(model, candidates[best], accuracies)


def predict(articles: DataFrame, model: PipelineModel) -> DataFrame:
    """Add `predicted_label_idx` and `probabilities` to cleaned articles."""
    scored = model.transform(articles.withColumn("cleaned_text", F.coalesce("cleaned_text", F.lit(""))))
    return scored.select(
        *articles.columns,
        F.col("prediction").cast("int").alias("predicted_label_idx"),
        vector_to_array("probability").alias("probabilities"),
    )


def save(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load(path: str) -> PipelineModel:
    return PipelineModel.load(path)
