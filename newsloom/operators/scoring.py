"""Scores to predictions and to results with category, confidence, probabilities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.scores import argmax, confidence, name_of, probability_map, softmax, with_value
from newsloom.functions.text import clean_text, is_blank, is_long_enough
from newsloom.operators import epochs, naive_bayes, pipeline
from newsloom.operators.epochs import EpochModel
from newsloom.operators.naive_bayes import UNIT, BayesModel, ReadyBayes
from newsloom.operators.pipeline import Regression

INVALID = "Invalid/Empty"
NO_PROBABILITIES = "map<string,double>"

Model = BayesModel | ReadyBayes | Regression | EpochModel


def scored(articles: DataFrame, model: Model) -> DataFrame:
    """Cleaned articles with `predicted_label_idx` and `probabilities`, row by row.

    No id is needed: each row is scored where it stands.
    """
    if isinstance(model, Regression):
        return pipeline.predict(articles, model.model)
    if isinstance(model, EpochModel):
        return epochs.predict(articles, model)
    rows = naive_bayes.score(articles, model)
    columns = [c for c in rows.columns if c != "scores"]
    return rows.select(
        *columns,
        argmax(F.col("scores")).alias("predicted_label_idx"),
        probabilities(F.col("scores"), model.temperature).alias("probabilities"),
    )


def ready(model: Model) -> Model:
    """The model with what workers need sent to them once, for scoring batch after batch."""
    return naive_bayes.prepare(model) if isinstance(model, BayesModel) else model


def predict(articles: DataFrame, model: Model) -> DataFrame:
    """Cleaned articles with `predicted_label_idx`."""
    return scored(articles, model).drop("probabilities")


def probabilities(scores: Column, temperature: float = 1.0) -> Column:
    """Summed integer scores as probabilities."""
    unit = F.lit(float(UNIT) * temperature)
    logs = with_value(F.array_max(scores), lambda top: F.transform(scores, lambda s: (s - top) / unit))
    return softmax(logs)


def evaluate_rows(validation: DataFrame, model: Model) -> DataFrame:
    """Predictions beside the truth, with the columns of the prediction table.

    `validation` holds id, cleaned_text and label_idx; ids may be NULL or repeated.
    """
    names = model.categories
    return predict(validation.select("id", "cleaned_text", "label_idx"), model).select(
        "id",
        F.col("cleaned_text").alias("text"),
        F.col("label_idx").alias("true_label_idx"),
        "predicted_label_idx",
        name_of(F.col("label_idx"), names).alias("true_category"),
        name_of(F.col("predicted_label_idx"), names).alias("predicted_category"),
    )


def classify(articles: DataFrame, model: Model, missing: str = "Unknown") -> DataFrame:
    """Results for raw `(id, text)` rows.

    Blank text keeps its row as `Invalid/Empty` with confidence 0 and an empty
    map. Any other text is cleaned as in training, then scored.
    """
    cleaned = articles.select("id", "text", clean_text("text").alias("cleaned_text"))
    return as_results(scored(cleaned, model), F.col("probabilities"), model.categories, missing)


def classify_texts(
    spark: SparkSession, texts: Sequence[str | None], model: Model, least: int = 0
) -> DataFrame:
    """Results for texts typed in by hand, in the order given.

    Texts of fewer than `least` characters are refused and give no row.
    """
    return classify_numbered(spark.createDataFrame(list(enumerate(texts)), "id long, text string"), model, least)


def classify_numbered(texts: DataFrame, model: Model, least: int = 0) -> DataFrame:
    """The same for a table of `(id, text)`, in id order."""
    rows = texts.filter(is_long_enough("text", least)) if least else texts
    return classify(rows, model, "Unknown Category").orderBy("id")


def as_results(df: DataFrame, probs: Column, names: Sequence[str], missing: str = "Unknown") -> DataFrame:
    """`(id, text, predicted_category, confidence, raw_probabilities)`."""
    blank = is_blank("text")
    return df.select(
        "id",
        "text",
        F.when(blank, INVALID).otherwise(name_of(argmax(probs), names, missing)).alias("predicted_category"),
        F.when(blank, 0.0).otherwise(confidence(probs)).alias("confidence"),
        F.when(blank, F.create_map().cast(NO_PROBABILITIES))
        .otherwise(probability_map(probs, names))
        .alias("raw_probabilities"),
    )


def above_threshold(results: DataFrame, threshold: float = 0.75) -> DataFrame:
    """Results at or over a confidence."""
    return results.filter(F.col("confidence") >= F.lit(threshold))


def probability_rows(results: DataFrame) -> DataFrame:
    """A row per article and category, least probable first within an article."""
    rows = results.select("id", F.explode("raw_probabilities").alias("category", "probability"))
    return rows.orderBy("id", "probability", "category")
