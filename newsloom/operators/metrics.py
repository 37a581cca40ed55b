"""Evaluation: accuracy, confusion matrix, per-class report, errors.

Inputs are predictions `(true_label_idx, predicted_label_idx)` and a label map
whose indices run from 0. Only counts per (true, predicted) pair are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.text import excerpt
from newsloom.operators.labels import decode
from newsloom.staging import stage

TRUE, PREDICTED = "true_label_idx", "predicted_label_idx"


def accuracy(predictions: DataFrame) -> DataFrame:
    """Share of right predictions; 0 for no rows."""
    right = F.count_if(F.col(TRUE) == F.col(PREDICTED))
    return predictions.agg(
        F.count("*").alias("rows"), right.alias("correct"), _ratio(right, F.count("*")).alias("accuracy")
    )


def misclassified(predictions: DataFrame) -> DataFrame:
    """Rows whose prediction is wrong; a truth outside the label map always is."""
    return predictions.filter(~F.col(TRUE).eqNullSafe(F.col(PREDICTED)))


def error_count(predictions: DataFrame) -> DataFrame:
    return predictions.agg(F.count_if(~F.col(TRUE).eqNullSafe(F.col(PREDICTED))).alias("errors"))


def pair_counts(predictions: DataFrame) -> DataFrame:
    """Written counts per (true, predicted) pair.

    Reports join them with the label map in several places; were they not written, each place would
    score all rows again, and a filter derived from a join would do so once more.
    """
    return stage(predictions.groupBy(TRUE, PREDICTED).agg(F.count("*").alias("n")), "pair-counts")


def confusion_matrix(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per (true, predicted) pair of the label map, zero-filled."""
    size = labels.count()
    every = F.sequence(F.lit(0), F.lit(size - 1)) if size else F.array().cast("array<int>")
    grid = labels.select(F.col("label_idx").alias(TRUE), F.explode(every).alias(PREDICTED))
    return grid.join(pair_counts(predictions), [TRUE, PREDICTED], "left").fillna(0, ["n"])


def confusion_wide(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per true label and a column `predicted_<idx>` per predicted label."""
    size = labels.count()
    counts = (
        pair_counts(predictions).groupBy(TRUE).pivot(PREDICTED, list(range(size))).agg(F.sum("n"))
    )
    rows = labels.select(F.col("label_idx").alias(TRUE)).join(counts, TRUE, "left").fillna(0)
    return rows.select(TRUE, *[F.col(str(i)).alias(f"predicted_{i}") for i in range(size)])


def class_counts(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """Support, predictions and hits per label of the map, zero-filled."""
    pairs = pair_counts(predictions)
    hit = F.when(F.col(TRUE) == F.col(PREDICTED), F.col("n")).otherwise(0)
    by_true = pairs.groupBy(F.col(TRUE).alias("label_idx")).agg(
        F.sum("n").alias("support"), F.sum(hit).alias("hits")
    )
    by_predicted = pairs.groupBy(F.col(PREDICTED).alias("label_idx")).agg(F.sum("n").alias("claimed"))
    return (
        labels.select("label_idx", "category")
        .join(by_true, "label_idx", "left")
        .join(by_predicted, "label_idx", "left")
        .fillna(0, ["support", "hits", "claimed"])
        .withColumn("precision", _ratio(F.col("hits"), F.col("claimed")))
        .withColumn("recall", _ratio(F.col("hits"), F.col("support")))
        .withColumn("f1", _ratio(F.col("hits") * 2, F.col("support") + F.col("claimed")))
    )


def class_report(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per label; 0 where undefined."""
    return class_counts(predictions, labels).select(
        "label_idx", "category", "precision", "recall", "f1", "support"
    )


def report_averages(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """The accuracy, macro and weighted rows of the report."""
    names = ("precision", "recall", "f1")
    support = F.sum("support")
    right = _ratio(F.sum("hits"), support)
    kinds = {
        "accuracy": [right for _ in names],
        "macro avg": [F.coalesce(F.avg(n), F.lit(0.0)) for n in names],
        "weighted avg": [_ratio(F.sum(F.col(n) * F.col("support")), support) for n in names],
    }
    rows = [
        F.struct(
            F.lit(kind).alias("average"),
            *[value.alias(n) for n, value in zip(names, values)],
            support.alias("support"),
        )
        for kind, values in kinds.items()
    ]
    return class_counts(predictions, labels).agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def error_sample(predictions: DataFrame, labels: DataFrame, k: int = 5, id_col: str = "id") -> DataFrame:
    """The first `k` errors in id order, numbered, with excerpt and names.

    The window without a key sees the `k` rows of the limit only.
    """
    first = misclassified(predictions).orderBy(id_col).limit(k)
    numbered = first.withColumn("example", F.row_number().over(Window.orderBy(id_col)))
    named = decode(decode(numbered, labels, TRUE, "true_category"), labels, PREDICTED, "predicted_category")
    return named.select("example", id_col, excerpt("text").alias("excerpt"), "true_category", "predicted_category")


def category_distribution(results: DataFrame, threshold: float = 0.75) -> DataFrame:
    """Articles per predicted category from the threshold up, most frequent first."""
    return (
        results.filter(F.col("confidence") >= F.lit(threshold))
        .groupBy("predicted_category")
        .agg(F.count("*").alias("count"))
        .orderBy(F.col("count").desc(), "predicted_category")
    )


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))
