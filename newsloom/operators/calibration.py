"""Confidences that tell how often a prediction is right.

Word models multiply the evidence of every word as if words were independent, so their
probabilities lie close to 0 or 1. Dividing the logarithms by one temperature before
they become probabilities keeps every prediction and its rank; the temperature is the
one under which the true classes of held-out rows are likeliest. One aggregation over the
scores gives the loss of all temperatures to choose from.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.scores import with_value

#: Temperatures that a fit chooses from: powers of the square root of two.
TEMPERATURES = [2.0 ** (k / 2) for k in range(-4, 25)]
BINS = 10


def log_loss(logs: Column, label: Column, temperature: Column) -> Column:
    """The negative logarithm of a class's probability; NULL where the class has no score.

    `logs` are logarithms of likelihoods up to a common constant.
    """

    def loss(away: Column) -> Column:
        total = F.aggregate(away, F.lit(0.0), lambda acc, a: acc + F.coalesce(F.exp(a / temperature), F.lit(0.0)))
        return F.ln(total) - F.try_element_at(away, label + 1) / temperature

    return with_value(with_value(F.array_max(logs), lambda top: F.transform(logs, lambda v: v - top)), loss)


def temperature_losses(rows: DataFrame, logs: str = "logs", label: str = "label_idx") -> DataFrame:
    """`(temperature, rows, loss)`: the mean loss of held-out rows under every temperature.

    Rows whose class has no score, which no temperature changes, are left out.
    """
    choices = F.explode(F.array(*[F.lit(t) for t in TEMPERATURES])).alias("temperature")
    spread = rows.filter(F.col(label).isNotNull()).select(logs, label, choices)
    losses = spread.select("temperature", log_loss(F.col(logs), F.col(label), F.col("temperature")).alias("loss"))
    return losses.groupBy("temperature").agg(F.count("loss").alias("rows"), F.avg("loss").alias("loss"))


def best_temperature(losses: DataFrame) -> float:
    """The temperature of the least loss, the lowest among equals; 1 without rows."""
    best = losses.filter("rows > 0").orderBy(F.round("loss", 9), "temperature").first()
    return best.temperature if best else 1.0


def reliability(predictions: DataFrame, confidence: str = "confidence", right: str = "is_right", bins: int = BINS) -> DataFrame:
    """`(bin, rows, confidence, accuracy)`: predictions by confidence, in bins of equal width, with both means."""
    place = F.least(F.floor(F.round(F.col(confidence), 9) * bins), F.lit(bins - 1)).cast("int")
    return predictions.groupBy(place.alias("bin")).agg(
        F.count("*").alias("rows"),
        F.avg(confidence).alias("confidence"),
        F.avg(F.col(right).cast("double")).alias("accuracy"),
    )


def calibration_error(bins: DataFrame) -> DataFrame:
    """`(rows, error)`: how far confidence and accuracy are apart in a bin, averaged over rows; 0 without rows."""
    gap = F.abs(F.col("accuracy") - F.col("confidence")) * F.col("rows")
    error = F.coalesce(F.try_divide(F.sum(gap), F.sum("rows")), F.lit(0.0))
    return bins.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), error.alias("error"))
