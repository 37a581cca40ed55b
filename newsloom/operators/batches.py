"""Batch cap, batch assignment and progress."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.operators.positions import first_n, positions

DEFAULT_CAP = 100
CHUNK = 10


def cap_batch(df: DataFrame, most: int | None = DEFAULT_CAP, key: str = "id") -> DataFrame:
    """The first `most` articles; None lifts the cap."""
    return first_n(df, most, key)


def article_count(df: DataFrame, most: int = DEFAULT_CAP) -> DataFrame:
    """Articles found, and whether they exceed the cap."""
    return df.agg(F.count("*").alias("articles")).withColumn("over_cap", F.col("articles") > most)


def assign_batches(df: DataFrame, key: str = "id", chunk: int = CHUNK) -> DataFrame:
    """`(key, position, batch)`: near-equal runs of about `chunk` rows in key order.

    There are max(1, n div chunk) batches and the first n mod k of them hold
    one row more, so a batch number follows from the position by arithmetic.
    """
    rows = df.count()
    batches = max(1, rows // chunk)
    size, longer = divmod(rows, batches)
    edge = longer * (size + 1)
    place = F.col("position")
    batch = F.when(place < edge, F.floor(place / (size + 1))).otherwise(
        longer + F.floor((place - edge) / max(size, 1))
    )
    return positions(df, key).withColumn("batch", batch.cast("int"))


def batch_progress(assigned: DataFrame) -> DataFrame:
    """Rows per batch and rows done once it ends.

    Batches are runs of positions, so the running total is the last position
    of the batch plus one and needs no window.
    """
    return assigned.groupBy("batch").agg(
        F.count("*").alias("rows"), (F.max("position") + 1).alias("done")
    )
