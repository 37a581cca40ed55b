"""Raw records to cleaned articles, and the quality counts taken on the way."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from newsloom.functions.text import clean_text
from newsloom.functions.timestamps import parse_timestamp


def clean_articles(raw: DataFrame, mode: str = "lenient") -> DataFrame:
    """`(id, timestamp, source, category, text, cleaned_text)`, row by row."""
    return raw.select(
        "id",
        parse_timestamp("timestamp", mode).alias("timestamp"),
        "source",
        "category",
        "text",
        clean_text("text").alias("cleaned_text"),
    )


def null_timestamps(cleaned: DataFrame) -> DataFrame:
    """Rows whose timestamp did not parse."""
    return cleaned.filter(F.col("timestamp").isNull())


def quality_counts(cleaned: DataFrame) -> DataFrame:
    """Records, unparsed timestamps and records without an id, in one pass."""
    return cleaned.agg(*_counts())


def observe_quality(cleaned: DataFrame) -> tuple[DataFrame, Observation]:
    """The same counts, taken while `cleaned` is being written."""
    seen = Observation("quality")
    return cleaned.observe(seen, *_counts()), seen


def observe_malformed(checked: DataFrame) -> tuple[DataFrame, Observation]:
    """How many records were malformed, counted while the others are being written."""
    seen = Observation("malformed")
    return checked.observe(seen, F.count_if(F.col("malformed").isNotNull()).alias("malformed")), seen


def preview(cleaned: DataFrame, rows: int = 5) -> DataFrame:
    """The first rows in id order."""
    return cleaned.orderBy("id").limit(rows)


def _counts():
    return [
        F.count(F.lit(1)).alias("records"),
        F.count_if(F.col("timestamp").isNull()).alias("null_timestamps"),
        F.count_if(F.col("id").isNull()).alias("null_ids"),
    ]
