"""Table schemas shared by sources, jobs and streams."""

from __future__ import annotations

from pyspark.sql import types as T

RAW = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("category", T.StringType()),
    ]
)

CLEANED = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("source", T.StringType()),
        T.StructField("category", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("cleaned_text", T.StringType()),
    ]
)

QUALITY = T.StructType(
    [
        T.StructField("records", T.LongType()),
        T.StructField("null_timestamps", T.LongType()),
        T.StructField("null_ids", T.LongType()),
    ]
)

LABEL_MAP = T.StructType(
    [
        T.StructField("category", T.StringType()),
        T.StructField("label_idx", T.IntegerType()),
    ]
)

RESULTS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("predicted_category", T.StringType()),
        T.StructField("confidence", T.DoubleType()),
        T.StructField("raw_probabilities", T.MapType(T.StringType(), T.DoubleType())),
    ]
)

PREDICTIONS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("true_label_idx", T.IntegerType()),
        T.StructField("predicted_label_idx", T.IntegerType()),
        T.StructField("true_category", T.StringType()),
        T.StructField("predicted_category", T.StringType()),
    ]
)
