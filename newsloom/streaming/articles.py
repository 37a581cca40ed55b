"""Streams of arriving articles: cleaning and classification.

Neither keeps state between batches; both run until the files at hand are done,
or on a schedule when a trigger is given.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException
from pyspark.sql.streaming import StreamingQuery

from newsloom.operators.cleaning import clean_articles
from newsloom.operators.scoring import Model, classify, ready
from newsloom.schemas import RAW, RESULTS
from newsloom.sources.files import folder_values

ALL_AT_HAND = {"availableNow": True}


def read_jsonl_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Raw records from JSON Lines files as they arrive."""
    reader = spark.readStream.schema(RAW)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def read_parquet_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Rows of a Parquet table as its files arrive; the table is a folder of files or one file.

    A stream takes folders and patterns, so a single file is named by a pattern that fits it alone.
    """
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.getFileStatus(place).isDirectory():
        return reader.parquet(path)
    return reader.parquet(f"{place.getParent().toString()}/{{{place.getName()}}}")


def clean_stream(
    raw: DataFrame,
    out: str,
    checkpoint: str,
    partition_by: Sequence[str] = ("source", "category"),
    trigger: dict | None = None,
    writers: int = 4,
) -> StreamingQuery:
    """Clean arriving records into partitioned Parquet, each exactly once.

    Before it is written, a batch is spread by folder and `writers` salts, so that
    it adds that many files to a folder at most.
    """
    rows = folder_values(clean_articles(raw), partition_by)
    salt = F.pmod(F.xxhash64(*[c for c in rows.columns if c not in partition_by]), F.lit(writers))
    return (
        rows.repartition(*partition_by, salt)
        .writeStream.format("parquet")
        .partitionBy(*partition_by)
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(**(trigger or ALL_AT_HAND))
        .start()
    )


def classify_stream(
    articles: DataFrame, model: Model, out: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Classify arriving `(id, text)` rows. The model is sent to the workers once, for all batches.

    A batch owns the folder of its number and replaces it, so a batch that is run
    again after a failure leaves no double rows. Read the results with
    `read_results`, which also knows a stream that had no batch.
    """

    served = ready(model)

    def write(batch: DataFrame, number: int) -> None:
        classify(batch, served).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return (
        articles.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ALL_AT_HAND))
        .start()
    )


def read_results(spark: SparkSession, out: str) -> DataFrame:
    """What a classifying stream has written so far; no rows before its first batch."""
    try:
        return spark.read.schema(RESULTS).parquet(out)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], RESULTS)
