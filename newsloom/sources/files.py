"""File sources and sinks: JSON Lines, Parquet, CSV, plain text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.functions.text import has_ascii_content, strip
from newsloom.operators.positions import number_file_rows
from newsloom.schemas import CLEANED, LABEL_MAP, RAW
from newsloom.sources import quoted_csv

# CSV fields that stand for a missing value.
MISSING = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


class MissingInput(Exception):
    """An input path is absent or holds no data."""


def need(df_of_path, path: str, hint: str) -> DataFrame:
    try:
        return df_of_path(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise MissingInput(f"no data at '{path}'; {hint}") from error
        raise


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object per line, NULL fields written out."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Raw records. A malformed line gives a row of NULLs, a bad field a NULL; `read_jsonl_checked` tells them apart."""
    return need(spark.read.schema(RAW).json, path, "run the ingest job first")


def read_jsonl_checked(spark: SparkSession, path: str) -> DataFrame:
    """Raw records with `file` and `malformed`, the whole line where it is no JSON or a field does not fit, else NULL.

    Blank lines are no records.
    """
    kind = T.StructType([*RAW.fields, T.StructField("malformed", T.StringType())])
    reader = spark.read.schema(kind).option("columnNameOfCorruptRecord", "malformed")
    return need(reader.json, path, "run the ingest job first").select("*", F.col("_metadata.file_path").alias("file"))


def good_records(checked: DataFrame) -> DataFrame:
    return checked.filter("malformed IS NULL").select(*RAW.fieldNames())


def quarantined(checked: DataFrame) -> DataFrame:
    """`(file, id, record)` of malformed lines, with the id where it could be read."""
    return checked.filter("malformed IS NOT NULL").select("file", "id", F.col("malformed").alias("record"))


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> None:
    """Replace `path` by `df`, in folders per value of `partition_by` if given.

    Rows of a folder are brought together before the write so that it holds
    few files; the rebalance splits folders over the advisory size, so a folder
    with a third of all rows is still written by many tasks. An empty string
    would come back as NULL from a folder name and is written as `unknown`.
    """
    if partition_by:
        df = folder_values(df, partition_by).hint("rebalance", *[F.col(c) for c in partition_by])
        df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    else:
        df.write.mode("overwrite").parquet(path)


def save_bucketed(df: DataFrame, table: str, path: str, buckets: int, key: str = "id") -> DataFrame:
    """Keep articles as a table bucketed by id: joins and groups by id do not shuffle it."""
    spread = df.repartition(buckets, key)
    spread.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return df.sparkSession.table(table)


def folder_values(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Replace empty strings in folder columns by `unknown`."""
    for name in partition_by:
        if isinstance(df.schema[name].dataType, T.StringType):
            df = df.withColumn(name, F.when(F.col(name) == "", "unknown").otherwise(F.col(name)))
    return df


def read_cleaned(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned articles in schema order; folder values stay strings."""
    df = need(spark.read.schema(CLEANED).parquet, path, "run the process job first")
    return df.select(*CLEANED.fieldNames())


def read_model_input(spark: SparkSession, path: str) -> DataFrame:
    """The columns a model needs, of labelled rows."""
    return read_cleaned(spark, path).select("id", "cleaned_text", "category").filter("category is not null")


def write_label_map(labels: DataFrame, path: str) -> None:
    labels.coalesce(1).write.mode("overwrite").parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def read_label_map(spark: SparkSession, path: str) -> DataFrame:
    return need(spark.read.schema(LABEL_MAP).parquet, path, "run the train job first")


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header; quotes are doubled, text is kept to the last blank."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def read_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Any CSV table with a header, every column as text, each file read by many tasks.

    Fields may hold line breaks unless `multi_line` is off, which saves a pass over the file.
    """
    if multi_line:
        return _parsed_records(spark, path).select("row.*")
    return need(_csv_reader(spark, False).csv, path, "check the path")


def _csv_reader(spark: SparkSession, multi_line: bool) -> DataFrameReader:
    return spark.read.option("header", True).option("multiLine", multi_line).option("escape", '"')


def _parsed_records(spark: SparkSession, path: str) -> DataFrame:
    """The records of quoted CSV with their places and, as `row`, their fields."""
    kind = need(_csv_reader(spark, True).csv, path, "check the path").schema  # looks at the header only
    rows = quoted_csv.records(spark, path).filter("number > 0")
    fields = F.from_csv("record", kind.toDDL(), {"escape": '"'})
    return rows.withColumn("row", fields).drop("record")


def drop_missing(df: DataFrame, column: str = "text") -> DataFrame:
    """Leave out rows whose field is NULL or a missing-value mark."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(MISSING))


def read_csv_articles(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """`(id, text)` from a CSV table, numbered in file order."""
    table = _parsed_records(spark, path) if multi_line else read_csv(spark, path, False)
    names = table.schema["row"].dataType.fieldNames() if multi_line else table.columns
    if "text" not in names:
        raise ValueError("a CSV of articles must contain a 'text' column")
    if multi_line:
        places = ["file", "start", "ordinal", "number", "whole"]
        return quoted_csv.number_records(drop_missing(table.select(*places, F.col("row.text").alias("text"))))
    return _numbered(drop_missing(table))


def read_txt_articles(spark: SparkSession, path: str) -> DataFrame:
    """`(id, text)`, one article per line, numbered in file order."""
    lines = need(spark.read.text, path, "check the path").withColumnRenamed("value", "text")
    return _numbered(lines.filter(has_ascii_content("text")), strip)


def _numbered(df: DataFrame, change=lambda c: c) -> DataFrame:
    rows = number_file_rows(df)
    return rows.select("id", change(F.col("text")).alias("text"))


def results_table(results: DataFrame) -> DataFrame:
    """Scoring results with the probability map as JSON text, as CSV has no maps."""
    as_text: Column = F.to_json("raw_probabilities")
    return results.withColumn("raw_probabilities", as_text)
