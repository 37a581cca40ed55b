"""How far a running stream is, and the quality counts of what it has cleaned.

Spark reports every finished micro-batch with its number and the metrics observed on its
rows. Figures are kept by that number, so a batch that is run again replaces its own
and is never counted twice.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.utils import AnalysisException

from newsloom.operators.cleaning import clean_articles, observe_quality
from newsloom.schemas import CLEANED, QUALITY
from newsloom.sources.files import folder_values
from newsloom.streaming.articles import ALL_AT_HAND

ROWS = "progress"
BATCH_QUALITY = T.StructType([*QUALITY.fields, T.StructField("batch", T.LongType())])


@dataclass(frozen=True)
class Progress:
    """`done` rows of finished batches out of `total`, if that is known."""

    batches: int
    done: int
    total: int | None

    @property
    def share(self) -> float | None:
        return self.done / self.total if self.total else None


def counted(arriving: DataFrame) -> DataFrame:
    """A stream whose rows are counted as they pass; build on it what `watch` is to follow."""
    return arriving.observe(ROWS, F.count(F.lit(1)).alias("rows"))


def watch(
    query: StreamingQuery, report: Callable[[Progress], None], total: int | None = None, pause: float = 0.2
) -> Progress:
    """Call `report` for every batch that a query over a `counted` stream finishes, until it ends; returns the last state.

    A failed query raises its error after the batches that it finished have been reported.
    """
    seen: dict[int, int] = {}
    state = Progress(0, 0, total)

    def look() -> Progress:
        for finished in query.recentProgress:
            metrics = finished.observedMetrics.get(ROWS)
            if metrics and seen.get(finished.batchId) != metrics.rows:
                seen[finished.batchId] = metrics.rows
                report(Progress(len(seen), sum(seen.values()), total))
        return Progress(len(seen), sum(seen.values()), total)

    while query.isActive:
        state = look()
        time.sleep(pause)
    state = look()
    query.awaitTermination()
    return state


def clean_stream_with_counts(
    raw: DataFrame,
    out: str,
    checkpoint: str,
    partition_by: Sequence[str] = ("source", "category"),
    trigger: dict | None = None,
    writers: int = 4,
) -> StreamingQuery:
    """Clean arriving records and keep the quality counts of every batch beside its rows.

    A batch owns the folders of its number, one for rows and one for counts, and replaces both; the counts are
    observed while the rows are written. Read them with `read_rows` and `quality_total`.
    """

    def write(batch: DataFrame, number: int) -> None:
        cleaned, seen = observe_quality(clean_articles(batch))
        rows = folder_values(cleaned, partition_by)
        salt = F.pmod(F.xxhash64(*[c for c in rows.columns if c not in partition_by]), F.lit(writers))
        spread = rows.repartition(*partition_by, salt)
        spread.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{out}/rows/batch={number}")
        counts = batch.sparkSession.createDataFrame([tuple(seen.get[n] for n in QUALITY.fieldNames())], QUALITY)
        counts.coalesce(1).write.mode("overwrite").parquet(f"{out}/counts/batch={number}")

    return (
        raw.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ALL_AT_HAND))
        .start()
    )


def read_rows(spark: SparkSession, out: str) -> DataFrame:
    """The cleaned rows of all batches so far; no rows before the first."""
    try:
        return spark.read.schema(CLEANED).parquet(f"{out}/rows").select(*CLEANED.fieldNames())
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], CLEANED)


def batch_counts(spark: SparkSession, out: str) -> DataFrame:
    """The quality counts of each batch so far; no rows before the first."""
    try:
        return spark.read.schema(BATCH_QUALITY).parquet(f"{out}/counts")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], BATCH_QUALITY)


def quality_total(spark: SparkSession, out: str) -> DataFrame:
    """The same counts over all batches, in one row."""
    sums = [F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in QUALITY.fieldNames()]
    return batch_counts(spark, out).agg(*sums)
