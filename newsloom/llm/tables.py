"""Joins with tables whose size is measured first, and column names that are free."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A table of short rows up to this count is sent to all executors; a larger one is shuffled.
BROADCAST_ROWS = 500_000

BATCH_CONF, DEFAULT_BATCH, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "500"


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """`df`, marked for broadcast if its counted rows allow. Pass a staged table of short rows."""
    return F.broadcast(df) if df.count() <= most else df


def free(names: list[str], columns: list[str]) -> list[str]:
    """`names`, with underscores put before them until no column of `columns` has any of them."""
    taken = {c.lower() for c in columns}
    while any(n.lower() in taken for n in names):
        names = [f"_{n}" for n in names]
    return names


def small_batches(df: DataFrame) -> DataFrame:
    """`df`, whose texts are about to go to Python: hand over few rows at a time.

    Whole texts are long; Spark's usual batch of them takes hundreds of megabytes
    beside the executor's heap. A session that sets the batch itself keeps its value.
    """
    conf = df.sparkSession.conf
    if conf.get(BATCH_CONF, DEFAULT_BATCH) == DEFAULT_BATCH:
        conf.set(BATCH_CONF, BATCH_ROWS)
    return df
