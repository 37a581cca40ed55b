"""Tables written once to the shared checkpoint folder and read back.

Writing an intermediate result cuts its lineage, survives the loss of
executors, and gives the planner the table's true size: Spark then broadcasts
it only when it lies under `spark.sql.autoBroadcastJoinThreshold` and shuffles
otherwise, so no join in this package needs a broadcast hint on trust.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession

_local_dirs: dict[str, str] = {}
_scopes: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder named by `spark.checkpoint.dir`.

    Only a local session may go without it; it then gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="newsloom-")
    return _local_dirs[context.applicationId]


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used yet."""
    path = f"{shared_dir(spark)}/newsloom/{name}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Remove at the end what was staged inside; results must have been written elsewhere by then."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once and return the table read back."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded_rows(df: DataFrame, limit: int) -> list[Row]:
    """Collect a table that must be small; refuse it when it is not."""
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise ValueError(f"expected at most {limit} rows")
    return rows
