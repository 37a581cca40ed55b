"""Session factory."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings every job relies on. Cluster sizing (executors, cores, shuffle
# partitions) is left to whoever submits the job.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.legacy.timeParserPolicy": "CORRECTED",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins on the article id build on the side of the scores, which is small per
    # partition: hash it where its measured size allows, rather than sort the text.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def create_spark_session(
    app_name: str = "newsloom",
    master: str | None = None,
    memory: dict[str, str] | None = None,
    extra: dict[str, str] | None = None,
    log_level: str = "ERROR",
) -> SparkSession:
    """Return a session with the settings above.

    `master` and `memory` (sizes for "driver" and "executor") are only set when
    given, so what `spark-submit` says wins.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for side, size in (memory or {}).items():
        builder = builder.config(f"spark.{side}.memory", size)
    for key, value in {**BASE_CONF, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    return spark
