"""The physical plan of a DataFrame, for tests that look into it."""

from __future__ import annotations

from pyspark.sql import DataFrame


def plan(df: DataFrame) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
