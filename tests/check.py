"""Runs queries on Spark and their SQL on DuckDB and compares the rows."""

from __future__ import annotations

import datetime
import decimal
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def plain(value):
    if isinstance(value, decimal.Decimal):
        return value.normalize()
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, float):
        return round(value, 6)
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def differences(spark, folder: str, run, statement: str) -> str | None:
    """None when both engines give the same columns and rows."""
    found = run(spark, folder)
    wanted = oracle(folder).execute(statement)
    names = [d[0] for d in wanted.description]
    if sorted(names) != sorted(found.columns):
        return f"columns {sorted(found.columns)} != {sorted(names)}"
    have, want = rows_of(found.columns, found.collect()), rows_of(names, wanted.fetchall())
    if have == want:
        return None
    return (
        f"{sum(have.values())} rows != {sum(want.values())}; only Spark {list((have - want).items())[:2]}; "
        f"only SQL {list((want - have).items())[:2]}"
    )[:1500]


if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).parents[1]))
    from __spark_entry__ import oracle_sql, queries

    from newsloom import create_spark_session

    folder, names = sys.argv[1], sys.argv[2:]
    spark = create_spark_session(
        "check", "local[8]", memory={"driver": "8g"}, extra={"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false"}
    )
    statements = oracle_sql()
    for name, run in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            if name in statements:
                result = differences(spark, folder, run, statements[name]) or "same"
            else:
                result = f"{run(spark, folder).count()} rows"
        except Exception as error:  # noqa: BLE001
            result = f"ERROR {str(error)[:1500]}"
        print(f"{time.time() - start:6.1f} {name}: {result}", flush=True)
