"""Contiguous row numbers and first-N subsets, without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, IntegralType

from newsloom.staging import stage

BUCKET_BITS = 12


def positions(df: DataFrame, key: str = "id") -> DataFrame:
    """`(key, position)`: 0-based place of each row in key order."""
    return number_by(df.select(key), [F.col(key)])


def number_by(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Add `position`, the 0-based place of each row in `order`, which must be total.

    A range-partitioned sort is written once with each row's slot (partition
    number and place in it); the sizes of the partitions before turn slots
    into positions. There are never more offset rows than sort partitions,
    which bounds the broadcast.
    """
    slots = stage(df.orderBy(*order).withColumn("_slot", F.monotonically_increasing_id()), "positions")
    part = F.shiftright("_slot", 33)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        slots.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    place = F.col("_offset") + F.col("_slot").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        slots.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .select(*df.columns, place.cast("long").alias("position"))
    )


def number_file_rows(df: DataFrame, id_col: str = "id") -> DataFrame:
    """Number the rows of a file source from 0 in file order, without writing or shuffling them.

    `df` must still offer the scan's `_metadata`. A first pass counts the rows of every
    file block; the sizes of the blocks before and a row's slot in its task give its
    number in the second. There is one row per input split to broadcast. Should Spark split
    the files in another way the second time, the query fails instead of numbering wrongly.
    """
    slot = F.monotonically_increasing_id()
    tagged = df.select(
        slot.alias("_slot"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.col("_metadata.file_block_length").alias("_length"),
        *df.columns,
    ).withColumn("_task", F.shiftright("_slot", 33))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    place = ["_file", "_block", "_length", "_task"]
    blocks = stage(
        tagged.groupBy(*place)
        .agg(F.count("*").alias("_n"), F.min("_slot").alias("_first"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        .drop("_n"),
        "file-blocks",
    )
    number = (F.col("_offset") + F.col("_slot") - F.col("_first")).cast("long")
    sure = F.coalesce(number, F.raise_error(F.lit("files were split differently")).cast("long"))
    return tagged.join(F.broadcast(blocks), place, "left").select(sure.alias(id_col), *df.columns)


def nth_smallest(df: DataFrame, key: str, n: int) -> int | None:
    """The n-th smallest value of a long column, None for no rows.

    Each pass counts rows per power-of-two range of the key and keeps the
    range that holds the n-th. There are at most 4,097 ranges, so partial
    aggregation shrinks every task's rows to them; 64 bits take six passes at
    most, each reading one column.
    """
    bounds = df.agg(F.min(key).alias("low"), F.max(key).alias("high"), F.count(key).alias("rows")).first()
    if not bounds.rows:
        return None
    low, high = bounds.low, bounds.high
    if n >= bounds.rows:
        return high
    wanted = n
    while low < high:
        shift = 0
        while (high >> shift) - (low >> shift) >= 1 << BUCKET_BITS:
            shift += 1
        counts = (
            df.filter(F.col(key).between(low, high))
            .groupBy(F.shiftright(F.col(key), shift).alias("bucket"))
            .agg(F.count("*").alias("rows"))
            .collect()
        )
        for bucket, rows in sorted(tuple(r) for r in counts):
            if wanted <= rows:
                low, high = max(low, bucket << shift), min(high, ((bucket + 1) << shift) - 1)
                break
            wanted -= rows
    return low


def first_n(df: DataFrame, n: int | None, key: str = "id") -> DataFrame:
    """The first `n` rows by a key of any sortable type, NULLs last; all of them for None and 0.

    The n-th key is found by counting (whole numbers) or by numbering the keys
    alone, and becomes a filter that reaches the scan. Of the rows that share that
    key as many as are still wanted are taken, in the order of their other
    columns. There are exactly `n` rows, or all if there are fewer.
    """
    if not n:
        return df
    filled = df.filter(F.col(key).isNotNull())
    count = filled.count()
    if n > count:
        below, ties = filled, df.filter(F.col(key).isNull())
    else:
        if isinstance(df.schema[key].dataType, IntegralType):
            cut = F.lit(nth_smallest(df, key, n))
        else:
            nth = number_by(filled.select(key), [F.col(key)]).filter(F.col("position") == n - 1)
            cut = F.lit(nth.first()[key])
        cut = cut.cast(df.schema[key].dataType)
        below, ties = df.filter(F.col(key) < cut), df.filter(F.col(key) == cut)
        count = below.count()
    wanted = n - count
    if ties.count() > wanted:
        order = [F.col(f.name) for f in df.schema if not _holds_map(f.dataType)]
        ties = number_by(ties, order).filter(F.col("position") < wanted).drop("position")
    return below.unionByName(ties)


def _holds_map(kind: DataType) -> bool:
    return "map<" in kind.simpleString() or "variant" in kind.simpleString()
