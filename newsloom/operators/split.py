"""Exact, repeatable stratified split without gathering a label in one task.

Rows of a label are ordered by `md5("<seed>:<id>")`; the first `quota` of them
are validation rows. The hash is uniform, so counts per (label, hash prefix) find
the narrow range in which the quota ends. A first pass counts 256 prefixes, few
enough for partial aggregation to shrink every task's rows to them; should the
range still hold many rows, it is counted again by longer prefixes. Only what is
left is ranked. One cut value per label comes out, and the split itself is a
comparison on each row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.staging import stage

PREFIX_DIGITS = 2
MORE_DIGITS = 4
RANKED_ROWS = 500_000


def split_key(id_col: Column, seed: int = 42) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), id_col.cast("string")))


def label_profile(df: DataFrame, seed: int = 42) -> DataFrame:
    """`(category, prefix, n, first_id)`: rows per label and hash prefix.

    One pass over ids and categories; the staged result, at most 256 rows per
    label, gives the label map, the label sizes and the first cuts.
    """
    return stage(
        _keyed(df, seed, PREFIX_DIGITS).groupBy("category", "prefix").agg(F.count("*").alias("n"), F.min("id").alias("first_id")),
        "label-profile",
    )


def quotas(counts: DataFrame, numerator: int = 1, denominator: int = 10) -> DataFrame:
    """Validation rows per label from `(category, rows)`; windows over k rows.

    In all, ceil(N * ratio) rows. Each label gets its share rounded down, the
    rest goes one each to the largest remainders (ties by name), and a label
    never gives up its last row.
    """
    everything = Window.partitionBy()
    by_rest = Window.orderBy(F.col("rest").desc(), F.col("category"))
    shares = counts.select(
        "category",
        "rows",
        F.expr(f"rows * {numerator} div {denominator}").alias("base"),
        F.expr(f"rows * {numerator} % {denominator}").alias("rest"),
    )
    total = F.expr(f"(sum(rows) over () * {numerator} + {denominator - 1}) div {denominator}")
    spare = shares.withColumn("spare", total - F.sum("base").over(everything))
    extra = F.when(F.row_number().over(by_rest) <= F.col("spare"), 1).otherwise(0)
    return spare.select(
        "category", "rows", F.least(F.col("base") + extra, F.col("rows") - 1).cast("long").alias("quota")
    )


def cut_points(
    df: DataFrame,
    profile: DataFrame | None = None,
    numerator: int = 1,
    denominator: int = 10,
    seed: int = 42,
) -> DataFrame:
    """`(category, cut_key, cut_id)`: the last validation row of each label."""
    profile = label_profile(df, seed) if profile is None else profile
    quota = quotas(profile.groupBy("category").agg(F.sum("n").alias("rows")), numerator, denominator)
    digits = PREFIX_DIGITS
    edges = _edges(profile, quota)
    while (edges.agg(F.max("n").alias("n")).first().n or 0) > RANKED_ROWS and digits < 32:
        inside = _inside(df, seed, edges, digits)
        digits += MORE_DIGITS
        longer = F.substring("key", 1, digits).alias("prefix")
        counts = stage(inside.groupBy("category", longer).agg(F.count("*").alias("n")), "split-counts")
        edges = _edges(counts, edges.select("category", F.col("needed").alias("quota")))
    place = F.row_number().over(Window.partitionBy("category").orderBy("key", "id"))
    cuts = (
        _inside(df, seed, edges, digits)
        .withColumn("place", place)
        .filter(F.col("place") == F.col("needed"))
        .select("category", F.col("key").alias("cut_key"), F.col("id").alias("cut_id"))
    )
    return stage(cuts, "split-cuts")


def _edges(counts: DataFrame, quota: DataFrame) -> DataFrame:
    """`(category, prefix, n, needed)`: where each quota ends, and how far in."""
    upto = F.sum("n").over(Window.partitionBy("category").orderBy("prefix"))
    edges = (
        counts.withColumn("upto", upto)
        .join(quota, "category")
        .filter((F.col("upto") >= F.col("quota")) & (F.col("upto") - F.col("n") < F.col("quota")))
        .select("category", "prefix", "n", (F.col("quota") - F.col("upto") + F.col("n")).alias("needed"))
    )
    return stage(edges, "split-edges")


def _keyed(df: DataFrame, seed: int, digits: int) -> DataFrame:
    """Rows that can be ranked; one without an id or a label stays in training."""
    key = split_key(F.col("id"), seed)
    return df.filter(F.col("category").isNotNull() & F.col("id").isNotNull()).select(
        "category", "id", key.alias("key"), F.substring(key, 1, digits).alias("prefix")
    )


def _inside(df: DataFrame, seed: int, edges: DataFrame, digits: int) -> DataFrame:
    """The rows in the edge range of their label."""
    return _keyed(df, seed, digits).join(edges.drop("n"), ["category", "prefix"])


def mark_validation(df: DataFrame, cuts: DataFrame, seed: int = 42) -> DataFrame:
    """Add `is_val` by comparing each row with its label's cut."""
    side = cuts.withColumnRenamed("category", "_category")
    key = split_key(F.col("id"), seed)
    chosen = (key < F.col("cut_key")) | ((key == F.col("cut_key")) & (F.col("id") <= F.col("cut_id")))
    return (
        df.join(side, df["category"] == F.col("_category"), "left")
        .withColumn("is_val", F.coalesce(chosen, F.lit(False)))
        .drop("_category", "cut_key", "cut_id")
    )


def stratified_split(df: DataFrame, numerator: int = 1, denominator: int = 10, seed: int = 42) -> DataFrame:
    """`df` with `is_val`, by `category` and `id`."""
    return mark_validation(df, cut_points(df, None, numerator, denominator, seed), seed)


def split_sizes(split: DataFrame) -> DataFrame:
    """Rows on each side."""
    return split.groupBy("is_val").agg(F.count("*").alias("rows"))
