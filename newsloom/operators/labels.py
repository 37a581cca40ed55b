"""Label map, encoding and decoding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The category of each label code, and the name of any other.
CATEGORIES = {0: "World", 1: "Sports", 2: "Business", 3: "Sci/Tech"}
NO_CATEGORY = "unknown"


def code_to_category(code: Column) -> Column:
    """Whole-number code to category name; any other value and NULL become `unknown`.

    A code counts only if it is a whole number as given: wide, fractional and
    unreadable ones are no codes.
    """
    pairs = [F.lit(v) for k, name in CATEGORIES.items() for v in (float(k), name)]
    number = code.cast("string").try_cast("double")
    return F.coalesce(F.try_element_at(F.create_map(*pairs), number), F.lit(NO_CATEGORY))


def distinct_categories(df: DataFrame, category: str = "category", id_col: str = "id") -> DataFrame:
    """Every category with the id of its first row (partial aggregation, k rows out)."""
    return (
        df.filter(F.col(category).isNotNull())
        .groupBy(F.col(category).alias("category"))
        .agg(F.min(id_col).alias("first_id"))
    )


def label_map(df: DataFrame, category: str = "category", id_col: str = "id") -> DataFrame:
    """`(category, label_idx)`, numbered by first appearance in id order.

    The window has no partition key but sees one row per category only.
    """
    order = Window.orderBy("first_id", "category")
    return distinct_categories(df, category, id_col).select(
        "category", (F.row_number().over(order) - 1).cast("int").alias("label_idx")
    )


def grow_label_map(known: DataFrame, more: DataFrame) -> DataFrame:
    """`known` with the categories of the label map `more` that it lacks, numbered on in their order there.

    Categories keep their index for good, also those that no longer occur. One row per category is moved.
    """
    last = known.agg(F.coalesce(F.max("label_idx"), F.lit(-1)).alias("last"))
    new = more.join(known.select("category"), "category", "left_anti")
    place = F.row_number().over(Window.orderBy("label_idx"))
    numbered = new.join(F.broadcast(last)).select("category", (F.col("last") + place).cast("int").alias("label_idx"))
    return known.select("category", "label_idx").unionByName(numbered)


def encode(df: DataFrame, labels: DataFrame, category: str = "category", out: str = "label_idx") -> DataFrame:
    """Add the label index of each row's category; NULL for an unseen one."""
    side = labels.select(F.col("category").alias("_category"), F.col("label_idx").alias(out))
    return df.join(side, df[category] == F.col("_category"), "left").drop("_category")


def decode(
    df: DataFrame, labels: DataFrame, index: str, out: str, missing: str = "Unknown"
) -> DataFrame:
    """Add the category of a label index; `missing` where the map has none."""
    side = labels.select(F.col("label_idx").alias("_idx"), F.col("category").alias("_name"))
    joined = df.join(side, df[index] == F.col("_idx"), "left")
    return joined.withColumn(out, F.coalesce("_name", F.lit(missing))).drop("_idx", "_name")


def label_names(labels: DataFrame) -> list[str]:
    """Category names in index order; a model holds one score column for each."""
    rows = labels.select("label_idx", "category").collect()  # one row per class
    return [r.category for r in sorted(rows, key=lambda r: r.label_idx)]
