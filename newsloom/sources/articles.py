"""Labelled-article ingest: a table of texts and codes to raw records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.timestamps import timestamp_text
from newsloom.operators.labels import code_to_category
from newsloom.operators.positions import first_n, number_by, number_file_rows


def raw_records(
    articles: DataFrame,
    dataset: str,
    count: int | None = None,
    id_col: str = "id",
    text: str = "text",
    code: str = "label",
    moment: Column | None = None,
    renumber: bool = False,
) -> DataFrame:
    """Raw records `(id, timestamp, text, source, category)`.

    Takes the first `count` articles in id order, all of them for None or 0.
    Ids are kept, or replaced by the place in id order (NULLs last, equal ids by
    the other columns) when `renumber` is set. A table without ids is numbered in
    file order, and its first `count` rows are taken. A missing text column gives
    empty text; unknown codes give `unknown`.
    """
    if id_col not in articles.columns:
        articles = number_file_rows(articles, id_col)
    some = first_n(articles, count, id_col)
    row_id = F.col(id_col)
    if renumber:
        rest = [F.col(c) for c in some.columns if c != id_col]
        some = number_by(some, [F.col(id_col).asc_nulls_last(), *rest])
        row_id = F.col("position")
    return some.select(
        row_id.cast("long").alias("id"),
        timestamp_text(moment).alias("timestamp"),
        (F.col(text) if text in some.columns else F.lit("")).alias("text"),
        F.lit(dataset).alias("source"),
        code_to_category(F.col(code) if code in some.columns else F.lit(None)).alias("category"),
    )
