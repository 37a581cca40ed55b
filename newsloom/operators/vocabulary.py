"""Word counts and the vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.functions.scores import word_tokens
from newsloom.operators.positions import number_by


def label_word_counts(
    df: DataFrame, label: str = "label_idx", cleaned: str = "cleaned_text", most: int | None = None
) -> DataFrame:
    """`(label_idx, word, n, first_words)` over the tokens of each article.

    `first_words` counts how often the word opens an article, so its sum per
    label is the number of articles with text: one pass gives both. Partial
    aggregation leaves at most one row per task for a frequent word.
    """
    tokens = df.select(F.col(label).alias("label_idx"), F.posexplode(word_tokens(cleaned, most)).alias("place", "word"))
    return tokens.groupBy("label_idx", "word").agg(
        F.count("*").alias("n"), F.count_if(F.col("place") == 0).alias("first_words")
    )


def word_counts(df: DataFrame, cleaned: str = "cleaned_text", most: int | None = None) -> DataFrame:
    """`(word, n)` over all articles."""
    tokens = df.select(F.explode(word_tokens(cleaned, most)).alias("word"))
    return tokens.groupBy("word").agg(F.count("*").alias("n"))


def top_words(counts: DataFrame, size: int | None = None) -> DataFrame:
    """The `size` most frequent words, ties by word; all of them for None.

    `counts` is read twice, so pass a staged table. Words are first thinned by
    the bit length of their count: lengths are tallied from the top until
    `size` words are covered, and shorter counts cannot be among the top. What is
    left is numbered by a distributed sort.
    """
    if size is None:
        return counts
    bits = F.length(F.bin("n"))
    tally = counts.groupBy(bits.alias("bits")).agg(F.count("*").alias("words"))
    rows = sorted(tally.collect(), key=lambda r: -r.bits)  # at most 64 rows
    if sum(r.words for r in rows) <= size:
        return counts
    covered, least = 0, 0
    for row in rows:
        covered, least = covered + row.words, row.bits
        if covered >= size:
            break
    left = counts.filter(F.col("n") >= F.lit(1 << (least - 1)))
    return number_by(left, [F.col("n").desc(), F.col("word")]).filter(F.col("position") < size).drop("position")
