"""Words as pieces of a given vocabulary, so that unseen words have features too.

The vocabulary is a tokenizer file that is read and never trained here. Pieces are a
matter of words, not of texts: a table of words is cut once per distinct word, and counts
of words become counts of pieces in one join and one aggregation.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from newsloom.staging import stage

#: What the last piece of a word ends in.
WORD_END = "</w>"


def read_vocabulary(path: str) -> str:
    """A tokenizer file as text, which is what workers are given; they need no access to the file."""
    with open(path, encoding="utf-8") as file:
        return file.read()


@lru_cache(maxsize=2)
def _tokenizer(vocabulary: str) -> Tokenizer:
    return Tokenizer.from_str(vocabulary)


def pieces_of(words: list[str], vocabulary: str) -> list[list[str]]:
    """The pieces of each word, in order; none for a word that the vocabulary cannot write."""
    return [e.tokens for e in _tokenizer(vocabulary).encode_batch(words, add_special_tokens=False)]


def word_pieces(words: DataFrame, path: str) -> DataFrame:
    """`(word, pieces)` for a table with a `word` per row."""
    shared = words.sparkSession.sparkContext.broadcast(read_vocabulary(path))

    def cut(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            found = pa.array(pieces_of(batch.column(0).to_pylist(), shared.value), pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["word", "pieces"])

    return words.select("word").mapInArrow(cut, "word string, pieces array<string>")


def piece_counts(counts: DataFrame, path: str) -> DataFrame:
    """Written counts `(label_idx, word, n, first_words)` of words as the same table of pieces.

    The first piece of a word that opens an article opens it, so the sums of `first_words` stay.
    """
    pieces = stage(word_pieces(counts.select("word").distinct(), path), "word-pieces")
    spread = counts.join(pieces, "word").select(
        "label_idx", F.posexplode("pieces").alias("place", "piece"), "n", "first_words"
    )
    opening = F.when(F.col("place") == 0, F.col("first_words")).otherwise(0)
    return spread.groupBy("label_idx", F.col("piece").alias("word")).agg(
        F.sum("n").alias("n"), F.sum(opening).alias("first_words")
    )
