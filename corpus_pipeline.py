"""From raw documents to packed training sequences, in five stages.

Each stage reads what the one before has written and returns the columns of
`documents`; the last returns the pieces of packed sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import decontamination, language, minhash, packing, pii
from newsloom.llm.queries import share, table
from newsloom.staging import stage

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Calibrated probability of the best language under which a text counts as being in none.
LEAST_LANGUAGE_SCORE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents in no known language: no letters, or no language likely enough.

    If no row has a language to learn from, nothing can be told and all rows stay.
    """
    model = language.fit(docs.filter(share("doc_id", 5) != 0))
    if not model.languages:
        return docs.select(*COLUMNS)
    found = language.predict(docs.select(*COLUMNS), model)
    return found.filter(
        (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    ).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates: five-word shingles, four fifths in common."""
    return minhash.deduplicated(docs).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold an item of the benchmark."""
    found = decontamination.flag(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))
    return found.filter(~F.col("contaminated")).select(*COLUMNS)


def sanitise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data and disclosing terms by their kinds; `n_chars` follows the text."""
    found = pii.annotate(docs.select(*COLUMNS))
    changed = F.size("spans") > 0
    text = F.when(changed, pii.redacted(F.col("text"), F.col("spans"))).otherwise(F.col("text"))
    n_chars = F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumn("text", text).withColumn("n_chars", n_chars).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of training sequences of at most 2,048 tokens, with their ids."""
    return packing.pack(docs)


STAGES = [
    ("language", language_id),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("pii", sanitise),
    ("pack", pack),
]

#: Language models, signatures and token ids are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed corpus made of the table `documents`."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
