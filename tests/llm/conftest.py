from __future__ import annotations

import pytest
from pyspark.sql import functions as F


@pytest.fixture(scope="session")
def docs_schema():
    return "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd_docs(spark, docs_schema):
    """NULLs in every column, empty and long texts, repeated rows, and columns with clashing names."""
    rows = [
        (1, "The quick brown fox jumps over the lazy dog near the river bank", "en", "a", 63),
        (1, "The quick brown fox jumps over the lazy dog near the river bank", "en", "a", 63),
        (2, None, None, None, None),
        (None, "Mail bob@example.com or call +1 (222) 555-7713 today please", "en", "b", 50),
        (None, None, "fr", "b", None),
        (3, "", "fr", "c", 0),
        (4, "  \t\n ", "de", "c", 5),
        (5, "word " * 30_000, "en", "d", 150_000),
        (6, "1234567 !!! 99.99", "de", "d", 17),
        (7, "x", None, "d", 1),
    ]
    frame = spark.createDataFrame(rows, docs_schema)
    extra = "score spans item_id set_key node id label coverage _row own _id _hash _text _found Lang_Pred".split()
    return frame.withColumns({n: F.lit(f"mine-{n}") for n in extra})


@pytest.fixture(scope="session")
def no_docs(spark, docs_schema):
    return spark.createDataFrame([], docs_schema)

