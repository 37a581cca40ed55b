"""The queries of the subpackage and the corpus pipeline."""

from __future__ import annotations

import re

import pytest
from check import differences
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from newsloom.llm.queries import ORACLES, QUERIES


def test_registered():
    found = __spark_entry__.queries()
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(found)
    assert [s for s, _ in corpus_pipeline.STAGES] == ["language", "near_dedup", "decontaminate", "pii", "pack"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, small, name):
    assert differences(spark, small, QUERIES[name], ORACLES[name]) is None


BASE = [
    "The committee met on the third of March to discuss the new harbour and its many costs in detail",
    "Rain fell over the old roofs while the dog lay by the door and nobody in the house spoke a word",
    "A letter from the coast arrived after nine weeks and told of storms and ships and silent islands",
]
ITEM = "Which river flows past the seven bridges of the northern town and where does it reach the open sea"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Planted cases: exact and near copies, a leaked item, personal data, no language, clean texts."""
    base = tmp_path_factory.mktemp("corpus")
    long = [" ".join([t] + [f"{t.split()[i % 18]} {i}th {t.split()[-1 - i % 17]}" for i in range(60)]) for t in BASE]
    rows = [(i, t, "en", "a", len(t)) for i, t in enumerate(long)]
    rows += [(10, long[0], "en", "b", 1), (11, long[1] + " again", "en", "b", 1)]
    rows += [(20, f"Before it came this. {ITEM}? And after it that, in other words.", "en", "c", 1)]
    rows += [(30, "Please write to jane.roe@mail.example.com or call +1 (222) 555-7713 before the end of the week", "en", "c", 1)]
    rows += [(40, "12345 !!! 678", "en", "c", 1), (41, None, "en", "c", None), (42, "", None, None, 0)]
    rows += [(100 + i, " ".join(f"mot{i}x{k} le les des" for k in range(12)), "fr", "d", 5) for i in range(30)]
    rows += [(200 + i, " ".join(f"word{i}y{k} the of and" for k in range(12)), "en", "d", 5) for i in range(30)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    frame.repartition(3).write.parquet(str(base / "documents.parquet"))
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(str(base / "benchmark.parquet"))
    return str(base)


def test_stages_on_planted_cases(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, folder)
        docs.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        assert tuple(docs.columns) == corpus_pipeline.COLUMNS
        seen[name] = {r.doc_id: r for r in docs.collect()}
    clean = set(range(3)) | {30} | set(range(100, 130)) | set(range(200, 230))
    assert set(seen["language"]) == clean | {10, 11, 20}
    assert set(seen["near_dedup"]) == clean | {20}
    assert set(seen["decontaminate"]) == clean
    assert set(seen["pii"]) == clean
    text = seen["pii"][30].text
    assert "[EMAIL]" in text and "[PHONE]" in text and "jane" not in text and seen["pii"][30].n_chars == len(text)
    assert all(seen["pii"][i] == seen["decontaminate"][i] for i in clean - {30})


def test_run_is_the_stages_one_after_another(spark, folder):
    pieces = corpus_pipeline.run(spark, folder)
    tokens = pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.first("doc_tokens").alias("all")).collect()
    assert len(tokens) == 64 and all(r.n == r["all"] for r in tokens)
    assert pieces.select("sequence_id", "offset").distinct().count() == pieces.count()


def test_a_corpus_of_nothing(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_no_operator_imports_from_elsewhere():
    from pathlib import Path

    root = Path(corpus_pipeline.__file__).parent
    for path in (root / "newsloom").rglob("*.py"):
        if "llm" not in path.parts:
            assert not re.search(r"^\s*(from|import) newsloom\.llm", path.read_text(), re.M), path
