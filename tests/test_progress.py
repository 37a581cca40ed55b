"""Progress of running streams, and quality counts that a replay does not change."""

import json
import os
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from newsloom.operators.cleaning import clean_articles, quality_counts
from newsloom.schemas import RAW
from newsloom.streaming import progress
from newsloom.streaming.articles import read_jsonl_stream


def lines(count, first=0):
    for i in range(first, first + count):
        when = "2024-01-02 03:04:05" if i % 3 else "never"
        yield json.dumps({"id": None if i % 5 == 0 else i, "timestamp": when, "text": f"Text {i}", "source": f"s{i % 2}", "category": "c"})


def write_files(folder: Path, files: int):
    folder.mkdir(parents=True, exist_ok=True)
    for i in range(files):
        (folder / f"{i}.json").write_text("\n".join(lines(4 + i, 10 * i)), encoding="utf-8")
        os.utime(folder / f"{i}.json", (1_700_000_000 + i, 1_700_000_000 + i))  # files arrive in order


def batch_result(spark, folder):
    return quality_counts(clean_articles(spark.read.schema(RAW).json(str(folder)))).first()


def test_counts_rise_and_end_at_the_total(spark, tmp_path):
    write_files(tmp_path / "in", 5)
    arriving = progress.counted(read_jsonl_stream(spark, str(tmp_path / "in"), files_per_batch=1))
    seen = []
    query = progress.clean_stream_with_counts(arriving, str(tmp_path / "out"), str(tmp_path / "check"))
    total = 4 + 5 + 6 + 7 + 8
    last = progress.watch(query, seen.append, total)
    assert [p.batches for p in seen] == [1, 2, 3, 4, 5] and [p.done for p in seen] == sorted(p.done for p in seen)
    assert last == seen[-1] and last.done == total and last.share == 1
    assert progress.batch_counts(spark, str(tmp_path / "out")).count() == 5
    assert progress.quality_total(spark, str(tmp_path / "out")).first() == batch_result(spark, tmp_path / "in")
    assert progress.read_rows(spark, str(tmp_path / "out")).count() == total


def test_a_replayed_batch_counts_once(spark, tmp_path):
    write_files(tmp_path / "in", 3)
    out, check = tmp_path / "out", tmp_path / "check"

    def run():
        arriving = progress.counted(read_jsonl_stream(spark, str(tmp_path / "in"), files_per_batch=1))
        return progress.watch(progress.clean_stream_with_counts(arriving, str(out), str(check)), lambda _: None)

    assert run().done == 15
    first = progress.quality_total(spark, str(out)).first()
    # As if the run had died after the last batch was written and before it was noted as done.
    for mark in (check / "commits").glob("*2*"):
        mark.unlink()
    before = {p: p.stat().st_mtime_ns for p in (out / "counts" / "batch=2").glob("*.parquet")}
    time.sleep(0.01)
    again = run()
    after = {p for p in (out / "counts" / "batch=2").glob("*.parquet")}
    assert again.done == 6 and after and not after & set(before)
    assert progress.quality_total(spark, str(out)).first() == first == batch_result(spark, tmp_path / "in")
    assert progress.read_rows(spark, str(out)).count() == 15


def test_before_the_first_batch(spark, tmp_path):
    total = progress.quality_total(spark, str(tmp_path / "none")).first()
    assert total.records == total.null_ids == 0 and progress.read_rows(spark, str(tmp_path / "none")).count() == 0


def test_a_failed_query_raises(spark, tmp_path):
    write_files(tmp_path / "in", 2)
    arriving = progress.counted(read_jsonl_stream(spark, str(tmp_path / "in"), files_per_batch=1))
    failing = arriving.withColumn("text", F.when(F.col("id") > 9, F.raise_error(F.lit("broken"))).otherwise(F.col("text")))
    seen = []
    query = progress.clean_stream_with_counts(failing, str(tmp_path / "out"), str(tmp_path / "check"))
    with pytest.raises(Exception, match="broken"):
        progress.watch(query, seen.append)
    assert [p.done for p in seen] == [4]
