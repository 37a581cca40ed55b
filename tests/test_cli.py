from pathlib import Path

from pyspark.sql import functions as F

from newsloom.__main__ import main


def test_all_jobs(spark, small, tmp_path, capsys):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    code = F.expr("CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 WHEN 'de' THEN 2 ELSE 3 END")
    at = {n: str(tmp_path / n) for n in ("articles", "raw", "cleaned", "model", "labels", "out.txt")}
    docs.select(F.col("doc_id").alias("id"), "text", code.alias("label")).write.parquet(at["articles"])
    (tmp_path / "out.txt").write_text("the and of that\nle les des une\n", encoding="utf-8")
    for line in (
        f"ingest {at['articles']} {at['raw']}",
        f"process {at['raw']} {at['cleaned']}",
        f"train {at['cleaned']} {at['model']} {at['labels']} --ratio 1/5",
        f"evaluate {at['cleaned']} {at['model']} {at['labels']} ",
        f"classify {at['out.txt']} {at['model']} --threshold 0.1",
        f"texts {at['model']} the-and-of short --least 9",
    ):
        assert main(line.split()) == 0
    shown = capsys.readouterr().out
    assert list((tmp_path / "model").iterdir()) and "warning" not in shown
    assert "'validation': 40" in shown and "weighted avg" in shown and "the-and-of" in shown and "|short" not in shown


def test_a_cut_batch_warns_and_staged_tables_go(spark, small, tmp_path, capsys):
    from newsloom.staging import shared_dir

    docs = spark.read.parquet(f"{small}/documents.parquet").limit(40)
    at = {n: str(tmp_path / n) for n in ("articles", "raw", "cleaned", "model", "labels", "in.csv")}
    docs.select("text", (F.col("doc_id") % 2).alias("label")).write.parquet(at["articles"])
    (tmp_path / "in.csv").write_text("text\none\ntwo\nthree\n", encoding="utf-8")
    staged = Path(shared_dir(spark).removeprefix("file:")) / "newsloom"
    before = set(staged.iterdir()) if staged.exists() else set()
    for line in (
        f"ingest {at['articles']} {at['raw']}",
        f"process {at['raw']} {at['cleaned']}",
        f"train {at['cleaned']} {at['model']} {at['labels']} --max-iter 1 --features 1024 --smoothing 1 0.5",
        f"evaluate {at['cleaned']} {at['model']} {at['labels']} --kind pipeline",
        f"classify {at['in.csv']} {at['model']} --most 2 --single-line --kind pipeline",
    ):
        assert main(line.split()) == 0
    assert "3 articles found" in capsys.readouterr().err
    assert set(staged.iterdir()) == before


def test_missing_input(spark, tmp_path, capsys):
    assert main(["process", str(tmp_path / "none"), str(tmp_path / "out")]) == 1
    assert "no data at" in capsys.readouterr().err
