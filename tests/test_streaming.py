import json

from newsloom.operators.cleaning import clean_articles
from newsloom.operators.naive_bayes import fit
from newsloom.operators.scoring import classify
from newsloom.sources import files
from newsloom.streaming.articles import (
    classify_stream,
    clean_stream,
    read_jsonl_stream,
    read_parquet_stream,
    read_results,
)


def drop_file(folder, name, first, count):
    folder.mkdir(exist_ok=True)
    rows = [
        {"id": i, "timestamp": "2024-01-02 03:04:05", "text": f"Goal {i}!" if i % 2 else "Bank", "source": "w",
         "category": ["Sci/Tech", ""][i % 2]}
        for i in range(first, first + count)
    ]
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows), encoding="utf-8")


def test_clean_stream_equals_batch(spark, tmp_path):
    arrivals, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    drop_file(arrivals, "a.jsonl", 0, 10)
    drop_file(arrivals, "b.jsonl", 10, 5)

    def run():
        clean_stream(read_jsonl_stream(spark, str(arrivals), files_per_batch=1), out, mark).awaitTermination()
        return sorted(tuple(r) for r in files.read_cleaned(spark, out).collect())

    def batch():
        raw = files.read_jsonl(spark, str(arrivals))
        rows = files.folder_values(clean_articles(raw), ["source", "category"])
        return sorted(tuple(r) for r in rows.collect())

    assert run() == batch()
    assert run() == batch() and len(batch()) == 15
    drop_file(arrivals, "c.jsonl", 15, 4)
    assert run() == batch() and len(batch()) == 19


def test_classify_stream_equals_batch(spark, tmp_path):
    train = spark.createDataFrame([("goal", 0), ("bank", 1)], "cleaned_text string, label_idx int")
    known = spark.createDataFrame([("Sports", 0), ("Business", 1)], "category string, label_idx int")
    model = fit(train, known)
    arrivals, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    drop_file(arrivals, "a.jsonl", 0, 6)
    drop_file(arrivals, "b.jsonl", 6, 3)
    for _ in range(2):
        raw = read_jsonl_stream(spark, str(arrivals), files_per_batch=1)
        classify_stream(raw.select("id", "text"), model, out, mark).awaitTermination()
    got = spark.read.parquet(out).select("id", "predicted_category", "confidence")
    wanted = classify(files.read_jsonl(spark, str(arrivals)).select("id", "text"), model)
    assert sorted(got.collect()) == sorted(wanted.select(*got.columns).collect()) and got.count() == 9


def test_tables_of_one_and_of_several_files(spark, tmp_path):
    rows = spark.range(0, 50).selectExpr("id", "concat('Goal ', id) text", "'w' source", "'c' category")
    rows = rows.selectExpr("id", "'2024-01-02 03:04:05' timestamp", "text", "source", "category")
    rows.repartition(5).write.parquet(str(tmp_path / "folder.parquet"))
    rows.coalesce(1).write.parquet(str(tmp_path / "one"))
    single = next((tmp_path / "one").glob("*.parquet"))
    single.rename(tmp_path / "single.parquet")
    for name in ("folder", "single"):
        out = tmp_path / f"out-{name}"
        arriving = read_parquet_stream(spark, str(tmp_path / f"{name}.parquet"))
        clean_stream(arriving, str(out), str(tmp_path / f"mark-{name}"), writers=2).awaitTermination()
        assert files.read_cleaned(spark, str(out)).count() == 50
        assert len(list(out.rglob("*.parquet"))) <= 2


def test_a_stream_without_files(spark, tmp_path):
    train = spark.createDataFrame([("goal", 0)], "cleaned_text string, label_idx int")
    model = fit(train, spark.createDataFrame([("Sports", 0)], "category string, label_idx int"))
    (tmp_path / "in").mkdir()
    raw = read_jsonl_stream(spark, str(tmp_path / "in"))
    classify_stream(raw.select("id", "text"), model, str(tmp_path / "out"), str(tmp_path / "mark")).awaitTermination()
    got = read_results(spark, str(tmp_path / "out"))
    assert got.count() == 0 and got.columns == classify(raw.select("id", "text"), model).columns
