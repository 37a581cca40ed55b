import datetime

import pytest
from pyspark.sql import functions as F

from newsloom.schemas import CLEANED
from newsloom.sources import files
from newsloom.sources.articles import raw_records


def test_jsonl_reads_what_it_can(spark, tmp_path):
    lines = [
        '{"id": 1, "timestamp": "t", "text": "good", "source": "s", "category": "World"}',
        "{broken",
        '{"id": "x", "text": "text id"}',
        '{"id": 2.5, "text": "fraction"}',
        "",
        '{"id": 3, "text": 5}',
        '{"id": 4}',
    ]
    (tmp_path / "in.jsonl").write_text("\n".join(lines), encoding="utf-8")
    got = sorted((r.id or 0, r.text) for r in files.read_jsonl(spark, str(tmp_path / "in.jsonl")).collect() if r.text)
    assert got == [(0, "fraction"), (0, "text id"), (1, "good"), (3, "5")]
    assert files.read_jsonl(spark, str(tmp_path / "in.jsonl")).count() == 6


def test_jsonl_round_trip_keeps_nulls(spark, tmp_path):
    rows = [(1, None, 'a "q"\nü', "s", None), (2, "t", "", "", "c")]
    df = spark.createDataFrame(rows, "id long, timestamp string, text string, source string, category string")
    files.write_jsonl(df, str(tmp_path / "out"))
    assert sorted(files.read_jsonl(spark, str(tmp_path / "out")).collect()) == sorted(df.collect())
    text = "".join(p.read_text(encoding="utf-8") for p in (tmp_path / "out").glob("part*"))
    assert '"category":null' in text and "ü" in text


def test_partitioned_parquet(spark, tmp_path):
    when = datetime.datetime(2024, 1, 2, 3, 4, 5)
    values = ["World", "Sci/Tech", "unknown", "", None, "007"]
    rows = [(i, when, "src", v, f"T{i}", f"t{i}") for i, v in enumerate(values)]
    files.write_parquet(spark.createDataFrame(rows, CLEANED), str(tmp_path / "p"), ["source", "category"])
    back = files.read_cleaned(spark, str(tmp_path / "p"))
    assert back.columns == CLEANED.fieldNames()
    assert [r.category for r in back.orderBy("id").collect()] == ["World", "Sci/Tech", "unknown", "unknown", None, "007"]
    assert back.filter("id = 1").first().timestamp == when
    assert files.read_model_input(spark, str(tmp_path / "p")).count() == 5


def test_numeric_folders_stay_text(spark, tmp_path):
    df = spark.createDataFrame([(1, "007")], "id long, category string").withColumn("source", F.lit("1"))
    files.write_parquet(df, str(tmp_path / "p"), ["source", "category"])
    assert files.read_cleaned(spark, str(tmp_path / "p")).first().category == "007"


def test_overwrite(spark, tmp_path):
    for rows in (5, 3):
        files.write_parquet(spark.range(rows), str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).count() == 3


def test_csv_round_trip(spark, tmp_path):
    rows = [(1, 'say "hi", ok', "x"), (2, "two\nlines", " padded "), (3, None, "back\\slash"), (4, 'end"', 'a\\"b')]
    df = spark.createDataFrame(rows, "id int, text string, other string")
    files.write_csv(df, str(tmp_path / "c"))
    back = files.read_csv(spark, str(tmp_path / "c"))
    assert sorted(tuple(r) for r in back.fillna("none").collect()) == sorted(
        (str(i), t or "none", o) for i, t, o in rows
    )


def test_csv_articles(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        'name,text\n1,"quoted ""word"", and comma"\n2,NA\n3,\n4,"two\nlines"\n5,null\n6,007\n', encoding="utf-8"
    )
    got = files.read_csv_articles(spark, str(tmp_path / "a.csv")).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(0, 'quoted "word", and comma'), (1, "two\nlines"), (2, "007")]
    (tmp_path / "b.csv").write_text("name,body\n1,x\n", encoding="utf-8")
    with pytest.raises(ValueError, match="text"):
        files.read_csv_articles(spark, str(tmp_path / "b.csv"))


def test_txt_articles(spark, tmp_path):
    (tmp_path / "a.txt").write_text("first line \n\n   \t\n \n  last\n", encoding="utf-8")
    got = files.read_txt_articles(spark, str(tmp_path / "a.txt")).orderBy("id").collect()
    assert [tuple(r) for r in got] == [(0, "first line"), (1, ""), (2, "last")]


def test_txt_order_over_many_blocks(spark, tmp_path):
    lines = [f"line {i} " + "x" * (i % 50) for i in range(4000)]
    (tmp_path / "a.txt").write_text("\n".join(lines), encoding="utf-8")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = files.read_txt_articles(spark, str(tmp_path / "a.txt")).orderBy("id").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [tuple(r) for r in got] == [(i, line.strip()) for i, line in enumerate(lines)]


@pytest.mark.parametrize("read", [files.read_jsonl, files.read_cleaned, files.read_label_map, files.read_csv_articles])
def test_missing_input(spark, tmp_path, read):
    with pytest.raises(files.MissingInput):
        read(spark, str(tmp_path / "nothing"))


def test_raw_records(spark):
    rows = spark.createDataFrame([(10, "a", 0), (20, None, 3), (30, "c", 9)], "id long, text string, label int")
    moment = F.lit("2024-01-02 03:04:05").cast("timestamp")
    got = raw_records(rows, "wire", 2, moment=moment, renumber=True).orderBy("id").collect()
    assert [tuple(r) for r in got] == [
        (0, "2024-01-02 03:04:05", "a", "wire", "World"),
        (1, "2024-01-02 03:04:05", None, "wire", "Sci/Tech"),
    ]
    bare = raw_records(rows.select("id"), "wire").first()
    assert bare.text == "" and bare.category == "unknown" and len(bare.timestamp) == 19
