"""What must hold of the plans at any size."""

from explained import plan
from pyspark.sql import functions as F

from newsloom.operators.cleaning import clean_articles
from newsloom.operators.scoring import classify
from newsloom.plans import jobs
from newsloom.plans.queries import documents
from newsloom.sources import files


def test_cleaning_is_one_codegen_stage(spark, small):
    raw = documents(spark, small).withColumn("timestamp", F.lit("2024-01-02 03:04:05"))
    text = plan(clean_articles(raw).filter(F.col("timestamp").isNotNull()))
    assert "Python" not in text and "Exchange" not in text and "*(1) Project" in text


def test_pruning(spark, small, tmp_path):
    raw = documents(spark, small).withColumn("timestamp", F.lit("2024-01-02 03:04:05"))
    files.write_parquet(clean_articles(raw), str(tmp_path / "p"), ["category"])
    text = plan(files.read_model_input(spark, str(tmp_path / "p")).filter("category = 'en'").select("cleaned_text"))
    assert "ReadSchema: struct<cleaned_text:string>" in text
    assert "PartitionFilters: [isnotnull(category" in text and "= en)" in text


def test_split_reads_no_text(spark, small):
    _, rows = jobs.split_articles(documents(spark, small))
    text = plan(rows.select("id", "is_val"))
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in text
    assert "Window" not in text and text.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in text


def test_scoring_shuffles_no_text(spark, small):
    _, _, model = jobs.train_on_articles(documents(spark, small))
    text = plan(classify(documents(spark, small).select("id", "text"), model))
    assert "Exchange" not in text and text.count("Scan") + text.count("FileScan") >= 1


def test_hot_folder_is_split(spark, tmp_path):
    """All rows in one folder are still written by several tasks."""
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "100000")
    try:
        rows = spark.range(0, 200_000, 1, 8).withColumn("source", F.lit("hot")).withColumn("v", F.rand(1))
        files.write_parquet(rows, str(tmp_path / "p"), ["source"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(list((tmp_path / "p" / "source=hot").glob("*.parquet"))) > 2


def test_bucketed_articles_are_grouped_without_a_shuffle(spark, small, tmp_path):
    rows = documents(spark, small).select("id", "text")
    table = files.save_bucketed(rows, "bucketed_articles", str(tmp_path / "b"), 4)
    assert "Exchange" not in plan(table.groupBy("id").count())
    spark.sql("DROP TABLE bucketed_articles")


def test_submitted_memory_survives():
    from newsloom.session import BASE_CONF

    assert not any("memory" in key for key in BASE_CONF)
