import pytest
from pyspark.sql import functions as F

from newsloom.operators import naive_bayes
from newsloom.operators.epochs import Schedule
from newsloom.operators.pipeline import Candidate
from newsloom.plans import jobs
from newsloom.sources import files


@pytest.fixture(scope="module")
def trained(spark, small, tmp_path_factory):
    base = tmp_path_factory.mktemp("pipeline")
    docs = spark.read.parquet(f"{small}/documents.parquet")
    code = F.expr("CASE lang WHEN 'en' THEN 0 WHEN 'fr' THEN 1 WHEN 'de' THEN 2 ELSE 3 END")
    docs.select(F.col("doc_id").alias("id"), "text", code.alias("label")).write.parquet(str(base / "articles"))
    paths = {n: str(base / n) for n in ("articles", "raw", "cleaned", "model", "labels", "predictions")}
    jobs.ingest(spark, paths["articles"], "newswire", paths["raw"])
    counts = jobs.process(spark, paths["raw"], paths["cleaned"])
    summary = jobs.train(spark, paths["cleaned"], paths["model"], paths["labels"], candidates=[Candidate(2)])
    return base, paths, counts, summary


def test_counts(trained):
    _, _, counts, summary = trained
    assert counts == {"records": 200, "null_timestamps": 0, "null_ids": 0}
    assert summary["training"] == 180 and summary["validation"] == 20
    assert summary["accuracy"] > 0.9 and 0 <= summary["pipeline_accuracy"] <= 1


def test_evaluate_repeats_the_split(spark, trained):
    _, paths, _, summary = trained
    found = jobs.evaluate(spark, paths["cleaned"], paths["model"], paths["labels"], paths["predictions"])
    first = found.accuracy.first()
    assert first.rows == 20 and first.accuracy == summary["accuracy"]
    assert found.confusion.agg(F.sum("n")).first()[0] == 20
    assert found.errors.first().errors == 20 - first.correct == found.error_sample.count()
    assert files.read_csv(spark, paths["predictions"]).count() == 20
    assert {r.category for r in found.report.collect()} == {"World", "Sports", "Business", "Sci/Tech"}
    assert {r.average for r in found.averages.collect()} == {"accuracy", "macro avg", "weighted avg"}


def test_classify_files(spark, trained):
    base, paths, _, _ = trained
    docs = [r.text for r in spark.read.parquet(paths["articles"]).orderBy("id").limit(3).collect()]
    (base / "in.txt").write_text("\n".join(d.replace("\n", " ") for d in docs) + "\n  \n", encoding="utf-8")
    out = jobs.classify_file(spark, str(base / "in.txt"), paths["model"], results_out=str(base / "results"))
    rows = out.results.orderBy("id").collect()
    assert len(rows) == 4 and rows[3].predicted_category == "Invalid/Empty"
    assert out.confident.count() <= 3 and out.distribution.agg(F.sum("count")).first()[0] == out.confident.count()
    assert files.read_csv(spark, str(base / "results")).count() == 4
    capped = jobs.classify_file(spark, str(base / "in.txt"), paths["model"], most=2)
    assert capped.results.count() == 2


def test_either_model_serves(spark, trained):
    _, paths, _, summary = trained
    items = spark.read.parquet(paths["articles"]).select("id", "text").limit(5)
    for kind, key in (("bayes", "accuracy"), ("pipeline", "pipeline_accuracy")):
        model = jobs.load_model(spark, paths["model"], kind)
        assert jobs.classify_articles(items, model).results.count() == 5
        found = jobs.evaluate(spark, paths["cleaned"], paths["model"], paths["labels"], kind=kind)
        assert found.accuracy.first().accuracy == pytest.approx(summary[key])
    best = jobs.load_model(spark, paths["model"])
    wanted = "BayesModel" if summary["accuracy"] >= summary["pipeline_accuracy"] else "Regression"
    assert type(best).__name__ == wanted


def test_later_articles_do_not_move_the_split(spark, trained, tmp_path):
    _, paths, _, _ = trained
    rows = files.read_cleaned(spark, paths["cleaned"])
    more = rows.withColumn("id", F.col("id") + 1000)
    files.write_parquet(rows.unionByName(more), str(tmp_path / "more"), jobs.PARTITIONS)
    found = jobs.evaluate(spark, str(tmp_path / "more"), paths["model"], paths["labels"])
    assert found.predictions.filter("id < 1000").count() == 20


def test_missing_model(spark, trained, tmp_path):
    _, paths, _, _ = trained
    with pytest.raises(files.MissingInput):
        jobs.load_model(spark, str(tmp_path))
    with pytest.raises(files.MissingInput):
        jobs.evaluate(spark, paths["cleaned"], paths["model"], str(tmp_path / "none"))


def test_malformed_lines_are_put_aside(spark, tmp_path):
    good = '{"id": 1, "timestamp": "2024-01-02 03:04:05", "text": "Good", "source": "s", "category": "World"}'
    lines = [good, "{broken", "", '{"id": "x", "text": "t"}', good.replace("1,", "2,")]
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text("\n".join(lines), encoding="utf-8")
    place = {n: str(tmp_path / n) for n in ("in", "out", "bad", "more", "none")}
    counts = jobs.process(spark, place["in"], place["out"], quarantine=place["bad"])
    assert counts == {"records": 2, "null_timestamps": 0, "null_ids": 0, "malformed": 2}
    assert sorted(r.id for r in files.read_cleaned(spark, place["out"]).collect()) == [1, 2]
    rejected = spark.read.json(place["bad"]).collect()
    assert sorted(r.record for r in rejected) == ['{"id": "x", "text": "t"}', "{broken"] and "a.json" in rejected[0].file
    (tmp_path / "in" / "a.json").write_text(good, encoding="utf-8")
    counts = jobs.process(spark, place["in"], place["more"], quarantine=place["none"])
    assert counts["malformed"] == 0 and not files.exists(spark, place["none"])


def test_training_again_adds_a_version_and_keeps_labels(spark, trained, tmp_path, monkeypatch):
    _, paths, _, _ = trained
    model, known = str(tmp_path / "model"), str(tmp_path / "labels")
    old = spark.createDataFrame([("Gone", 0), ("Sci/Tech", 1)], "category string, label_idx int")
    files.write_label_map(old, known)
    schedule = Schedule(epochs=2, shards=2)
    run = str(tmp_path / "run")
    summary = jobs.train(spark, paths["cleaned"], model, known, features=4096, schedule=schedule, run_dir=run)
    grown = {r.category: r.label_idx for r in files.read_label_map(spark, known).collect()}
    assert grown["Gone"] == 0 and grown["Sci/Tech"] == 1 and sorted(grown.values()) == list(range(5))
    assert summary["version"] == 1 and summary["epoch"] in (1, 2) and 0 <= summary["epochs_accuracy"] <= 1
    assert summary["temperature"] > 0
    served = jobs.load_model(spark, model, "bayes")
    assert served.temperature == summary["temperature"]
    found = jobs.evaluate(spark, paths["cleaned"], model, known, kind="epochs")
    assert found.accuracy.first().accuracy == pytest.approx(summary["epochs_accuracy"])
    items = spark.read.parquet(paths["articles"]).select("id", "text").limit(5)
    assert jobs.classify_articles(items, jobs.load_model(spark, model, "epochs")).results.count() == 5

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(naive_bayes, "_write_settings", lost)
        with pytest.raises(RuntimeError):
            jobs.train(spark, paths["cleaned"], model, known)
    assert jobs.load_model(spark, model, "bayes").path == served.path
    assert jobs.train(spark, paths["cleaned"], model, known)["version"] == 2
    assert jobs.load_model(spark, model, "bayes").path != served.path
    assert served.words.count() > 0
