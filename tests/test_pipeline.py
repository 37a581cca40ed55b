import pytest

from newsloom.operators import pipeline
from newsloom.operators.scoring import classify

WORDS = {0: "ball goal match", 1: "stock market bank"}


@pytest.fixture(scope="module")
def rows(spark):
    data = [(i, f"{WORDS[i % 2]} w{i % 7}", i % 2) for i in range(60)] + [(60, None, 0), (61, "", 1)]
    return spark.createDataFrame(data, "id long, cleaned_text string, label_idx int")


def test_fit_save_load_classify(spark, rows, tmp_path):
    model = pipeline.fit(rows, pipeline.Candidate(5, 0.0), features=256)
    pipeline.save(model, str(tmp_path / "m"))
    model = pipeline.load(str(tmp_path / "m"))
    predicted = pipeline.predict(rows.select("id", "cleaned_text", "label_idx"), model)
    assert predicted.filter("id < 60 and label_idx <> predicted_label_idx").count() == 0
    assert predicted.count() == 62
    texts = spark.createDataFrame([(1, "GOAL! Match."), (2, None), (3, "bank, stock")], "id long, text string")
    got = classify(texts, pipeline.Regression(model, ["Sports", "Business"])).orderBy("id").collect()
    assert [r.predicted_category for r in got] == ["Sports", "Invalid/Empty", "Business"]
    assert sum(got[0].raw_probabilities.values()) == pytest.approx(1)


def test_scoring_does_not_shuffle(rows):
    model = pipeline.fit(rows, features=256)
    plan = pipeline.predict(rows, model)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_first_best_wins(rows):
    choices = [pipeline.Candidate(4, 0.0), pipeline.Candidate(8, 0.0)]
    choice = pipeline.select_best(rows, rows.filter("id < 30"), choices, features=256)
    assert choice.accuracies == [1.0, 1.0] and choice.candidate == choices[0]
