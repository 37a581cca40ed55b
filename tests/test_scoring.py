import math

import pytest
from pyspark.sql import functions as F

from newsloom.functions import scores as sc
from newsloom.operators import labels, scoring
from newsloom.operators.naive_bayes import fit


def one(spark, column, value, kind):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("out")).first().out


@pytest.mark.parametrize("values, wanted", [([1.0, 3.0, 3.0], 1), ([5.0], 0), ([-1.0, None, -2.0], 0)])
def test_argmax(spark, values, wanted):
    assert one(spark, sc.argmax, values, "array<double>") == wanted


@pytest.mark.parametrize("values", [[0.0, 1.0, -2.0], [1000.0, 1001.0], [-5000.0, 0.0]])
def test_softmax(spark, values):
    got = one(spark, sc.softmax, values, "array<double>")
    raw = [math.exp(v - max(values)) for v in values]
    assert got == pytest.approx([r / sum(raw) for r in raw]) and sum(got) == pytest.approx(1)


def test_tokens(spark):
    text = " ".join(f"w{i}" for i in range(200))
    assert one(spark, sc.word_tokens, text, "string") == [f"w{i}" for i in range(200)]
    assert one(spark, lambda c: sc.word_tokens(c, sc.MAX_TOKENS), text, "string") == [f"w{i}" for i in range(128)]
    assert one(spark, sc.word_tokens, "", "string") == []
    assert one(spark, sc.word_tokens, None, "string") is None
    assert one(spark, lambda c: sc.word_tokens(c, 2), "a b", "string") == ["a", "b"]


def test_names(spark):
    named = one(spark, lambda c: sc.probability_map(c, ["World"]), [0.25, 0.75], "array<double>")
    assert named == {"World": 0.25, "L_1": 0.75}
    assert one(spark, lambda c: sc.name_of(c, ["World"]), 4, "int") == "Unknown"
    assert one(spark, lambda c: sc.name_of(c, ["World"], "Unknown Category"), None, "int") == "Unknown Category"


def test_number_formats(spark):
    assert one(spark, sc.fixed4, 0.98765432, "double") == "0.9877"
    assert one(spark, sc.percent, 0.98765432, "double") == "98.77%"
    assert one(spark, lambda c: sc.percent(c, 0), 0.75, "double") == "75%"
    for value in (0.005, 0.025, 0.125, 0.00125, 0.00375, 0.5, 1.0, 0.285, 1 / 3, 0.0, 2.675, 1e-9, 12345.678950001):
        assert one(spark, sc.fixed4, value, "double") == f"{value:.4f}"
        assert one(spark, sc.percent, value, "double") == f"{value * 100:.2f}%"
        assert one(spark, lambda c: sc.percent(c, 0), value, "double") == f"{value * 100:.0f}%"
    assert one(spark, sc.confidence_flag, 0.75, "double") == "ok"
    assert one(spark, sc.confidence_flag, 0.7499, "double") == "below_threshold"


@pytest.mark.parametrize(
    "code, name", [(0, "World"), (1, "Sports"), (2, "Business"), (3, "Sci/Tech"), (9, "unknown"), (-1, "unknown"), (None, "unknown")]
)
def test_codes(spark, code, name):
    assert one(spark, labels.code_to_category, code, "int") == name


@pytest.mark.parametrize("code", [1.7, 3_000_000_000.0, -1e300, float("nan"), float("inf"), 4294967297.0])
def test_odd_codes_are_no_codes(spark, code):
    assert one(spark, labels.code_to_category, code, "double") == "unknown"


def test_codes_as_wide_numbers(spark):
    assert one(spark, labels.code_to_category, 3_000_000_001, "long") == "unknown"
    assert one(spark, labels.code_to_category, 2.0, "double") == "Business"
    assert one(spark, labels.code_to_category, "3", "string") == "Sci/Tech"
    assert one(spark, labels.code_to_category, "x", "string") == "unknown"


def test_label_map_orders_by_first_id(spark):
    rows = [(5, "b"), (3, "c"), (9, "a"), (4, "b"), (7, "c"), (1, None)]
    df = spark.createDataFrame(rows, "id long, category string").repartition(3)
    known = labels.label_map(df)
    assert labels.label_names(known) == ["c", "b", "a"]
    encoded = {r.id: r.label_idx for r in labels.encode(df, known.filter("category <> 'a'")).collect()}
    assert encoded == {5: 1, 3: 0, 9: None, 4: 1, 7: 0, 1: None}
    decoded = labels.decode(spark.createDataFrame([(0,), (8,)], "i int"), known, "i", "name")
    assert {r.i: r.name for r in decoded.collect()} == {0: "c", 8: "Unknown"}


@pytest.fixture(scope="module")
def model(spark):
    rows = [(1, "ball game goal", 0), (2, "market stock bank", 1), (3, "goal goal", 0)]
    train = spark.createDataFrame(rows, "id long, cleaned_text string, label_idx int")
    known = spark.createDataFrame([("Sports", 0), ("Business", 1)], "category string, label_idx int")
    return fit(train, known)


def test_classify(spark, model):
    texts = ["A GOAL, a game!", None, " \t ", "12345", "Bank of stock http://goal.goal"]
    got = scoring.classify_texts(spark, texts, model).collect()
    assert [r.text for r in got] == texts
    assert [r.predicted_category for r in got] == ["Sports", "Invalid/Empty", "Invalid/Empty", "Sports", "Business"]
    assert got[1].confidence == 0.0 and got[1].raw_probabilities == {}
    assert got[3].confidence == pytest.approx(2 / 3)
    assert sum(got[4].raw_probabilities.values()) == pytest.approx(1)
    assert set(got[4].raw_probabilities) == {"Sports", "Business"}


def test_short_texts_can_be_refused(spark, model):
    got = scoring.classify_texts(spark, ["goal", None, "  goal goal  "], model, least=9).collect()
    assert [r.text for r in got] == ["  goal goal  "]


def test_classify_nothing_keeps_the_schema(spark, model):
    got = scoring.classify_texts(spark, [], model)
    assert got.count() == 0
    assert got.columns == ["id", "text", "predicted_category", "confidence", "raw_probabilities"]


def test_threshold_is_inclusive(spark):
    rows = spark.createDataFrame([(0.75,), (0.7499,), (0.0,)], "confidence double")
    assert scoring.above_threshold(rows).count() == 1 and scoring.above_threshold(rows, 0.0).count() == 3


def test_probability_rows_ascend(spark, model):
    rows = scoring.probability_rows(scoring.classify_texts(spark, ["goal", None], model)).collect()
    assert [r.category for r in rows] == ["Business", "Sports"] and rows[0].probability < rows[1].probability


def test_probability_rows_are_in_order_over_several_partitions(spark, model):
    items = spark.createDataFrame([(i, "goal" if i % 3 else "bank") for i in range(60)], "id long, text string")
    rows = scoring.probability_rows(scoring.classify(items.repartition(7), model)).collect()
    assert [(r.id, r.probability, r.category) for r in rows] == sorted((r.id, r.probability, r.category) for r in rows)


def test_ids_play_no_part(spark, model):
    rows = [(7, "goal"), (7, "bank"), (None, "goal"), (None, "  ")]
    items = spark.createDataFrame(rows, "id long, text string")
    got = sorted((r.id or 0, r.text, r.predicted_category) for r in scoring.classify(items, model).collect())
    assert got == [(0, "  ", "Invalid/Empty"), (0, "goal", "Sports"), (7, "bank", "Business"), (7, "goal", "Sports")]
