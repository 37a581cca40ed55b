import pytest

from newsloom.operators import metrics

NAMES = ["World", "Sports", "Business"]


def tables(spark, pairs):
    rows = [(i, f"text {i}", t, p) for i, (t, p) in enumerate(pairs)]
    predictions = spark.createDataFrame(
        rows, "id long, text string, true_label_idx int, predicted_label_idx int"
    ).repartition(3)
    labels = spark.createDataFrame(list(zip(NAMES, range(3))), "category string, label_idx int")
    return predictions, labels


MIXED = [(0, 0), (0, 1), (1, 1), (1, 1), (1, 0), (0, 0), (0, 7)]


@pytest.mark.parametrize(
    "pairs, wanted",
    [
        ([(0, 0), (1, 1), (2, 2)], [(1, 1, 1, 1)] * 3),
        (MIXED, [(2 / 3, 2 / 4, 4 / 7, 4), (2 / 3, 2 / 3, 2 / 3, 3), (0, 0, 0, 0)]),
        ([(0, 2)], [(0, 0, 0, 1), (0, 0, 0, 0), (0, 0, 0, 0)]),
        ([], [(0, 0, 0, 0)] * 3),
    ],
)
def test_class_report(spark, pairs, wanted):
    report = metrics.class_report(*tables(spark, pairs)).orderBy("label_idx").collect()
    assert [r.category for r in report] == NAMES
    for r, w in zip(report, wanted):
        assert (r.precision, r.recall, r.f1, r.support) == pytest.approx(w)


def test_averages(spark):
    rows = {r.average: r for r in metrics.report_averages(*tables(spark, MIXED)).collect()}
    assert rows["accuracy"].f1 == pytest.approx(4 / 7) and rows["accuracy"].support == 7
    assert rows["macro avg"].precision == pytest.approx((2 / 3 + 2 / 3 + 0) / 3)
    assert rows["weighted avg"].recall == pytest.approx((4 * 0.5 + 3 * 2 / 3) / 7)
    empty = metrics.report_averages(*tables(spark, [])).collect()
    assert all(r.f1 == 0 and r.support == 0 for r in empty)


@pytest.mark.parametrize("pairs, wanted", [(MIXED, (7, 4, 4 / 7)), ([], (0, 0, 0.0))])
def test_accuracy(spark, pairs, wanted):
    assert tuple(metrics.accuracy(tables(spark, pairs)[0]).first()) == pytest.approx(wanted)


def test_confusion(spark):
    predictions, labels = tables(spark, MIXED)
    cells = {(r.true_label_idx, r.predicted_label_idx): r.n for r in metrics.confusion_matrix(predictions, labels).collect()}
    assert len(cells) == 9 and cells[0, 0] == 2 and cells[1, 0] == 1 and cells[2, 2] == 0
    assert sum(cells.values()) == 6
    wide = metrics.confusion_wide(predictions, labels).orderBy("true_label_idx").collect()
    assert [tuple(r) for r in wide] == [(0, 2, 1, 0), (1, 1, 2, 0), (2, 0, 0, 0)]


def test_errors(spark):
    predictions, labels = tables(spark, MIXED)
    assert metrics.error_count(predictions).first().errors == 3
    assert metrics.misclassified(predictions).count() == 3
    sample = metrics.error_sample(predictions, labels, 2).orderBy("example").collect()
    assert [tuple(r) for r in sample] == [
        (1, 1, "text 1...", "World", "Sports"),
        (2, 4, "text 4...", "Sports", "World"),
    ]
    last = metrics.error_sample(predictions, labels, 5).orderBy("example").collect()[-1]
    assert (last.example, last.predicted_category) == (3, "Unknown")


def test_distribution(spark):
    rows = [("a", 0.75), ("a", 0.9), ("b", 0.7499), ("c", 1.0), ("Invalid/Empty", 0.0)]
    results = spark.createDataFrame(rows, "predicted_category string, confidence double")
    assert [tuple(r) for r in metrics.category_distribution(results).collect()] == [("a", 2), ("c", 1)]
    everything = {r.predicted_category: r["count"] for r in metrics.category_distribution(results, 0.0).collect()}
    assert everything["Invalid/Empty"] == 1 and sum(everything.values()) == 5
