"""Temperatures and calibration error by hand."""

import math
import random

import pytest
from pyspark.sql import functions as F

from newsloom.operators import calibration, labels

SCORES = "label_idx int, logs array<double>"


def rows_of(seed=1, count=80):
    rng = random.Random(seed)
    rows = []
    for _ in range(count):
        logs = [rng.gauss(0, 40) for _ in range(3)]
        best = max(range(3), key=logs.__getitem__)
        rows.append((best if rng.random() < 0.7 else rng.randrange(3), logs))
    return rows


def loss_by_hand(label, logs, temperature):
    known = [v / temperature for v in logs if v is not None]
    top = max(known)
    return top + math.log(sum(math.exp(v - top) for v in known)) - logs[label] / temperature


def test_losses_by_hand(spark):
    rows = rows_of()
    losses = calibration.temperature_losses(spark.createDataFrame(rows, SCORES))
    found = {r.temperature: (r.rows, r.loss) for r in losses.collect()}
    assert set(found) == set(calibration.TEMPERATURES)
    wanted = {t: sum(loss_by_hand(i, logs, t) for i, logs in rows) / len(rows) for t in found}
    assert all(found[t][0] == 80 and found[t][1] == pytest.approx(wanted[t]) for t in found)
    best = calibration.best_temperature(losses)
    assert best == min(wanted, key=wanted.get) and best > 8


def test_rows_that_no_temperature_changes(spark):
    rows = [(0, [None, 1.0, 2.0]), (None, [1.0, 2.0, 3.0]), (2, [None, 5.0, 6.0])]
    losses = calibration.temperature_losses(spark.createDataFrame(rows, SCORES)).collect()
    assert {r.rows for r in losses} == {1}
    one = next(r for r in losses if r.temperature == 1)
    assert one.loss == pytest.approx(loss_by_hand(2, [None, 5.0, 6.0], 1))
    assert calibration.best_temperature(calibration.temperature_losses(spark.createDataFrame([], SCORES))) == 1.0
    equal = spark.createDataFrame([(0, [1.0, 1.0])], SCORES)
    assert calibration.best_temperature(calibration.temperature_losses(equal)) == calibration.TEMPERATURES[0]


def test_error_by_hand(spark):
    rows = [(0.95, True), (0.91, False), (0.35, False), (1.0, True), (0.3, True), (0.0, False)]
    bins = calibration.reliability(spark.createDataFrame(rows, "confidence double, is_right boolean"))
    found = {r.bin: (r.rows, round(r.confidence, 6), round(r.accuracy, 6)) for r in bins.collect()}
    assert found == {9: (3, 0.953333, 0.666667), 3: (2, 0.325, 0.5), 0: (1, 0.0, 0.0)}
    error = calibration.calibration_error(bins).first()
    assert error.rows == 6 and error.error == pytest.approx((3 * (0.953333 - 0.666667) + 2 * 0.175) / 6, abs=1e-5)
    assert calibration.calibration_error(bins.limit(0)).first().error == 0


def test_a_label_map_grows(spark):
    known = spark.createDataFrame([("b", 0), ("gone", 1)], "category string, label_idx int")
    fresh = spark.createDataFrame([("z", 0), ("b", 1), ("a", 2)], "category string, label_idx int")
    grown = labels.grow_label_map(known, fresh)
    assert {r.category: r.label_idx for r in grown.collect()} == {"b": 0, "gone": 1, "z": 2, "a": 3}
    assert labels.grow_label_map(known.limit(0), fresh).filter(F.col("category") == "z").first().label_idx == 0
    assert labels.grow_label_map(grown, fresh).count() == 4
