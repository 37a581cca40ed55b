import random

import pytest
from pyspark.sql import functions as F

from newsloom.operators.batches import assign_batches, batch_progress
from newsloom.operators.positions import first_n, nth_smallest, positions


@pytest.fixture(scope="module")
def wild_keys():
    rng = random.Random(5)
    keys = {rng.randrange(-(2**63), 2**63) for _ in range(200)} | set(range(1000, 1300)) | {-(2**63), 2**63 - 1, 0}
    return sorted(keys)


def test_nth_smallest(spark, wild_keys):
    df = spark.createDataFrame([(k,) for k in wild_keys], "k long").repartition(5)
    for n in (1, 2, 100, 150, 333, len(wild_keys), len(wild_keys) + 9):
        assert nth_smallest(df, "k", n) == wild_keys[min(n, len(wild_keys)) - 1]
    assert nth_smallest(df.limit(0), "k", 3) is None


def test_first_n(spark):
    df = spark.range(0, 500).repartition(6)
    assert sorted(r.id for r in first_n(df, 7).collect()) == list(range(7))
    large = first_n(df, 300)
    assert "TakeOrdered" not in large._jdf.queryExecution().executedPlan().toString()
    assert sorted(r.id for r in large.collect()) == list(range(300))
    assert first_n(df, 0) is df and first_n(df, None) is df
    assert first_n(df, 900).count() == 500


@pytest.mark.parametrize("kind", ["long", "string", "double"])
def test_first_n_of_repeated_and_missing_keys(spark, kind):
    keys = [1, 1, 1, 2, 3, 3, None, None, None, 5]
    rows = [(k, i) for i, k in enumerate(keys)]
    df = spark.createDataFrame(rows, "k long, i long").repartition(3).withColumn("k", F.col("k").cast(kind))
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    for n in range(1, 12):
        assert sorted(r.i for r in first_n(df, n, "k").collect()) == sorted(i for _, i in order[:n]), n
    assert first_n(df.limit(0), 3, "k").count() == 0


def test_positions(spark, wild_keys):
    df = spark.createDataFrame([(k,) for k in wild_keys], "k long").repartition(5)
    got = {r.k: r.position for r in positions(df, "k").collect()}
    assert got == {k: i for i, k in enumerate(wild_keys)}


@pytest.mark.parametrize("rows", [1, 9, 10, 11, 25, 99, 137])
def test_batches(spark, rows):
    numpy = pytest.importorskip("numpy")
    assigned = assign_batches(spark.range(rows).repartition(3))
    wanted = numpy.array_split(list(range(rows)), max(1, rows // 10))
    got = {}
    for r in assigned.collect():
        got.setdefault(r.batch, []).append(r.id)
    assert [sorted(got[b]) for b in sorted(got)] == [list(w) for w in wanted]
    done = [r.done for r in batch_progress(assigned).orderBy("batch").collect()]
    assert done == [int(n) for n in numpy.cumsum([len(w) for w in wanted])]


def test_batches_of_nothing(spark):
    assert assign_batches(spark.range(0)).count() == 0


def test_no_window_over_the_rows(spark):
    plan = positions(spark.range(1000))._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window") :]
    assert "Aggregate" in window.split("\n")[1] or "Aggregate" in window.split("\n")[2]
    assert F is not None
