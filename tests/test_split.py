import hashlib

import pytest
from pyspark.sql import functions as F

from newsloom.operators.split import cut_points, mark_validation, quotas, split_sizes, stratified_split


@pytest.mark.parametrize(
    "sizes, ratio, wanted",
    [
        ((7, 3), (1, 10), (1, 0)),
        ((10, 10, 10), (1, 10), (1, 1, 1)),
        ((1, 9), (1, 10), (0, 1)),
        ((95, 5), (1, 10), (10, 0)),
        ((1, 1), (1, 1), (0, 0)),
        ((50, 30, 20), (1, 4), (13, 7, 5)),
        ((4,), (3, 4), (3,)),
    ],
)
def test_quotas(spark, sizes, ratio, wanted):
    rows = spark.createDataFrame([(f"c{i}", n) for i, n in enumerate(sizes)], "category string, rows long")
    got = {r.category: r.quota for r in quotas(rows, *ratio).collect()}
    assert tuple(got[f"c{i}"] for i in range(len(sizes))) == wanted


def expected(rows, num, den, seed):
    groups = {}
    for row_id, category in rows:
        groups.setdefault(category, []).append(row_id)
    total = -(-len(rows) * num // den)
    base = {c: len(ids) * num // den for c, ids in groups.items()}
    spare = total - sum(base.values())
    for c in sorted(groups, key=lambda c: (-(len(groups[c]) * num % den), c))[:spare]:
        base[c] += 1
    chosen = set()
    for c, ids in groups.items():
        ranked = sorted(ids, key=lambda i: (hashlib.md5(f"{seed}:{i}".encode()).hexdigest(), i))
        chosen |= set(ranked[: min(base[c], len(ids) - 1)])
    return chosen


@pytest.mark.parametrize("ratio, seed, ranked", [((1, 10), 42, 500_000), ((1, 3), 7, 500_000), ((1, 10), 42, 1)])
def test_split_is_exact_and_stable(spark, monkeypatch, ratio, seed, ranked):
    """A low bound on ranked rows makes the prefixes grow."""
    monkeypatch.setattr("newsloom.operators.split.RANKED_ROWS", ranked)
    rows = [(i, "big" if i % 3 else ("mid" if i % 2 else "tiny" if i % 500 == 0 else "low")) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, category string")
    first = stratified_split(df, *ratio, seed)
    again = stratified_split(df.repartition(7, F.rand(3)), *ratio, seed)
    picked = {r.id for r in first.filter("is_val").collect()}
    assert picked == expected(rows, *ratio, seed)
    assert picked == {r.id for r in again.filter("is_val").collect()}
    sizes = {r.is_val: r.rows for r in split_sizes(first).collect()}
    assert sizes == {True: len(picked), False: 3000 - len(picked)}


def test_single_row_label_trains_and_null_label_is_no_validation(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)] + [(i, "b") for i in range(3, 30)], "id long, category string")
    marks = {r.id: r.is_val for r in mark_validation(df, cut_points(df)).collect()}
    assert len(marks) == 29 and not marks[1] and not marks[2]
