"""Training by epochs against a version written out by hand, stopping and going on, and the store of versions."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsloom import model_store
from newsloom.operators import epochs
from newsloom.operators.epochs import Schedule

WORDS = [["goal", "match", "team"], ["bank", "stock", "profit"], ["rocket", "moon", "chip"]]


def articles(spark, count=90, seed=4):
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        label = rng.randrange(3)
        words = [rng.choice(WORDS[label]) if rng.random() < 0.6 else f"w{rng.randrange(30)}" for _ in range(rng.randrange(1, 12))]
        rows.append((i, label, " ".join(words)))
    return spark.createDataFrame(rows, "id long, label_idx int, cleaned_text string")


def by_hand(rows, weights, epoch, schedule, sizes):
    """One epoch with dense vectors and plain loops; `rows` are (shard, order, key, label, dense vector)."""
    mean = np.zeros_like(weights)
    for shard, size in sizes.items():
        own = weights.copy()
        mine = sorted((r for r in rows if r[0] == shard), key=lambda r: (r[1], r[2]))
        each = -(-size // schedule.batch)
        steps, warmup = each * schedule.epochs, each * schedule.epochs // 10
        for at in range(0, size, schedule.batch):
            step = each * (epoch - 1) + at // schedule.batch
            rate = schedule.rate * ((step + 1) / warmup if step < warmup else (steps - step) / max(1, steps - warmup))
            change = np.zeros_like(own)
            batch = mine[at : at + schedule.batch]
            for _, _, _, label, x in batch:
                logits = own @ x
                p = np.exp(logits - logits.max())
                p /= p.sum()
                p[label] -= 1
                change += np.outer(p, x)
            own = own * (1 - rate * schedule.decay) - rate / len(batch) * change
        mean += own * size / sum(sizes.values())
    return mean


@pytest.fixture(scope="module")
def prepared(spark):
    train = articles(spark)
    fitted = epochs.feature_pipeline(64).fit(train)
    return epochs.vectors(train.select("label_idx", "cleaned_text"), fitted).drop("cleaned_text")


@pytest.mark.parametrize("shards", [1, 3])
def test_an_epoch_by_hand(spark, prepared, shards):
    schedule = Schedule(epochs=2, batch=4, rate=1.5, shards=shards, decay=0.01)
    dealt = epochs._dealt(prepared, schedule)
    sizes = {r.shard: r["count"] for r in dealt.groupBy("shard").count().collect()}
    weights, wanted = np.zeros((3, 65)), np.zeros((3, 65))
    for number in (1, 2):
        order = F.xxhash64("key", F.lit(number)).alias("order")
        rows = []
        for r in dealt.select("shard", order, "key", "label_idx", "cells", "amounts").collect():
            x = np.zeros(65)
            x[r.cells] = r.amounts
            x[64] = 1
            rows.append((r.shard, r.order, r.key, r.label_idx, x))
        wanted = by_hand(rows, wanted, number, schedule, sizes)
        weights = epochs.run_epoch(dealt, sizes, weights, number, schedule)
        assert np.allclose(weights, wanted, atol=1e-9)
    assert np.abs(weights).max() > 0.1


def test_same_weights_however_rows_are_dealt_to_tasks(spark, prepared):
    schedule = Schedule(batch=4, shards=3)
    found = []
    for parts, batch in ((1, 7), (5, 1000)):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
        dealt = epochs._dealt(prepared.repartition(parts), schedule)
        sizes = {r.shard: r["count"] for r in dealt.groupBy("shard").count().collect()}
        found.append(epochs.run_epoch(dealt, sizes, np.zeros((3, 65)), 1, schedule))
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert np.array_equal(*found)


@pytest.mark.parametrize("sections", [2, 7, 200])
def test_same_weights_in_sections(spark, prepared, sections):
    schedule = Schedule(batch=4, shards=3)
    copies = prepared.unionAll(prepared.limit(5)).unionAll(prepared.limit(5))
    dealt = epochs._dealt(copies, schedule)
    sizes = {r.shard: r["count"] for r in dealt.groupBy("shard").count().collect()}
    whole = epochs.run_epoch(dealt, sizes, np.zeros((3, 65)), 1, schedule)
    if sections > 7:  # more than there are rows in a shard
        dealt = epochs._dealt(prepared.limit(9), schedule)
        sizes = {r.shard: r["count"] for r in dealt.groupBy("shard").count().collect()}
        whole, sections = epochs.run_epoch(dealt, sizes, np.zeros((3, 65)), 1, schedule), 12
    assert np.array_equal(whole, epochs.run_epoch(dealt, sizes, np.zeros((3, 65)), 1, schedule, sections))


def test_a_task_has_one_shard(spark, prepared, monkeypatch):
    schedule = Schedule(batch=4, shards=8)
    dealt = epochs._dealt(prepared, schedule)
    sizes = {r.shard: r["count"] for r in dealt.groupBy("shard").count().collect()}
    inner = epochs._train_rows

    def watched(*args):
        run = inner(*args)

        def alone(source):
            found = list(source)
            assert len({shard for batch in found for shard in batch.column(0).to_pylist()}) <= 1
            yield from run(iter(found))

        return alone

    monkeypatch.setattr(epochs, "_train_rows", watched)
    epochs.run_epoch(dealt, sizes, np.zeros((3, 65)), 1, schedule)


def test_large_shards_are_trained_in_sections(spark, tmp_path, monkeypatch):
    train, held_out = articles(spark), articles(spark, 40, 9)
    schedule, names, used = Schedule(epochs=2, batch=4, shards=2), ["Sports", "Business", "Science"], []
    whole = epochs.train(train, held_out, names, str(tmp_path / "whole"), schedule, 256)
    run = epochs.run_epoch
    monkeypatch.setattr(epochs, "run_epoch", lambda *a: used.append(a[-1]) or run(*a))
    monkeypatch.setattr(epochs, "SECTION_BYTES", 2000, raising=False)
    cut = epochs.train(train, held_out, names, str(tmp_path / "cut"), schedule, 256)
    assert np.array_equal(whole.weights, cut.weights) and used[0] == used[1] > 1


def test_a_stopped_run_goes_on(spark, tmp_path):
    train, held_out = articles(spark), articles(spark, 40, 9)
    schedule = Schedule(epochs=3, batch=4, shards=2)
    names = ["Sports", "Business", "Science"]
    whole = epochs.train(train, held_out, names, str(tmp_path / "whole"), schedule, 256)
    broken = str(tmp_path / "broken")
    epochs.train(train, held_out, names, broken, schedule, 256, until=1)
    assert [e.number for e in epochs.history(spark, broken)] == [1]
    # A run that dies while it writes its second epoch leaves a folder that nothing reads.
    (tmp_path / "broken" / "epochs" / "versions" / "half").mkdir()
    again = epochs.train(train, held_out, names, broken, schedule, 256)
    assert [e.number for e in epochs.history(spark, broken)] == [1, 2, 3]
    assert np.array_equal(again.weights, whole.weights) and again.epoch == whole.epoch
    figures = [[(e.accuracy, e.loss) for e in epochs.history(spark, p)] for p in (broken, str(tmp_path / "whole"))]
    assert np.allclose(*figures)
    with pytest.raises(ValueError, match="other settings"):
        epochs.train(train, held_out, names, broken, Schedule(epochs=3, batch=8, shards=2), 256)
    predicted = epochs.predict(held_out, whole)
    right = predicted.filter("predicted_label_idx = label_idx").count()
    assert right / 40 == max(e.accuracy for e in epochs.history(spark, broken)) > 0.8
    assert all(sum(r.probabilities) == pytest.approx(1) for r in predicted.collect())


def test_odd_rows(spark, tmp_path):
    rows = [(1, 0, "goal team"), (2, None, "x"), (3, 1, ""), (4, 1, None), (None, 2, "moon moon"), (None, 2, "moon moon")]
    odd = spark.createDataFrame(rows, "id long, label_idx int, cleaned_text string")
    model = epochs.train(odd, odd, ["a", "b", "c"], str(tmp_path / "odd"), Schedule(shards=2), 32)
    assert [r.id for r in epochs.predict(odd, model).collect()] == [1, 2, 3, 4, None, None]
    nothing = epochs.train(odd.limit(0), odd, ["a", "b", "c"], str(tmp_path / "none"), Schedule(shards=2), 32)
    assert all(r.probabilities == pytest.approx([1 / 3] * 3) for r in epochs.predict(odd, nothing).collect())
    assert epochs.predict(odd.limit(0), model).count() == 0


def test_best_is_the_earlier_among_equals():
    found = [epochs.Epoch(i + 1, a, 0.0, "") for i, a in enumerate([0.5, 0.9, 0.9, 0.7])]
    assert epochs.best_of(found).number == 2


def test_the_rate_rises_and_falls():
    schedule = Schedule(rate=1.0, warmup=4)
    rates = [epochs.rate_at(i, 20, schedule) for i in range(20)]
    assert rates[:4] == [0.25, 0.5, 0.75, 1.0] and rates[4] == 1.0 and rates[-1] == 1 / 16
    assert all(a >= b for a, b in zip(rates[3:], rates[4:], strict=False))


# --- versions ---------------------------------------------------------------


def test_a_failed_save_changes_nothing(spark, tmp_path):
    folder = str(tmp_path / "store")
    assert model_store.latest(spark, folder) is None and model_store.resolve(spark, folder) == folder
    first = model_store.save(spark, folder, lambda path: spark.range(3).write.parquet(f"{path}/words"))

    def half(path):
        spark.range(9).write.parquet(f"{path}/words")
        raise RuntimeError("lost")

    reader = spark.read.parquet(f"{model_store.resolve(spark, folder)}/words")
    with pytest.raises(RuntimeError):
        model_store.save(spark, folder, half)
    assert model_store.latest(spark, folder) == first
    second = model_store.save(spark, folder, lambda path: spark.range(5).write.parquet(f"{path}/words"))
    assert second.number == 2 and reader.count() == 3
    assert spark.read.parquet(f"{model_store.resolve(spark, folder)}/words").count() == 5
    assert model_store.retire(spark, folder, 5) == 0 and model_store.retire(spark, folder, 1) == 1
    assert [v.number for v in model_store.versions(spark, folder)] == [2]
    assert spark.read.parquet(f"{second.path}/words").count() == 5
