"""A linear classifier trained by epochs of mini-batches, in Spark tasks.

Training rows are dealt into shards by a hash of what they hold. In an epoch every shard
starts from the same weights and goes through its rows in an order of its own, batch
by batch, with a warm-up, a linear decay of the rate and decay of the weights; at the end
the shards' weights are averaged by their numbers of rows. Changes are summed as
whole numbers, and shards do not depend on how Spark deals rows to tasks, so a fit
gives the same weights on any number of tasks and in any run. A shard of many rows goes
through several tasks, one section of its order after another, and hands on where it stands.

Every epoch is published with its accuracy on the validation rows. A run that was
stopped goes on after the last published epoch, and the best epoch is served.
"""

from __future__ import annotations

import json
import pickle
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom import model_store
from newsloom.operators.pipeline import HASH_FEATURES, feature_pipeline
from newsloom.staging import new_path, scope, stage

#: Changes of weights are summed in units of 2**-40.
UNIT = 1 << 40
VECTORS = "label_idx int, cells array<int>, amounts array<double>"
#: Bytes of a shard's rows that a task reads at most, but for hash luck and copies of one row.
SECTION_BYTES = 64 << 20


@dataclass(frozen=True)
class Schedule:
    """How to train: `epochs` over all rows in batches of `batch` rows, in `shards` shards side by side.

    The rate rises over the first `warmup` steps of a shard (a tenth of its steps if None) and falls
    linearly to nothing at its last step; `decay` of the weights is taken off at the rate of each step.
    """

    epochs: int = 3
    batch: int = 16
    rate: float = 2.0
    warmup: int | None = None
    decay: float = 0.0001
    shards: int = 8
    seed: int = 42


@dataclass(frozen=True)
class EpochModel:
    """Weights per class, the last column the bias, and the pipeline that makes the features."""

    features: PipelineModel
    weights: np.ndarray
    categories: list[str]
    epoch: int


@dataclass(frozen=True)
class Epoch:
    number: int
    accuracy: float
    loss: float
    path: str


def vectors(rows: DataFrame, features: PipelineModel) -> DataFrame:
    """`(…, cells, amounts)`: the cells of each row's weighted words, scaled to length 1; none for a text without words."""
    made = features.transform(rows.withColumn("cleaned_text", F.coalesce("cleaned_text", F.lit(""))))
    parts = made.withColumn("_parts", F.unwrap_udt("features"))
    length = F.sqrt(F.aggregate("_parts.values", F.lit(0.0), lambda total, v: total + v * v))
    amounts = F.transform("_parts.values", lambda v: F.when(F.col("_length") > 0, v / F.col("_length")).otherwise(0.0))
    kept = parts.withColumn("_length", length)
    return kept.select(*rows.columns, F.col("_parts.indices").alias("cells"), amounts.alias("amounts"))


def rate_at(step: int, steps: int, schedule: Schedule) -> float:
    """The rate of a step, counted from 0 over all epochs of a shard."""
    warmup = steps // 10 if schedule.warmup is None else schedule.warmup
    if step < warmup:
        return schedule.rate * (step + 1) / warmup
    return schedule.rate * (steps - step) / max(1, steps - warmup)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(zero_copy_only=False), sizes


def _softmax(logits: np.ndarray) -> np.ndarray:
    powers = np.exp(logits - logits.max(axis=0))
    return powers / powers.sum(axis=0)


def _logits(weights: np.ndarray, cells: np.ndarray, amounts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Classes × rows, without the bias."""
    rows = np.repeat(np.arange(len(sizes)), sizes)
    return np.stack([np.bincount(rows, w[cells] * amounts, len(sizes)) for w in weights])


class _Shard:
    """The weights of one shard while it goes through its rows; `scale` holds what decay has taken off all of them.

    `waiting` are the rows of a batch that is not full yet, out of the `seen` ones.
    """

    def __init__(self, start: np.ndarray, rows: int, epoch: int, schedule: Schedule):
        self.weights, self.start, self.schedule, self.scale = start.copy(), start, schedule, 1.0
        each = -(-rows // schedule.batch)
        self.step, self.steps = each * (epoch - 1), each * schedule.epochs
        self.rows, self.seen, self.waiting = rows, 0, []

    def packed(self) -> bytes:
        """Where it stands, for the task that goes on."""
        return pickle.dumps((self.weights, self.scale, self.step, self.seen, self.waiting))

    def unpack(self, state: bytes) -> None:
        self.weights, self.scale, self.step, self.seen, self.waiting = pickle.loads(state)

    def take(self, label: int, cells: np.ndarray, amounts: np.ndarray) -> None:
        """One more row; a full batch is learned, and the last one as it is."""
        self.waiting.append((label, cells, amounts))
        self.seen += 1
        if len(self.waiting) == self.schedule.batch or self.seen == self.rows:
            labels, parts, values = zip(*self.waiting, strict=True)
            sizes = np.array([len(c) for c in parts])
            self.learn(np.array(labels), np.concatenate(parts), np.concatenate(values), sizes)
            self.waiting = []

    def learn(self, labels: np.ndarray, cells: np.ndarray, amounts: np.ndarray, sizes: np.ndarray) -> None:
        rate = rate_at(self.step, self.steps, self.schedule)
        logits = self.scale * (_logits(self.weights, cells, amounts, sizes) + self.weights[:, -1:])
        errors = _softmax(logits)
        errors[labels, np.arange(len(labels))] -= 1
        self.scale *= 1 - rate * self.schedule.decay
        change = -rate / len(labels) / self.scale * errors
        spread = np.repeat(change, sizes, axis=1) * amounts
        for weights, amount, bias in zip(self.weights, spread, change.sum(axis=1), strict=True):
            np.add.at(weights, cells, amount)
            weights[-1] += bias
        self.step += 1

    def changes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Class, cell and change of every weight that was touched."""
        label, cell = np.nonzero(self.weights != self.start)
        return label, cell, (self.weights[label, cell] - self.start[label, cell]) * self.scale


def _train_rows(start, sizes: dict[int, int], epoch: int, schedule: Schedule, ends: bool):
    """A task's shards, whose rows come one after another; batches run across what Spark hands over.

    A row with a `state` comes first and says where the shard stands. What the shard has changed comes out if the
    epoch `ends` with these rows, else its state.
    """
    total = sum(sizes.values())

    def results(shard: int, state: _Shard) -> pa.RecordBatch:
        if not ends:
            arrays = [pa.array([shard], pa.int32()), pa.array([state.packed()], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, names=["shard", "state"])
        share = sizes[shard] / total
        label, cell, change = state.changes()
        label, cell = np.append(label, -1), np.append(cell, -1)
        units = np.rint(np.append(change, state.scale) * share * UNIT).astype(np.int64)
        arrays = [pa.array(label, pa.int32()), pa.array(cell, pa.int32()), pa.array(units)]
        return pa.RecordBatch.from_arrays(arrays, names=["label", "cell", "units"])

    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        for batch in source:
            shards, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            cells, counts = _flat(batch.column(2))
            amounts, _ = _flat(batch.column(3))
            stops = np.cumsum(counts)
            for i, shard in enumerate(shards):
                if shard != current:
                    if state is not None:
                        yield results(current, state)
                    current, state = shard, _Shard(start.value, sizes[shard], epoch, schedule)
                if batch.column(4)[i].is_valid:
                    state.unpack(batch.column(4)[i].as_py())
                    continue
                inside = slice(stops[i] - counts[i], stops[i])
                state.take(labels[i], cells[inside], amounts[inside])
        if state is not None:
            yield results(current, state)

    return run


def _dealt(rows: DataFrame, schedule: Schedule) -> DataFrame:
    """`rows` with their shard and a key that orders them; equal rows have equal keys."""
    key = F.xxhash64("label_idx", "cells", "amounts", F.lit(schedule.seed))
    return rows.select("label_idx", "cells", "amounts", key.alias("key")).withColumn(
        "shard", F.pmod(F.xxhash64("key"), F.lit(schedule.shards)).cast("int")
    )


def _sections(most: int) -> int:
    """Into how many sections shards of up to `most` bytes are cut."""
    return max(1, -(-most // SECTION_BYTES))


def run_epoch(
    dealt: DataFrame, sizes: dict[int, int], weights: np.ndarray, epoch: int, schedule: Schedule, sections: int = 1
) -> np.ndarray:
    """The weights after one more epoch. What comes back is of the size of the weights, whatever the number of rows.

    With more `sections` than one, every shard goes through its rows in as many tasks, in the same order and batches: rows
    are written by section, and one section after another starts from the states that the one before has left.
    """
    spark = dealt.sparkSession
    start = spark.sparkContext.broadcast(weights)
    rows = dealt.withColumn("order", F.xxhash64("key", F.lit(epoch)))

    def trained(part: DataFrame, ends: bool) -> DataFrame:
        part = part.repartitionById(schedule.shards, F.col("shard")).sortWithinPartitions("shard", "order", "key")
        part = part.select("shard", "label_idx", "cells", "amounts", "state")
        made = "label int, cell int, units long" if ends else "shard int, state binary"
        return part.mapInArrow(_train_rows(start, sizes, epoch, schedule, ends), made)

    with scope(spark):
        if sections > 1:
            place = F.shiftright("order", 32) + F.lit(1 << 31)  # of 2**32, in the order of `order`
            path = new_path(spark, "epoch-rows")
            by_section = rows.withColumn("section", F.shiftright(place * sections, 32).cast("int"))
            by_section.write.partitionBy("section").parquet(path)
            rows = spark.read.schema(by_section.schema).parquet(path)
        states = None
        for section in range(sections):
            part = rows.filter(F.col("section") == section).drop("section") if sections > 1 else rows
            part = part.withColumn("state", F.lit(None).cast("binary"))
            if states is not None:  # no order comes before any
                part = part.unionByName(states, allowMissingColumns=True)
            found = trained(part, section == sections - 1)
            if section < sections - 1:
                states = stage(found, "epoch-states")
        summed = found.groupBy("label", "cell").agg(F.sum("units").alias("units")).toPandas()
    start.destroy()
    changed = summed[summed.label >= 0]
    scale = summed[summed.label < 0].units.sum() / UNIT
    after = weights * scale
    np.add.at(after, (changed.label.to_numpy(), changed.cell.to_numpy()), changed.units.to_numpy() / UNIT)
    return after


def _save_epoch(spark: SparkSession, folder: str, number: int, weights: np.ndarray, accuracy: float, loss: float, about: str) -> None:
    def write(path: str) -> None:
        rows = [(i, w.tolist()) for i, w in enumerate(weights)]
        spark.createDataFrame(rows, "label_idx int, weights array<double>").write.parquet(f"{path}/weights")
        state = spark.createDataFrame([(number, accuracy, loss, about)], "epoch int, accuracy double, loss double, about string")
        state.coalesce(1).write.parquet(f"{path}/state")

    model_store.save(spark, folder, write)


def history(spark: SparkSession, path: str) -> list[Epoch]:
    """The published epochs of a training folder, in order."""
    found = []
    for version in model_store.versions(spark, f"{path}/epochs"):
        state = spark.read.parquet(f"{version.path}/state").first()
        found.append(Epoch(state.epoch, state.accuracy, state.loss, version.path))
    return found


def _weights(spark: SparkSession, epoch: Epoch) -> np.ndarray:
    rows = spark.read.parquet(f"{epoch.path}/weights").collect()  # one row per class
    return np.array([r.weights for r in sorted(rows, key=lambda r: r.label_idx)])


def best_of(epochs: list[Epoch]) -> Epoch:
    """The most accurate epoch, the earlier among equals."""
    return max(epochs, key=lambda e: (e.accuracy, -e.number))


def train(
    training: DataFrame,
    validation: DataFrame,
    categories: list[str],
    path: str,
    schedule: Schedule = Schedule(),
    features: int = HASH_FEATURES,
    until: int | None = None,
) -> EpochModel:
    """Train on `(label_idx, cleaned_text)` under `path`, which should be new or hold a run that was stopped.

    Features are fitted and rows turned to vectors once. Each epoch is published
    when its weights and its figures on the validation rows are written; a later call with the same
    arguments goes on after the last one. `until` stops after an epoch of that number. Rows
    without a label or words are left out of training; without any training rows all classes are as likely.
    """
    spark = training.sparkSession
    about = json.dumps({**asdict(schedule), "features": features, "categories": categories}, sort_keys=True)
    prepared = model_store.latest(spark, f"{path}/features")
    if prepared is None:
        usable = training.filter(F.col("label_idx").isNotNull() & (F.col("cleaned_text") != ""))

        def write(folder: str) -> None:
            nothing = spark.createDataFrame([("",)], "cleaned_text string")  # word weights need a row to be fitted
            fitted = feature_pipeline(features).fit(nothing if usable.isEmpty() else usable)
            fitted.write().save(f"{folder}/pipeline")
            vectors(usable.select("label_idx", "cleaned_text"), fitted).drop("cleaned_text").write.parquet(f"{folder}/training")
            known = validation.filter("cleaned_text IS NOT NULL").select("label_idx", "cleaned_text")
            vectors(known, fitted).drop("cleaned_text").write.parquet(f"{folder}/validation")

        prepared = model_store.save(spark, f"{path}/features", write)
    fitted = PipelineModel.load(f"{prepared.path}/pipeline")
    dealt = _dealt(spark.read.schema(VECTORS).parquet(f"{prepared.path}/training"), schedule)
    held_out = spark.read.schema(VECTORS).parquet(f"{prepared.path}/validation")
    held = F.sum(12 * F.size("cells") + 32).alias("bytes")
    shards = dealt.groupBy("shard").agg(F.count("*").alias("rows"), held).collect()  # one row per shard
    sizes, sections = {r.shard: r.rows for r in shards}, _sections(max((r.bytes for r in shards), default=0))

    done = history(spark, path)
    for epoch in done:
        if spark.read.parquet(f"{epoch.path}/state").first().about != about:
            raise ValueError(f"'{path}' holds a run with other settings")
    weights = _weights(spark, done[-1]) if done else np.zeros((len(categories), features + 1))
    for number in range(len(done) + 1, min(schedule.epochs, until or schedule.epochs) + 1):
        if sizes:
            weights = run_epoch(dealt, sizes, weights, number, schedule, sections)
        accuracy, loss = _figures(held_out, weights)
        _save_epoch(spark, f"{path}/epochs", number, weights, accuracy, loss, about)
    return load(spark, path)


def load(spark: SparkSession, path: str) -> EpochModel:
    """The best epoch that a training folder holds."""
    best = best_of(history(spark, path))
    about = json.loads(spark.read.parquet(f"{best.path}/state").first().about)
    prepared = model_store.latest(spark, f"{path}/features")
    return EpochModel(PipelineModel.load(f"{prepared.path}/pipeline"), _weights(spark, best), about["categories"], best.number)


def probabilities(rows: DataFrame, weights: np.ndarray) -> DataFrame:
    """`rows` of `(…, cells, amounts)` with `probabilities`."""
    shared = rows.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("array<double>")
    def likely(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        known = shared.value
        for cells, amounts in batches:
            sizes = cells.str.len().to_numpy()
            flat = np.concatenate([*cells, np.empty(0, dtype=np.int32)]).astype(np.int64)
            values = np.concatenate([*amounts, np.empty(0)])
            yield pd.Series(list(_softmax(_logits(known, flat, values, sizes) + known[:, -1:]).T))

    return rows.withColumn("probabilities", likely("cells", "amounts"))


def _figures(held_out: DataFrame, weights: np.ndarray) -> tuple[float, float]:
    """Accuracy and mean logarithmic loss; a row whose label the model does not know counts as wrong and has no loss."""
    scored = probabilities(held_out, weights)
    own = F.try_element_at("probabilities", F.col("label_idx") + 1)
    best = F.array_position("probabilities", F.array_max("probabilities")) - 1
    right = F.coalesce((best == F.col("label_idx")).cast("double"), F.lit(0.0))
    found = scored.agg(F.avg(right).alias("accuracy"), F.avg(-F.ln(F.greatest(own, F.lit(1e-300)))).alias("loss")).first()
    return float(found.accuracy or 0.0), float(found.loss or 0.0)


def predict(articles: DataFrame, model: EpochModel) -> DataFrame:
    """Add `predicted_label_idx` and `probabilities` to cleaned articles, row by row."""
    made = probabilities(vectors(articles, model.features), model.weights)
    best = F.array_position("probabilities", F.array_max("probabilities")) - 1
    return made.select(*articles.columns, best.cast("int").alias("predicted_label_idx"), "probabilities")


def save(model: EpochModel, path: str) -> None:
    """Write a trained model to a folder of its own."""
    spark = SparkSession.active()
    model.features.write().save(f"{path}/pipeline")
    rows = [(i, name, model.epoch, model.weights[i].tolist()) for i, name in enumerate(model.categories)]
    kind = "label_idx int, category string, epoch int, weights array<double>"
    spark.createDataFrame(rows, kind).write.parquet(f"{path}/classes")


def load_saved(spark: SparkSession, path: str) -> EpochModel:
    rows = sorted(spark.read.parquet(f"{path}/classes").collect(), key=lambda r: r.label_idx)  # one row per class
    weights = np.array([r.weights for r in rows])
    return EpochModel(PipelineModel.load(f"{path}/pipeline"), weights, [r.category for r in rows], rows[0].epoch)
