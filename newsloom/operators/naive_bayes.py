"""Multinomial Naive Bayes: counts by Spark aggregation, scores beside the row.

Fitting reads the training text once: a count per (label, word), from which
everything else follows. Weights are log-probabilities in units of 1e-9, kept
as 64-bit integers, so sums of them are exact in any order and on any engine.

Scoring adds a column to the rows it is given: no id is needed and no text is
shuffled. Frequent words sit in a table of proven size that every worker gets;
when the vocabulary is larger, only the words that are not in it go through a join.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.operators.calibration import best_temperature, temperature_losses
from newsloom.operators.subwords import piece_counts, pieces_of, read_vocabulary
from newsloom.operators.vocabulary import label_word_counts, top_words
from newsloom.staging import new_path, stage

UNIT = 1_000_000_000
HOT_WORD_BYTES = 64
BROADCAST_BYTES = 64 * 1024 * 1024
#: Bytes of text whose words are scored at a time.
TEXT_AT_ONCE = 8 << 20


@dataclass(frozen=True)
class Candidate:
    """Settings of a fit: added count, words kept (None: all), words read per text (None: all).

    With `subwords`, the path of a tokenizer file, words are cut into its pieces, which then take their place.
    """

    smoothing: float = 1.0
    vocabulary_size: int | None = None
    most: int | None = None
    subwords: str | None = None


@dataclass(frozen=True)
class BayesModel:
    """A fitted model: three tables under `path`.

    `labels`: category, label_idx, articles, tokens, prior (one row per class).
    `words`: word, n, by_label map<label_idx, n> (one row per word). `weights` is
    `words` with log-probabilities in label order. `settings`: one row, the candidate and the
    temperature that its probabilities are taken at.
    """

    path: str
    categories: list[str]
    priors: list[int | None]
    labels: DataFrame
    words: DataFrame
    weights: DataFrame
    settings: Candidate
    temperature: float = 1.0


@dataclass(frozen=True)
class Choice:
    model: BayesModel
    candidate: Candidate
    accuracies: list[float]


def _log_units(ratio: Column) -> Column:
    return F.round(F.ln(ratio) * UNIT).cast("long")


def counted(train: DataFrame, most: int | None = None, subwords: str | None = None) -> DataFrame:
    """Written counts per label and word, or piece, of `(label_idx, cleaned_text)` rows.

    Rows without text or label say nothing and are left out: no text, no tokens.
    """
    counts = stage(label_word_counts(train.filter(F.col("label_idx").isNotNull()), most=most), "label-word-counts")
    return stage(piece_counts(counts, subwords), "label-piece-counts") if subwords else counts


def fit(
    train: DataFrame,
    labels: DataFrame,
    path: str | None = None,
    vocabulary_size: int | None = None,
    most: int | None = None,
    smoothing: float = 1.0,
    subwords: str | None = None,
) -> BayesModel:
    """Fit on whole texts and all words, unless told to cut them."""
    settings = Candidate(smoothing, vocabulary_size, most, subwords)
    return fit_counts(counted(train, most, subwords), labels, settings, path)


def fit_counts(counts: DataFrame, labels: DataFrame, settings: Candidate, path: str | None = None) -> BayesModel:
    """Fit on counts; several candidates can share them."""
    spark = counts.sparkSession
    path = path or new_path(spark, "bayes")
    entries = F.map_from_entries(F.collect_list(F.struct("label_idx", "n")))  # one entry per label at most
    words = counts.groupBy("word").agg(F.sum("n").alias("n"), entries.alias("by_label"))
    if settings.vocabulary_size is not None:
        words = top_words(stage(words, "words"), settings.vocabulary_size)
    words.write.mode("overwrite").parquet(f"{path}/words")
    words = spark.read.schema(words.schema).parquet(f"{path}/words")

    # One aggregation over the counts gives a label's articles and tokens, unless words were left out.
    sums = counts.groupBy("label_idx").agg(F.sum("first_words").alias("articles"), F.sum("n").alias("tokens"))
    if settings.vocabulary_size is not None:
        kept = words.select(F.explode("by_label").alias("label_idx", "n"))
        sums = sums.drop("tokens").join(kept.groupBy("label_idx").agg(F.sum("n").alias("tokens")), "label_idx", "left")
    # The window sees one row per label.
    everything = F.sum("articles").over(Window.partitionBy())
    label_table = (
        labels.join(sums, "label_idx", "left")
        .fillna(0, ["articles", "tokens"])
        .select(
            "category",
            "label_idx",
            "articles",
            "tokens",
            F.when(F.col("articles") > 0, _log_units(F.col("articles") / everything)).alias("prior"),
        )
    )
    label_table.write.mode("overwrite").parquet(f"{path}/labels")
    _write_settings(spark, path, settings, 1.0)
    return load(spark, path)


def _write_settings(spark: SparkSession, path: str, settings: Candidate, temperature: float) -> None:
    kept = (settings.smoothing, settings.vocabulary_size, settings.most, settings.subwords, temperature)
    kind = "smoothing double, vocabulary_size long, most int, subwords string, temperature double"
    row = spark.createDataFrame([kept], kind)
    row.coalesce(1).write.mode("overwrite").parquet(f"{path}/settings")


def load(spark: SparkSession, path: str) -> BayesModel:
    """Read a fitted model back."""
    labels, words = spark.read.parquet(f"{path}/labels"), spark.read.parquet(f"{path}/words")
    kept = spark.read.parquet(f"{path}/settings").first()
    settings = Candidate(kept.smoothing, kept.vocabulary_size, kept.most, kept.asDict().get("subwords"))
    rows = sorted(labels.collect(), key=lambda r: r.label_idx)  # one row per class
    size, added = words.count(), settings.smoothing
    totals = F.lit([float(r.tokens + added * size) for r in rows])
    weight = F.transform(
        totals,
        lambda total, i: _log_units((F.coalesce(F.try_element_at("by_label", i), F.lit(0)) + F.lit(added)) / total),
    )
    return BayesModel(
        path,
        [r.category for r in rows],
        [r.prior for r in rows],
        labels,
        words,
        words.select("word", "n", weight.alias("weight")),
        settings,
        kept.asDict().get("temperature", 1.0),
    )


def select_best(
    train: DataFrame, validation: DataFrame, labels: DataFrame, candidates: Sequence[Candidate]
) -> Choice:
    """Fit every candidate and keep the most accurate one, the earlier among equals.

    Candidates that read the same number of words share one pass over the text.
    """
    from newsloom.functions.scores import argmax

    counts: dict[tuple, DataFrame] = {}
    fitted, accuracies = [], []
    for candidate in candidates:
        read = (candidate.most, candidate.subwords)
        if read not in counts:
            counts[read] = counted(train, *read)
        model = fit_counts(counts[read], labels, candidate)
        right = (argmax(F.col("scores")) == F.col("label_idx")).cast("double")
        found = score(validation, model).agg(F.coalesce(F.avg(F.coalesce(right, F.lit(0.0))), F.lit(0.0)))
        fitted.append(model)
        accuracies.append(found.first()[0])
    best = max(range(len(candidates)), key=lambda i: (accuracies[i], -i))
    return Choice(fitted[best], candidates[best], accuracies)


def save(model: BayesModel, path: str) -> BayesModel:
    """Write a model's tables and settings to another place."""
    spark = model.labels.sparkSession
    for name in ("labels", "words"):
        spark.read.parquet(f"{model.path}/{name}").write.mode("overwrite").parquet(f"{path}/{name}")
    _write_settings(spark, path, model.settings, model.temperature)
    return load(spark, path)


def logs(scores: Column) -> Column:
    """Summed integer scores as logarithms; NULL stays NULL."""
    return F.transform(scores, lambda s: s / F.lit(float(UNIT)))


def calibrated(model: BayesModel, validation: DataFrame) -> BayesModel:
    """The model at the temperature under which the classes of held-out `(label_idx, cleaned_text)` rows are likeliest."""
    scored = score(validation, model).select(logs(F.col("scores")).alias("logs"), "label_idx")
    return replace(model, temperature=best_temperature(temperature_losses(scored)))


@dataclass(frozen=True)
class ReadyBayes:
    """A model whose frequent words every worker has; prepare it once and score many batches."""

    model: BayesModel
    shared: Broadcast
    cold: DataFrame | None

    @property
    def categories(self) -> list[str]:
        return self.model.categories

    @property
    def temperature(self) -> float:
        return self.model.temperature


def prepare(model: BayesModel) -> ReadyBayes:
    """Send the words that fit to all workers."""
    hot, cold = _hot_and_cold(model)
    table = hot.select("word", "weight").toArrow()  # its size is bounded by BROADCAST_BYTES
    words = table["word"].combine_chunks().cast(pa.string())
    weights = table["weight"].combine_chunks().flatten().to_numpy().reshape(len(words), len(model.categories))
    # The last row stands for words that are not in the table.
    weights = np.vstack([weights, np.zeros((1, len(model.categories)), dtype=np.int64)])
    vocabulary = read_vocabulary(model.settings.subwords) if model.settings.subwords else None
    shared = model.labels.sparkSession.sparkContext.broadcast(Weights(words, weights, vocabulary))
    return ReadyBayes(model, shared, cold)


@dataclass(frozen=True)
class Weights:
    """Words, or pieces of words, with a row of weights each; the last row is for all others.

    Every worker has a copy, so words are an Arrow array: a `dict` of them takes several times the memory.
    """

    words: pa.Array
    rows: np.ndarray
    vocabulary: str | None

    def places(self, words: pa.Array) -> np.ndarray:
        return pc.fill_null(pc.index_in(words, value_set=self.words), len(self.words)).to_numpy()

    def of(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """A row of weights for each word, and which words are not in the table. All words have pieces."""
        if self.vocabulary is None:
            found = self.places(words)
            return self.rows[found], found == len(self.words)
        cut = pa.array(pieces_of(words.to_pylist(), self.vocabulary), pa.list_(pa.string()))
        totals = np.zeros((len(words), self.rows.shape[1]), dtype=np.int64)
        np.add.at(totals, pc.list_parent_indices(cut).to_numpy(), self.rows[self.places(cut.flatten())])
        return totals, np.zeros(len(words), dtype=bool)


def _sums(words: pa.Array, sizes: np.ndarray, known: Weights) -> tuple[np.ndarray, np.ndarray]:
    """Summed weights per text and class, and which of the words are not in the table.

    `words` are those of the texts one after another, `sizes` their numbers. A word is looked up once.
    """
    coded = words.dictionary_encode()
    weights, unknown = known.of(coded.dictionary)
    places = coded.indices.to_numpy() if len(words) else np.empty(0, dtype=np.int64)
    ends = np.cumsum(sizes)
    totals = np.zeros((len(sizes), known.rows.shape[1]), dtype=np.int64)
    for i in range(known.rows.shape[1] if len(words) else 0):
        running = np.concatenate([[0], np.cumsum(weights[places, i])])
        totals[:, i] = running[ends] - running[ends - sizes]
    return totals, unknown[places]


def _lists(values: pa.Array, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values)


def _scored_texts(texts: pa.Array, known: Weights, priors: np.ndarray, most: int | None, rest: bool) -> pa.Array:
    """A batch's scores, and the words that are to be joined elsewhere; some texts at a time, by their bytes."""
    texts = pc.fill_null(texts, "")
    ends, parts, start = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64), [], 0
    while start < len(texts) or not parts:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + TEXT_AT_ONCE, side="right")))
        words = pc.split_pattern(texts.slice(start, stop - start), " ")
        if most is not None:
            words = pc.list_slice(words, 0, most)
        some, counts = words.flatten(), pc.list_value_length(words).to_numpy()
        totals, unknown = _sums(some, counts, known)
        left = _lists(some.slice(0, 0), np.zeros(len(counts), dtype=np.int64))
        if rest:
            owners = np.repeat(np.arange(len(counts)), counts)
            left = _lists(some.filter(pa.array(unknown)), np.bincount(owners[unknown], minlength=len(counts)))
        scores = _lists(pa.array((totals + priors).ravel()), np.full(len(counts), len(priors)))
        parts.append(pa.StructArray.from_arrays([scores, left], names=["scores", "rest"]))
        start = stop
    return pa.concat_arrays(parts)


def score(articles: DataFrame, model: BayesModel | ReadyBayes, cleaned: str = "cleaned_text") -> DataFrame:
    """`articles` with `scores`, an integer per label in label order.

    Unknown words add nothing; an article without a known word scores the
    priors, a class without training rows has NULL. All columns and rows stay;
    ids play no part. With words that are not broadcast, rows are written once
    with what the others add up to.
    """
    ready = model if isinstance(model, ReadyBayes) else prepare(model)
    model, cold, shared = ready.model, ready.cold, ready.shared
    most, priors = model.settings.most, np.array([p or 0 for p in model.priors], dtype=np.int64)
    keep_rest = cold is not None

    @F.arrow_udf("scores array<bigint>, rest array<string>")
    def add_up(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = shared.value
        for texts in batches:
            yield _scored_texts(texts, known, priors, most, keep_rest)

    columns = [c for c in articles.columns if c != "scores"]
    seen = F.lit([p is not None for p in model.priors])
    rows = articles.select(*columns, add_up(F.col(cleaned)).alias("_found"))

    def masked(values: Column) -> Column:
        return F.zip_with(values, seen, lambda value, known: F.when(known, value))

    if cold is None:
        return rows.select(*columns, masked(F.col("_found.scores")).alias("scores"))
    rows = stage(rows.withColumn("_row", F.monotonically_increasing_id()), "partly-scored")
    more = (
        rows.select("_row", F.explode("_found.rest").alias("word"))
        .groupBy("_row", "word")
        .agg(F.count("*").alias("times"))
        .join(cold.hint("merge"), "word")  # a broadcast would pass through the driver with every batch of a stream
        .select("_row", "times", F.posexplode("weight").alias("label_idx", "value"))
        .groupBy("_row", "label_idx")
        .agg(F.sum(F.col("times") * F.col("value")).alias("value"))
        .groupBy("_row")
        .agg(F.map_from_entries(F.collect_list(F.struct("label_idx", "value"))).alias("_more"))
    )
    total = F.transform(
        "_found.scores", lambda value, i: value + F.coalesce(F.try_element_at("_more", i), F.lit(0).cast("long"))
    )
    return rows.join(more, "_row", "left").select(*columns, masked(total).alias("scores"))


def _hot_and_cold(model: BayesModel) -> tuple[DataFrame, DataFrame | None]:
    """The part of the weights small enough for every worker, and the rest if any.

    The whole table counts as hot when its measured size allows; otherwise the
    most frequent words of ordinary length do, which bounds rows and bytes. Both
    parts are written, so that scoring batch after batch finds them once.
    """
    weights = model.weights
    row_bytes = 48 + 8 * len(model.categories)
    size = model.words.agg(
        F.count("*").alias("words"), F.coalesce(F.sum(F.octet_length("word")), F.lit(0)).alias("bytes")
    ).first()
    if size.bytes + size.words * row_bytes <= BROADCAST_BYTES:
        return weights, None
    room = max(1, BROADCAST_BYTES // (row_bytes + HOT_WORD_BYTES))
    short = weights.filter(F.octet_length("word") <= HOT_WORD_BYTES)
    hot = stage(top_words(short, room), "hot-weights")
    cold = weights.join(hot.select("word"), "word", "left_anti").select("word", "weight")
    return hot, stage(cold, "cold-weights")


