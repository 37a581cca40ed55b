"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Spark counts documents per hashed n-gram over all training rows. A bounded sample of labelled
rows then trains the weights on the driver: follow-the-regularised-leader with an
elastic-net penalty, and a temperature fitted on rows the weights have not
seen. The model is one small matrix, so prediction is a map over whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.ngrams import grams, letter_codes
from newsloom.llm.tables import free, small_batches
from newsloom.staging import stage

BITS = 14
SIZES = (1, 2, 3)
#: Labelled rows per language that train the weights; the only bound on what is learned from.
SAMPLE_PER_LANGUAGE = 800
#: Labelled rows in all; with very many languages each has fewer than the above.
SAMPLE_TOTAL = 160_000
#: Up to so many labels, the rates of a sample are literals of its filter; beyond that they are joined.
LITERAL_LABELS = 200
SCALE = 20.0
UNKNOWN = "und"


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    #: idf times weight: one row per bucket, one column per language.
    weights: np.ndarray
    bias: np.ndarray
    temperature: float


@dataclass(frozen=True)
class Ftrl:
    """Settings of follow-the-regularised-leader with an elastic net."""

    alpha: float = 0.3
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.01
    epochs: int = 3


def buckets(text: str | None, bits: int = BITS, sizes: tuple[int, ...] = SIZES) -> np.ndarray:
    """Hashed n-grams of a whole text; empty when it has no letter."""
    codes = letter_codes(text)
    if not len(codes):
        return np.empty(0, dtype=np.int64)
    return np.concatenate([grams(codes, size, bits)[0] for size in sizes])


def document_counts(docs: DataFrame, text_col: str = "text", bits: int = BITS) -> tuple[np.ndarray, int]:
    """Documents per bucket over all rows, and the number of documents with letters.

    Each task sends at most `2**bits + 1` sums.
    """
    size = 1 << bits

    def count(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(size + 1, dtype=np.int64)
        for batch in source:
            for text in batch.column(0).to_pylist():
                found = buckets(text, bits)
                if len(found):
                    seen[:size] += np.bincount(found, minlength=size) > 0
                    seen[size] += 1
        places = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(places, pa.int64()), pa.array(seen[places], pa.int64())], ["bucket", "n"])

    sums = small_batches(docs).select(text_col).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    found = sums.toPandas()  # at most 2**bits + 1 rows
    totals = np.zeros(size + 1)
    totals[found["bucket"].to_numpy(dtype=np.int64)] = found["n"].to_numpy(dtype=float)
    return totals[:size], int(totals[size])


def labelled_sample(
    docs: DataFrame, label_col: str, most: int, key: str = "doc_id", text_col: str = "text", total: int = SAMPLE_TOTAL
) -> pd.DataFrame:
    """About `most` rows of each label, the same ones at any partitioning, as `(label, mark, text)`.

    Rows are chosen by a hash of their id and text, at a rate that follows from the number of rows
    of their label; rows equal in label, id and text count once. With very many labels each gets fewer
    rows, one at least, so that there are about `total` rows in all.
    """
    marks = F.xxhash64(F.col(key), F.col(text_col), F.lit("sample"))
    rows = docs.select(F.col(label_col).alias("label"), marks.alias("hash"), F.col(text_col).alias("text"))
    rows = rows.withColumn("mark", F.pmod("hash", F.lit(1 << 30)))
    counts = stage(rows.groupBy("label").agg(F.count("*").alias("n")), "label-counts")
    labels = counts.count()
    each = max(1, min(most, total // max(1, labels)))
    # A label of few rows is taken whole: at a rate of a little over `each` none may be left.
    share = F.when(F.col("n") <= 2 * each, 1 << 30).otherwise(F.round(F.lit(float(each)) / F.col("n") * (1 << 30)))
    shares = counts.select("label", share.cast("long").alias("share"))
    if labels <= LITERAL_LABELS:
        # As literals the rates reach the scan, also through a join that gives the label.
        wanted = [(F.col("label") == F.lit(r.label)) & (F.col("mark") < r.share) for r in shares.collect()]
        chosen = rows.filter(reduce(or_, wanted, F.lit(False)))
    else:
        chosen = rows.join(shares, "label").filter("mark < share")
    sample = chosen.dropDuplicates(["label", "hash"]).select("label", "mark", "text").toPandas()
    missing = shares.filter(~F.col("label").isin(list(set(sample["label"]))))
    if len(set(sample["label"])) < labels:
        # Copies of few different rows may all be passed over: the first of them stands for its label.
        first = rows.join(missing, "label").groupBy("label").agg(F.min(F.struct("hash", "mark", "text")).alias("row"))
        sample = pd.concat([sample, first.select("label", "row.mark", "row.text").toPandas()])
    return sample.sort_values(["label", "mark", "text"], ignore_index=True)


def softmax(logits: np.ndarray) -> np.ndarray:
    parts = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return parts / parts.sum(axis=-1, keepdims=True)


def train_ftrl(
    rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, size: int, settings: Ftrl
) -> tuple[np.ndarray, np.ndarray]:
    """Sparse weights `(size, classes)` and a bias from `(buckets, values)` rows."""
    z, n = np.zeros((size + 1, classes)), np.zeros((size + 1, classes))

    def weights(places: np.ndarray | slice) -> np.ndarray:
        zp = z[places]
        shrunk = np.sign(zp) * settings.l1 - zp
        w = shrunk / ((settings.beta + np.sqrt(n[places])) / settings.alpha + settings.l2)
        w[np.abs(zp) <= settings.l1] = 0.0
        return w

    order = np.random.default_rng(7)
    for _ in range(settings.epochs):
        for i in order.permutation(len(rows)):
            places, values = np.append(rows[i][0], size), np.append(rows[i][1], 1.0)
            w = weights(places)
            error = softmax(values @ w)
            error[labels[i]] -= 1.0
            gradient = values[:, None] * error[None, :]
            before = n[places]
            after = before + gradient**2
            z[places] += gradient - (np.sqrt(after) - np.sqrt(before)) / settings.alpha * w
            n[places] = after
    final = weights(slice(None))
    return final[:size], final[size]


def fit_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature with the least log loss, by golden-section search on its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(logits / np.exp(log_t))
        return float(-np.log(np.maximum(p[np.arange(len(labels)), labels], 1e-12)).mean())

    low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(40):
        left, right = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, right) if loss(left) <= loss(right) else (left, high)
    return float(np.exp((low + high) / 2))


def fit(
    train: DataFrame,
    label_col: str = "lang",
    key: str = "doc_id",
    text_col: str = "text",
    per_language: int = SAMPLE_PER_LANGUAGE,
    settings: Ftrl = Ftrl(),
    bits: int = BITS,
) -> LanguageModel:
    """Learn from labelled rows; rows with a NULL label or text are left out.

    Document frequencies cover all rows. Weights come from about `per_language`
    rows of each language, of which every fifth is kept for the temperature. No
    rows at all give a model that knows no language.
    """
    rows = train.filter(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    sample = labelled_sample(rows, label_col, per_language, key, text_col)
    languages = sorted(set(sample["label"]))
    size = 1 << bits
    if not languages:
        return LanguageModel([], np.zeros((size, 0), dtype=np.float32), np.zeros(0), 1.0)
    seen, documents = document_counts(rows, text_col, bits)
    idf = np.log((1 + documents) / (1 + seen)) + 1.0
    features, labels, kept_for_scale = [], [], []
    for place, (label, text) in enumerate(zip(sample["label"], sample["text"], strict=True)):
        found = buckets(text, bits)
        if len(found):
            counts = np.bincount(found, minlength=size)
            places = np.flatnonzero(counts)
            features.append((places, counts[places] / len(found) * idf[places] * SCALE))
            labels.append(languages.index(label))
            kept_for_scale.append(place % 5 == 4)
    labels, held = np.array(labels, dtype=int), np.array(kept_for_scale, dtype=bool)
    learned = [features[i] for i in np.flatnonzero(~held)]
    weights, bias = train_ftrl(learned, labels[~held], len(languages), size, settings)
    logits = np.array([features[i][1] @ weights[features[i][0]] + bias for i in np.flatnonzero(held)])
    temperature = fit_temperature(logits, labels[held])
    scaled = (weights * idf[:, None] * SCALE).astype(np.float32)
    return LanguageModel(languages, scaled, bias, temperature)


def predict_text(text: str | None, model: LanguageModel) -> tuple[str, float]:
    found = buckets(text, int(model.weights.shape[0]).bit_length() - 1)
    if not len(found) or not model.languages:
        return UNKNOWN, 0.0
    logits = model.weights[found].mean(axis=0, dtype=np.float64) + model.bias
    shares = softmax(logits / model.temperature)
    best = int(shares.argmax())
    return model.languages[best], float(min(1.0, max(0.0, shares[best])))


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """Add `lang_pred` and `score` to all rows, from the whole text alone.

    NULL, empty and letterless texts get `und` and 0. Ties go to the language
    that sorts first. All columns and repeated rows stay; columns with those two
    names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double")
    def label(texts: pd.Series) -> pd.DataFrame:
        found = [predict_text(text, shared.value) for text in texts]
        return pd.DataFrame(found, columns=["lang_pred", "score"])

    kept = [c for c in docs.columns if c.lower() not in ("lang_pred", "score")]
    (found,) = free(["_found"], docs.columns)
    return small_batches(docs).select(*kept, label(F.col(text_col)).alias(found)).select(*kept, f"{found}.lang_pred", f"{found}.score")
