"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A text is cut into segments of a few words. A segment's vector is the average of
the embeddings of its character n-grams (and of a few zeros, so that very short
segments weigh less), and a linear softmax turns it into a logit; the text takes
its most toxic segment, so a long text is judged by its worst passage and not by
its length. Misspellings that were never seen share most n-grams with the word
they come from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.language import labelled_sample
from newsloom.llm.ngrams import SPACE, grams, letter_codes
from newsloom.llm.tables import small_batches

BITS = 17
SIZES = (3, 4, 5)
DIMENSIONS = 8
SEGMENT_WORDS = 2
#: Zero vectors that every average includes.
ZEROS = 10
#: N-grams of fewer sampled texts than this are not learned.
LEAST_TEXTS = 3
#: Labelled rows per class that train the model; the only bound on what is learned from.
SAMPLE_PER_CLASS = 2500
EPOCHS = 6
RATE = 0.5
THRESHOLD = 0.3


@dataclass(frozen=True)
class ToxicityModel:
    #: Embedding times output weights: what an n-gram adds to the logit.
    parts: np.ndarray
    bias: float


def bag(text: str | None, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Hashed n-grams of the words of a text, ordered by segment, and where each segment starts."""
    codes = letter_codes(text)
    if not len(codes):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    word = np.cumsum(codes == SPACE) - 1
    found, places = zip(*(grams(codes, size, bits, whole_words=True) for size in SIZES), strict=True)
    ids, starts = np.concatenate(found), np.concatenate(places)
    if not len(ids):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    segment = word[starts] // SEGMENT_WORDS
    order = np.argsort(segment, kind="stable")
    segment = segment[order]
    return ids[order], np.flatnonzero(np.append(True, segment[1:] != segment[:-1]))


def segment_logits(ids: np.ndarray, starts: np.ndarray, parts: np.ndarray, bias: float) -> np.ndarray:
    sizes = np.diff(np.append(starts, len(ids)))
    return np.add.reduceat(parts[ids], starts) / (sizes + ZEROS) + bias


def text_logit(text: str | None, model: ToxicityModel) -> float:
    ids, starts = bag(text, int(len(model.parts)).bit_length() - 1)
    if not len(ids):
        return model.bias
    return float(segment_logits(ids, starts, model.parts, model.bias).max())


def sigmoid(x: float | np.ndarray) -> float | np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


def train(texts: list[str], labels: np.ndarray, bits: int = BITS, epochs: int = EPOCHS) -> ToxicityModel:
    """Embeddings and output weights by stochastic steps with per-coordinate rates.

    Each step takes one text: in the first round a segment at random, then the most toxic one.
    """
    rng = np.random.default_rng(3)
    size = 1 << bits
    bags = []
    texts_with = np.zeros(size, dtype=np.int64)
    for text in texts:
        ids, starts = bag(text, bits)
        texts_with[np.unique(ids)] += 1
        bags.append((ids.astype(np.int32), starts, np.diff(np.append(starts, len(ids)))))
    known = texts_with >= LEAST_TEXTS
    vectors = rng.normal(0, 0.1, (size, DIMENSIONS)).astype(np.float32) * known[:, None]
    out = rng.normal(0, 0.5, (DIMENSIONS, 2)).astype(np.float32)
    bias = np.zeros(2, dtype=np.float32)
    seen_v, seen_o, seen_b = (np.full_like(x, 1e-3) for x in (vectors, out, bias))
    for epoch in range(epochs):
        for i in rng.permutation(len(bags)):
            ids, starts, sizes = bags[i]
            if not len(ids):
                continue
            if epoch:
                totals = np.add.reduceat(vectors[ids] @ (out[:, 1] - out[:, 0]), starts)
                worst = int((totals / (sizes + ZEROS)).argmax())
            else:
                worst = int(rng.integers(len(starts)))
            part = ids[starts[worst] : starts[worst] + sizes[worst]]
            terms = len(part) + ZEROS
            part, times = np.unique(part[known[part]], return_counts=True)
            middle = times @ vectors[part] / terms
            logits = middle @ out + bias
            error = np.exp(logits - logits.max())
            error /= error.sum()
            error[labels[i]] -= 1.0
            slope_o = np.outer(middle, error)
            slope_v = times[:, None] * (out @ error)[None, :] / terms
            seen_o += slope_o**2
            out -= 0.1 * RATE * slope_o / np.sqrt(seen_o)
            seen_b += error**2
            bias -= 0.1 * RATE * error / np.sqrt(seen_b)
            seen_v[part] += slope_v**2
            vectors[part] -= RATE * slope_v / np.sqrt(seen_v[part])
    return ToxicityModel(vectors @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0]))


def fit(
    rows: DataFrame,
    label_col: str = "toxic",
    key: str = "doc_id",
    text_col: str = "text",
    per_class: int = SAMPLE_PER_CLASS,
) -> ToxicityModel:
    """Learn from rows labelled 0 or 1; others, and NULL texts, are left out.

    The sample holds about `per_class` rows of each class; the bias is then moved
    so that scores follow the share of class 1 among all labelled rows. Without
    rows of both classes, every text scores the share of class 1 (a half when
    there are no rows).
    """
    usable = rows.filter(F.col(label_col).isin(0, 1) & F.col(text_col).isNotNull())
    usable = usable.withColumn(label_col, F.col(label_col).cast("int"))
    counts = {r[label_col]: r.n for r in usable.groupBy(label_col).agg(F.count("*").alias("n")).collect()}  # two rows
    positive, negative = counts.get(1, 0), counts.get(0, 0)
    if not positive or not negative:
        share = (positive + 0.5) / (positive + negative + 1.0)
        return ToxicityModel(np.zeros(1 << BITS, dtype=np.float32), float(np.log(share / (1 - share))))
    sample = labelled_sample(usable, label_col, per_class, key, text_col)
    labels = sample["label"].to_numpy(dtype=int)
    model = train(list(sample["text"]), labels)
    chosen = max(1, int(labels.sum())), max(1, int((1 - labels).sum()))
    shift = float(np.log(positive / negative) - np.log(chosen[0] / chosen[1]))
    return ToxicityModel(model.parts, model.bias + shift)


def score(docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Add `score` (0 to 1) and `predicted` to all rows, from the whole text alone.

    NULL, empty and letterless texts get the score of the bias. All columns and
    repeated rows stay; columns with those two names are replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def logits(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([sigmoid(text_logit(t, shared.value)) for t in texts], dtype=float)

    kept = [c for c in docs.columns if c.lower() not in ("score", "predicted")]
    scored = small_batches(docs).select(*kept, logits(F.col(text_col)).alias("score"))
    return scored.select(*kept, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
