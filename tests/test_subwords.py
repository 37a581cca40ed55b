"""Pieces of words, and a model that reads them."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from newsloom.operators import naive_bayes, subwords
from newsloom.operators.naive_bayes import Candidate

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def model(spark):
    rows = [(0, "goalkeeper footballville stadium"), (0, "football goal"), (1, "shareholder bankerville bankers"), (1, "stockbroker bank"), (1, None)]
    train = spark.createDataFrame(rows, "label_idx int, cleaned_text string")
    labels = spark.createDataFrame([("Sports", 0), ("Business", 1)], "category string, label_idx int")
    return naive_bayes.fit(train, labels, subwords=PATH)


def test_pieces_spell_their_word(spark):
    words = ["goalkeepers", "a", "zxqvblorp", "harbour"]
    found = {r.word: r.pieces for r in subwords.word_pieces(spark.createDataFrame([(w,) for w in words], "word string"), PATH).collect()}
    assert all("".join(found[w]) == w + subwords.WORD_END for w in words)
    assert len(found["zxqvblorp"]) > 1


def test_counts_and_weights_by_hand(spark, model):
    cut = Tokenizer.from_file(PATH)
    pieces = lambda text: [p for w in text.split() for p in cut.encode(w, add_special_tokens=False).tokens]
    texts = {0: "goalkeeper footballville stadium football goal", 1: "shareholder bankerville bankers stockbroker bank"}
    counts = {i: pieces(t) for i, t in texts.items()}
    vocabulary = sorted({p for c in counts.values() for p in c})
    assert sorted(r.word for r in model.words.collect()) == vocabulary
    assert [(r.label_idx, r.articles, r.tokens) for r in model.labels.orderBy("label_idx").collect()] == [
        (i, 2, len(counts[i])) for i in (0, 1)
    ]
    weight = lambda p, i: round(np.log((counts[i].count(p) + 1) / (len(counts[i]) + len(vocabulary))) * 1e9)
    text = "goalkeepers bankers unseenword"
    rows = spark.createDataFrame([(text,), ("",), (None,)], "cleaned_text string")
    found = {r.cleaned_text: r.scores for r in naive_bayes.score(rows, model).collect()}
    known = [p for p in pieces(text) if p in vocabulary]
    assert found[text] == [model.priors[i] + sum(weight(p, i) for p in known) for i in (0, 1)]
    assert found[""] == found[None] == model.priors


def test_an_unseen_word_has_features(spark, model):
    rows = spark.createDataFrame([("footballford",), ("bankerford",)], "cleaned_text string")
    sports, business = (r.scores for r in naive_bayes.score(rows, model).collect())
    assert sports[0] > sports[1] and business[0] < business[1]


def test_settings_are_kept(spark, model, tmp_path):
    loaded = naive_bayes.load(spark, naive_bayes.save(model, str(tmp_path / "m")).path)
    assert loaded.settings == Candidate(1.0, None, None, PATH)
    rows = spark.createDataFrame([("goalkeepers bank",)], "cleaned_text string")
    assert naive_bayes.score(rows, loaded).first() == naive_bayes.score(rows, model).first()
