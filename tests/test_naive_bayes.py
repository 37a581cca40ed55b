import math
import pickle
import tracemalloc

import pytest
from pyspark.sql import functions as F

from newsloom.operators import naive_bayes as nb
from newsloom.operators.scoring import predict, probabilities
from newsloom.operators.vocabulary import top_words

TRAIN = [
    (1, "ball game win ball", 0),
    (2, "game goal", 0),
    (3, "stock market win", 1),
    (4, "market crash crash crash", 1),
    (5, "moon rocket", 2),
    (6, "", 2),
    (7, None, 0),
    (8, "lost row", None),
]
CATEGORIES = ["Sports", "Business", "Sci/Tech"]
ITEMS = [(10, "ball ball market"), (11, "nothing known here"), (12, ""), (13, "rocket moon win"), (14, "win " * 400)]


def setup(spark, categories=CATEGORIES):
    train = spark.createDataFrame(TRAIN, "id long, cleaned_text string, label_idx int")
    labels = spark.createDataFrame([(c, i) for i, c in enumerate(categories)], "category string, label_idx int")
    items = spark.createDataFrame([(i, t.strip()) for i, t in ITEMS], "id long, cleaned_text string")
    return train, labels, items


def by_hand(text, size=None):
    counts = [{} for _ in CATEGORIES]
    articles = [0] * len(CATEGORIES)
    for _, words, label in TRAIN:
        if words and label is not None:
            articles[label] += 1
            for w in words.split():
                counts[label][w] = counts[label].get(w, 0) + 1
    total = {}
    for c in counts:
        for w, n in c.items():
            total[w] = total.get(w, 0) + n
    vocabulary = set(sorted(total, key=lambda w: (-total[w], w))[:size])
    found = []
    for c, docs in zip(counts, articles):
        tokens = sum(n for w, n in c.items() if w in vocabulary)
        value = round(math.log(docs / sum(articles)) * 1e9)
        for w in text.split():
            if w in vocabulary:
                value += round(math.log((c.get(w, 0) + 1) / (tokens + len(vocabulary))) * 1e9)
        found.append(value)
    return found


@pytest.mark.parametrize("size", [None, 30_000, 4])
def test_scores_by_hand(spark, size):
    train, labels, items = setup(spark)
    model = nb.fit(train, labels, vocabulary_size=size)
    got = {r.id: r.scores for r in nb.score(items, model).collect()}
    assert got == {i: by_hand(t, size) for i, t in ITEMS}


def test_long_tail_by_a_join_gives_the_same(spark, monkeypatch):
    train, labels, items = setup(spark)
    model = nb.fit(train, labels, vocabulary_size=None)
    whole = {r.id: r.scores for r in nb.score(items, model).collect()}
    monkeypatch.setattr(nb, "BROADCAST_BYTES", 3 * (48 + 8 * 3 + nb.HOT_WORD_BYTES))
    hot, cold = nb._hot_and_cold(model)
    assert hot.count() == 3 and cold.count() == model.weights.count() - 3
    written = []
    stage = nb.stage
    monkeypatch.setattr(nb, "stage", lambda df, name: written.append(name) or stage(df, name))
    parts = nb.score(items, model)
    # The rows are read and scored once; only words that are not hot, summed per row, are exchanged.
    assert written.count("partly-scored") == 1
    text = parts._jdf.queryExecution().executedPlan().toString()
    assert "Generate explode" in text and "partial_count" in text
    assert {r.id: r.scores for r in parts.collect()} == whole


def test_unknown_words_and_empty_text_score_priors(spark):
    train, labels, items = setup(spark)
    model = nb.fit(train, labels)
    got = {r.id: r.scores for r in nb.score(items, model).collect()}
    assert got[11] == got[12] == model.priors
    assert {r.id: r.predicted_label_idx for r in predict(items, model).collect()}[11] == 0


def test_label_without_training_rows_gets_no_probability(spark):
    train, labels, items = setup(spark, [*CATEGORIES, "World"])
    model = nb.fit(train, labels)
    for r in nb.score(items, model).select(probabilities(F.col("scores")).alias("probabilities")).collect():
        assert r.probabilities[3] == 0.0 and abs(sum(r.probabilities) - 1) < 1e-9


def test_save_and_load(spark, tmp_path):
    train, labels, items = setup(spark)
    saved = nb.fit(train, labels, str(tmp_path / "bayes"))
    loaded = nb.load(spark, str(tmp_path / "bayes"))
    assert (loaded.categories, loaded.priors) == (saved.categories, saved.priors) and loaded.categories == CATEGORIES
    assert sorted(nb.score(items, loaded).collect()) == sorted(nb.score(items, saved).collect())


@pytest.mark.parametrize("size", [1, 2, 5, 37, 80, 500])
def test_top_words(spark, size):
    counts = [(f"w{i:03d}", 1 + (200 // (i + 1)) if i < 60 else 1) for i in range(120)]
    df = spark.createDataFrame(counts, "word string, n long").repartition(5)
    got = sorted((-r.n, r.word) for r in top_words(df, size).collect())
    assert got == sorted((-n, w) for w, n in counts)[:size]


def test_whole_texts_and_all_words_unless_told(spark):
    words = [f"w{i}" for i in range(31_000)]
    train = spark.createDataFrame([(0, " ".join(words)), (1, "other " * 200 + "last")], "label_idx int, cleaned_text string")
    labels = spark.createDataFrame([("A", 0), ("B", 1)], "category string, label_idx int")
    model = nb.fit(train, labels)
    assert model.weights.count() == 31_002
    text = spark.createDataFrame([("nothing " * 300 + "last",)], "cleaned_text string")
    assert predict(text, model).first().predicted_label_idx == 1
    cut = nb.load(spark, nb.fit(train, labels, vocabulary_size=100, most=128).path)
    assert cut.weights.count() == 100 and cut.settings.most == 128
    scores = nb.score(text, cut).first().scores
    assert scores == cut.priors


def test_rows_are_scored_where_they_stand(spark):
    train, labels, _ = setup(spark)
    model = nb.fit(train, labels)
    rows = [(7, "ball game"), (7, "market crash"), (None, "moon"), (None, None)]
    items = spark.createDataFrame(rows, "id long, cleaned_text string")
    scored = nb.score(items, model)
    assert "Exchange" not in scored._jdf.queryExecution().executedPlan().toString()
    got = {(r.id, r.cleaned_text): r.scores for r in scored.collect()}
    assert got == {(i, t): by_hand(t or "") for i, t in rows}


def test_many_classes(spark):
    count = 1500
    train = spark.range(count).selectExpr("cast(id as int) label_idx", "concat('w', id) cleaned_text")
    labels = train.selectExpr("concat('c', label_idx) category", "label_idx")
    model = nb.fit(train, labels)
    got = predict(spark.createDataFrame([("w1234",)], "cleaned_text string"), model).first()
    assert got.predicted_label_idx == 1234


def test_first_best_candidate_wins(spark):
    train, labels, items = setup(spark)
    held_out = items.withColumn("label_idx", F.lit(0))
    choices = [nb.Candidate(1.0), nb.Candidate(1.0), nb.Candidate(0.5, 3)]
    choice = nb.select_best(train, held_out, labels, choices)
    assert choice.candidate == choices[max(range(3), key=lambda i: (choice.accuracies[i], -i))]
    assert choice.accuracies[0] == choice.accuracies[1]


def test_workers_hold_words_in_little_memory(spark):
    words = [f"word{i}" for i in range(50_000)]
    train = spark.createDataFrame([(0, " ".join(words)), (1, "b"), (2, "c")], "label_idx int, cleaned_text string")
    labels = spark.createDataFrame([(c, i) for i, c in enumerate(CATEGORIES)], "category string, label_idx int")
    sent = pickle.dumps(nb.prepare(nb.fit(train, labels)).shared.value)
    tracemalloc.start()
    held = pickle.loads(sent)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(held.rows) == 50_003 and most < 60 * 50_000  # 24 bytes are weights


def test_a_prepared_model_finds_its_rare_words_once(spark, monkeypatch):
    train, labels, items = setup(spark)
    monkeypatch.setattr(nb, "BROADCAST_BYTES", 3 * (48 + 8 * 3 + nb.HOT_WORD_BYTES))
    ready = nb.prepare(nb.fit(train, labels))
    plan = nb.score(items, ready)._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti" not in plan and "BroadcastHashJoin [word" not in plan
