"""Each operator against a version written out by hand, and over odd and empty tables."""

from __future__ import annotations

import gzip
import hashlib
import itertools
import pickle
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from newsloom import staging
from newsloom.llm import (
    chat,
    components,
    decontamination,
    fingerprints,
    language,
    minhash,
    packing,
    pii,
    pseudo_likelihood,
    toxicity,
    warc,
)


def texts_of(seed: int, count: int, words: int = 40, vocabulary: int = 400) -> list[str]:
    rng = random.Random(seed)
    return [" ".join(f"w{rng.randrange(vocabulary)}" for _ in range(rng.randrange(1, words))) for _ in range(count)]


# --- decontamination --------------------------------------------------------


def item_frame(spark, items):
    return spark.createDataFrame(list(enumerate(items)), "item_id long, text string")


def doc_frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


ITEM = "Yesterday Anna bought 12 apples for 3.50 dollars, and later Anna sold 12 apples to Peter at the market."


@pytest.mark.parametrize(
    "text, found",
    [
        (f"Some words before. {ITEM} And words after it.", True),
        (ITEM.upper().lower().replace("yesterday", "Yesterday"), False),  # names are gone: another template
        (ITEM.replace("12", "77").replace("Anna", "Maria").replace("Peter", "Hugo"), True),
        (ITEM.replace("12", "77", 1).replace("Anna", "Maria", 1), False),  # two values become four: slots disagree
        (ITEM.replace("3.50 dollars", "9 euros"), True),
        ("Yesterday Anna bought 12 apples for 3.50 dollars.", False),
        ("Nothing of the kind is said here, in none of these words at all.", False),
    ],
)
def test_template_leaks(spark, text, found):
    got = decontamination.flag(doc_frame(spark, [text]), item_frame(spark, [ITEM])).first()
    assert got.contaminated is found


def test_one_occurrence_is_enough(spark):
    other = ITEM.replace("12", "77").replace("Anna", "Maria").replace("3.50", "9")
    mixed = ITEM.replace("12", "77", 1).replace("Anna", "Maria", 1)
    texts = [
        f"{ITEM} In between are some more words. {other}",
        f"{other} In between are some more words. {mixed}",
        f"{ITEM} Much further on somebody said that Maria sold 77 apples to Hugo at the market.",
        f"{ITEM.replace('and later', 'and much much later')} In between are some more words. {other} {mixed}",
        f"{mixed} In between are some more words. {mixed}",
    ]
    got = {r.doc_id: r.contaminated for r in decontamination.flag(doc_frame(spark, texts), item_frame(spark, [ITEM])).collect()}
    assert got == {0: True, 1: True, 2: True, 3: True, 4: False}


def test_windows_by_hand(spark):
    items = [t for t in texts_of(1, 12, 30) if len(t.split()) >= 5]
    rng = random.Random(2)
    texts = []
    for i in range(60):
        words = texts_of(100 + i, 1)[0].split()
        item = rng.choice(items).split()
        part = item if i % 3 == 0 else item[: len(item) // 2] if i % 3 == 1 else []
        texts.append(" ".join(words + part + words[:3]))

    def windows(text):
        found = [re.sub("[0-9]+", " 0 ", w).split() for w in text.split()]
        tokens = [t for f in found for t in f]
        if not tokens:
            return set()
        every = [tuple(tokens[i : i + 5]) for i in range(max(1, len(tokens) - 4))]
        return {w for w in every if sum(t != "0" for t in w) >= 2}

    wanted = []
    for text in texts:
        own = windows(text)
        wanted.append([i for i, item in enumerate(items) if windows(item) and len(own & windows(item)) >= 0.8 * len(windows(item))])
    found = decontamination.leaks(doc_frame(spark, texts), item_frame(spark, items), consistency=0.0).collect()
    got = [sorted(r.item_id for r in found if r.id == i) for i in range(len(texts))]
    assert got == wanted and any(wanted)


def test_odd_benchmarks(spark, odd_docs, no_docs):
    items = item_frame(spark, ["", None, "12 34 56", "the lazy dog near the river"])
    got = decontamination.flag(odd_docs, items)
    assert got.count() == odd_docs.count() and set(got.columns) == {*odd_docs.columns, "contaminated", "leaked_items"}
    assert Counter(r.doc_id for r in got.filter("contaminated").collect()) == {1: 2}
    assert decontamination.flag(no_docs, items).count() == 0
    assert decontamination.flag(odd_docs, items.limit(0)).filter("contaminated").count() == 0


# --- chat -------------------------------------------------------------------

CHATS = [
    (1, 0, "system", "be brief"),
    (1, 1, "user", "<s> [INST] \\ <\\s> </s>"),
    (1, 2, "assistant", "[/INST] <</SYS>> ok \\\\"),
    (2, 0, "assistant", "first"),
    (2, 1, "tool", "[ROLE] x"),
    (2, 1, "tool", "[ROLE] x"),
    (3, 5, None, None),
    (3, None, "user", "é\U0001f600"),
    (None, 0, "user", "<\\\\\\s>"),
    (None, 1, "assistant", "<\\\\\\s>"),
]


def test_chat_round_trip(spark):
    turns = spark.createDataFrame(CHATS, "conv_id long, turn long, role string, text string")
    segments = chat.format_conversations(turns.withColumn("segment", F.lit("mine")))
    got = {r.conv_id: r for r in chat.read_back(segments).collect()}
    formatted = {}
    for r in segments.orderBy("conv_id", "segment").collect():
        formatted.setdefault(r.conv_id, []).append(r)
    assert set(got) == {1, 2, 3, None}
    for conv, row in got.items():
        own = sorted(
            ((c, t, r or "", x or "") for c, t, r, x in CHATS if c == conv), key=lambda v: (v[1] is not None, v[1] or 0, v[2:])
        )
        said = "".join(x for _, _, r, x in own if r == "assistant")
        assert row.n_turns == len(own)
        assert row.turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, _, r, x in own).encode()).hexdigest()
        assert (row.loss_chars, row.loss_sha256) == (len(said), hashlib.sha256(said.encode()).hexdigest())
        assert row.formatted_chars == len("".join(s.text for s in formatted[conv]))
        text = "".join(s.text for s in formatted[conv])
        marks = Counter(s.text for s in formatted[conv] if s.segment % 3 != 1)
        for control in chat.INSTRUCT.controls:
            assert text.count(control) == sum(n * m.count(control) for m, n in marks.items()), control
    assert {c: r.valid for c, r in got.items()} == {1: True, 2: False, 3: False, None: True}
    assert chat.read_back(chat.format_conversations(turns.limit(0))).count() == 0


@pytest.mark.parametrize("seed", range(5))
def test_escapes_undo(seed):
    rng = random.Random(seed)
    plain, marked = (chat.INSTRUCT.pattern(escaped) for escaped in (False, True))
    pieces = [*chat.INSTRUCT.controls, "\\", "<", "[", "s>", "/", "x", "INST]"]
    for _ in range(500):
        text = "".join(rng.choice(pieces) for _ in range(rng.randrange(12)))
        safe = chat.escape(text, plain)
        assert chat.unescape(safe, marked) == text
        assert not any(control in safe for control in chat.INSTRUCT.controls)


# --- pseudo-likelihood ------------------------------------------------------


def test_scores_by_hand():
    rng = np.random.default_rng(0)
    network = pseudo_likelihood.fresh({"a": 0, "b": 1, ".": 2})
    codes = pseudo_likelihood.Encoder(network.words)("a b unseen . b")
    total = 0.0
    for i in range(2, len(codes) - 2):
        sides = [codes[i - 2], codes[i - 1], codes[i + 1], codes[i + 2]]
        logits = np.tanh(sum(network.tables[k][c] for k, c in enumerate(sides))) @ network.out + network.bias
        total += float(logits[codes[i]] - np.log(np.exp(logits.astype(float)).sum()))
    assert pseudo_likelihood.log_likelihood(codes, network) == pytest.approx(total, rel=1e-4) and rng is not None


def test_training_tells_order_from_disorder(spark):
    rng = random.Random(4)
    line = "the cat sat on the mat and the dog lay by the door while rain fell over old roofs ."
    rows = [(i, " ".join([line] * rng.randrange(3, 30))) for i in range(200)]
    network = pseudo_likelihood.fit(spark.createDataFrame(rows, "doc_id long, text string"), rounds=4, masked=4)
    words = (line + " ") * 20
    mixed = words.split()
    rng.shuffle(mixed)
    found = pseudo_likelihood.score(
        spark.createDataFrame([(0, words), (1, " ".join(mixed)), (2, "qq zz xx vv " * 50)], "doc_id long, text string"), network
    )
    good, bad, alien = (r.mean_log_likelihood for r in found.orderBy("doc_id").collect())
    assert good > bad + 0.5 and good > alien + 0.5


@pytest.mark.parametrize("heads", [200_000, 20, 0])
def test_words_are_told_apart_inside_their_class(spark, monkeypatch, heads):
    monkeypatch.setattr(pseudo_likelihood, "HEADS", heads)
    common = " ".join(f"w{i}" for i in range(250)) + " "
    rows = [(i, common * 3) for i in range(8)] + [(8, "nation " * 15 + "zzation"), (9, "nation nation zzation zzation qqation")]
    network = pseudo_likelihood.fit(spark.createDataFrame(rows, "doc_id long, text string"), rounds=1)
    counts = Counter(w for _, text in rows for w in text.split())
    places = Counter()
    for word, n in counts.items():
        if word not in network.words:
            places[pseudo_likelihood.bucket(word)] += n
    texts = ["nation", "zzation", "qqation", "gibberation", "w1 nation zzation zzation", "", None]
    docs = spark.createDataFrame([(None if i == 4 else i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r.doc_id: r.log_likelihood for r in pseudo_likelihood.score(docs, network).collect()}
    for i, text in enumerate(texts):
        words = (text or "").split()
        inside = sum(
            np.log((counts[w] or 1) / (places[pseudo_likelihood.bucket(w)] + 1)) for w in words if w not in network.words
        )
        codes = pseudo_likelihood.Encoder(network.words)(text)
        assert got[None if i == 4 else i] == pytest.approx(pseudo_likelihood.log_likelihood(codes, network) + inside, rel=1e-4)
    assert got[0] > got[1] + 1 > got[2] + 1 > got[3] or "nation" in network.words


@pytest.mark.parametrize("rounds, masked", [(pseudo_likelihood.ROUNDS, pseudo_likelihood.MASKED), (3, 16), (4, 4), (6, 4)])
def test_training_predicts_every_token_once(rounds, masked):
    for text in texts_of(21, 30, 200):
        codes = pseudo_likelihood.Encoder({"w1": 0})(text)
        places = [pseudo_likelihood.trained(codes, turn, rounds, masked) for turn in range(rounds)]
        assert sorted(np.concatenate(places).tolist()) == list(range(len(codes) - 4))


class Lookups(dict):
    asked = 0

    def get(self, *key):
        self.asked += 1
        return super().get(*key)


def test_a_word_is_looked_up_once_wherever_it_stands():
    encoder = pseudo_likelihood.Encoder({"rain": 0, "fell": 1, ",": 2})
    encoder.index = Lookups(encoder.index)
    codes = encoder("Rain, rain fell, and fell " * 500)
    assert codes[2:-2].tolist() == [0, 2, 0, 1, 2, pseudo_likelihood.bucket("and"), 1] * 500
    assert encoder.index.asked <= 10


ODD_SPACES = [
    "", None, " \t\n ", "a_b__c _ é\u00a0ü z\x1c\x85q\x0b\x0cx\x1fy", "İstanbul ΣΑΣ ½² 中文字\u3000日本。", "x.\u2003 y,\u00a0 _\u00a0",
    "rain, rain. (rain) rain-fall 3.50 it's", "".join(chr(c) for c in range(1, 0x3100)),
]


@pytest.mark.parametrize("together, kept", [(4_000_000, 500_000), (40, 5)])
def test_pieces_give_the_tokens_of_whole_texts(monkeypatch, together, kept):
    monkeypatch.setattr(pseudo_likelihood, "CHARACTERS", together)
    monkeypatch.setattr(pseudo_likelihood, "PIECES", kept)
    words, heads = {"rain": 0, ",": 1}, {"x": (200, -1.5), "é": (201, -2.0)}
    encoder = pickle.loads(pickle.dumps(pseudo_likelihood.Encoder(words, heads)))
    for texts in (ODD_SPACES, texts_of(5, 40, 30), ODD_SPACES[::-1]):
        found = list(encoder.parts(texts))
        assert len(found) == len(texts)
        for text, (codes, known, rest) in zip(texts, found, strict=True):
            tokens = pseudo_likelihood.TOKEN.findall((text or "").lower())
            places = [words[w] if w in words else heads[w][0] if w in heads else pseudo_likelihood.bucket(w) for w in tokens]
            assert codes.tolist() == [255, 255, *places, 255, 255]
            assert known == pytest.approx(sum(heads[w][1] for w in tokens if w in heads))
            assert rest == Counter(w for w in tokens if w not in words and w not in heads)


def test_words_are_counted_over_whole_texts(spark):
    texts = [*ODD_SPACES, *texts_of(6, 60, 30)]
    expected = Counter(w for text in texts for w in pseudo_likelihood.TOKEN.findall((text or "").lower()))
    rows = pseudo_likelihood.word_counts(doc_frame(spark, texts)).collect()
    assert {r.word: r.n for r in rows} == expected and len(rows) == len(expected)
    assert all(r.place == pseudo_likelihood.bucket(r.word) for r in rows)


@pytest.mark.parametrize("together", [200_000, 7])
def test_texts_scored_together_score_as_alone(monkeypatch, together):
    network = pseudo_likelihood.fresh({"w1": 0, "w2": 1})
    codes = [pseudo_likelihood.Encoder(network.words)(text) for text in ["", *texts_of(7, 30), None, "w1 " * 5_000]]
    alone = [pseudo_likelihood.log_likelihood(c, network) for c in codes]
    monkeypatch.setattr(pseudo_likelihood, "TOKENS", together)
    assert pseudo_likelihood.log_likelihoods(codes, network) == pytest.approx(alone, rel=1e-6)
    assert pseudo_likelihood.log_likelihoods([], network).tolist() == []


@pytest.mark.parametrize("scale", [1, 40])
def test_a_step_goes_down_the_slopes_of_the_mean_loss(scale):
    rng = np.random.default_rng(3)
    network = pseudo_likelihood.fresh({})
    own = [network.tables.copy(), network.out * np.float32(scale), rng.normal(0, 0.1, 256).astype(np.float32)]
    around, wanted = rng.integers(0, 256, (4, 300)).astype(np.uint8), rng.integers(0, 256, 300).astype(np.uint8)
    tables, out, bias = (x.astype(float) for x in own)
    inner = np.tanh(sum(tables[i][around[i]] for i in range(4)))
    shares = np.exp(inner @ out + bias)
    shares /= shares.sum(axis=1, keepdims=True)
    shares[np.arange(300), wanted] -= 1
    back = shares @ out.T * (1 - inner**2)
    slopes = [np.zeros_like(tables), inner.T @ shares / 300, shares.sum(axis=0) / 300]
    for i in range(4):
        np.add.at(slopes[0][i], around[i], back / 300)
    seen = tuple(np.full_like(x, 1e-4) for x in own)
    pseudo_likelihood.step(tuple(own), seen, around, wanted)
    for was, now, slope in zip((tables, out, bias), own, slopes, strict=True):
        assert now == pytest.approx(was - 0.2 * slope / np.sqrt(1e-4 + slope**2), abs=2e-5)


def test_odd_texts_are_scored(spark, odd_docs, no_docs):
    network = pseudo_likelihood.fit(odd_docs)
    rows = pseudo_likelihood.score(odd_docs, network).collect()
    assert len(rows) == odd_docs.count()
    assert {r.n_tokens for r in rows if r.doc_id in (2, 3, 4)} == {0}
    assert all((r.mean_log_likelihood is None) == (r.n_tokens == 0) for r in rows)
    assert pseudo_likelihood.score(no_docs, pseudo_likelihood.fit(no_docs)).count() == 0


# --- personal data ----------------------------------------------------------

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def luhn(number: str) -> bool:
    twice = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(number))]
    return sum(n - 9 * (n > 9) for n in twice) % 10 == 0


def spans_by_hand(text: str) -> list[tuple[str, int, int]]:
    def digits(value):
        return re.sub("[^0-9]", "", value)

    checks = {
        "email": (EMAIL, lambda v: True),
        "ip": (IP, lambda v: all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in v.split("."))),
        "card": (CARD, lambda v: 13 <= len(digits(v)) <= 19 and luhn(digits(v))),
        "phone": (PHONE, lambda v: 9 <= len(digits(v)) <= 15),
    }
    return [(k, m.start(), m.end()) for k, (p, ok) in checks.items() for m in re.finditer(p, text) if ok(m[0])]


HARD = [
    "a@b.c+d@e.f@g.h x@y a@b-.c..d@@e.f",
    "é\U0001f600 1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.255 1.2.3",
    "4111 1111-1111 1111 and 4111111111111111 then 4111111111111112, 79927398713",
    "+1 (222) 555-7713. +49.30.901820 ++12345678901 +1-",
    "1" * 3000 + "@" + "2" * 3000 + ".com " + "9" * 5000 + ".1.1.1",
    "x" * 5000 + "@" + "y" * 20 + ".z",
    "+1 222 555 7713 4111 1111 1111 1111 bob@mail.example.com 10.0.0.1",
]


def test_base_spans_by_hand(spark):
    rng = random.Random(3)
    pieces = ["a@b.c", "+1 ", "555", "-", ".", " ", "(", ")", "1.2.3.4", "4111 1111 1111 1111", "@", "x", "é", "\U0001f600", "\n"]
    texts = HARD + ["".join(rng.choice(pieces) for _ in range(rng.randrange(25))) for _ in range(400)]
    got = {r.doc_id: r.spans for r in pii.annotate(doc_frame(spark, texts), threshold=9.0).collect()}
    for i, text in enumerate(texts):
        assert [(s.kind, s.start, s.end) for s in got[i]] == spans_by_hand(text), text[:80]
        assert all(text[s.start : s.end] == s.value for s in got[i])


def test_terms_that_disclose(spark):
    topics = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta"]
    rows = [f"{t} text. Reach Zebulon at zeb@corp.example.com about {t}s." for t in topics]
    rows += [f"Common text about nothing at all number{i}x" for i in range(60)]
    rows += [f"Reach us at info{i}@other{i}.example.org about common words" for i in range(20)]
    found = {r.doc_id: r.spans for r in pii.annotate(doc_frame(spark, rows)).collect()}
    for i in range(6):
        assert [rows[i][s.start : s.end] for s in found[i] if s.kind == "term"] == ["Zebulon"]
    assert not any(s.kind == "term" for i in range(6, len(rows)) for s in found[i])
    frame = pii.annotate(doc_frame(spark, rows[:6] + rows[6:]))
    text = frame.select("doc_id", pii.redacted(F.col("text"), F.col("spans")).alias("t")).filter("doc_id = 2").first().t
    assert text == "gamma text. Reach [TERM] at [EMAIL] about gammas."


def test_copies_count_as_rows_wherever_rows_are_counted(spark):
    held = ["Reach Zebulon at zeb@corp.example.com about one thing"] * 30 + ["Then Zebulon wrote zeb@corp.example.com about two more"]
    rows = held + [f"Common text about one thing or two more number{i}x" for i in range(270)]
    found = {r.doc_id: r.spans for r in pii.annotate(doc_frame(spark, rows)).collect()}
    for i in range(31):
        assert "Zebulon" in [rows[i][s.start : s.end] for s in found[i] if s.kind == "term"]


def test_terms_are_found_in_rows_without_entities(spark):
    topics = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta"]
    rows = [f"{t} text. Reach Zebulon at zeb@corp.example.com about {t}s." for t in topics]
    rows += ["Ask ZEBULON, not Zebulonia; zebulon knows"]
    rows += [f"Common text about nothing at all number{i}x" for i in range(60)]
    rows += [f"Reach us at info{i}@other{i}.example.org about common words" for i in range(20)]
    found = {r.doc_id: r.spans for r in pii.annotate(doc_frame(spark, rows)).collect()}
    assert [(s.kind, s.value, s.start) for s in found[6]] == [("term", "ZEBULON", 4), ("term", "zebulon", 28)]
    assert all([s.value for s in found[i] if s.kind == "term"] == ["Zebulon"] for i in range(6))
    assert not any(s.kind == "term" for i in range(7, len(rows)) for s in found[i])


def test_odd_texts_are_annotated(spark, odd_docs, no_docs):
    got = pii.annotate(odd_docs)
    assert got.count() == odd_docs.count() and got.columns == [c for c in odd_docs.columns if c != "spans"] + ["spans"]
    spans = got.filter("size(spans) > 0").collect()
    assert [[s.kind for s in r.spans if s.kind != "term"] for r in spans] == [["email", "phone"]] and spans[0].doc_id is None
    assert pii.annotate(no_docs).count() == 0


def test_native_plans(spark):
    docs = doc_frame(spark, texts_of(9, 20))
    for frame in (
        pii.annotate(docs),
        decontamination.flag(docs, item_frame(spark, texts_of(1, 3))),
        fingerprints.edited_fingerprints(docs),
    ):
        text = frame._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", text)


# --- near-duplicates --------------------------------------------------------


def families(seed: int, count: int = 25, size: int = 14) -> list[str]:
    rng = random.Random(seed)
    texts = []
    for _ in range(count):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice([3, 12, 40, 90]))]
        for _ in range(rng.randrange(1, size)):
            words = list(base)
            for _ in range(rng.randrange(0, 5)):
                words[rng.randrange(len(words))] = f"w{rng.randrange(3000)}"
            texts.append(" ".join(words).upper() if rng.random() < 0.2 else "  ".join(words))
    rng.shuffle(texts)
    return texts


def groups_by_hand(texts, size, percent):
    sets = []
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
        n = max(1, len(words) - size + 1)
        sets.append({tuple(words[i : i + size]) for i in range(n)} if words else set())
    parent = list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        common = len(sets[i] & sets[j])
        if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    return [root(i) for i in range(len(texts))], [len(s) for s in sets]


@pytest.mark.parametrize("seed, size, percent", [(1, 3, 85), (2, 5, 80)])
def test_near_duplicates_by_hand(spark, seed, size, percent):
    texts = [*families(seed), "", "a b", "A B", " "]
    roots, sizes = groups_by_hand(texts, size, percent)
    found = minhash.near_duplicates(doc_frame(spark, texts), likeness=minhash.Likeness(size, percent))
    got = {r.id: r for r in found.collect()}
    assert [got[i].component_id for i in range(len(texts))] == roots
    assert [got[i].n_shingles for i in range(len(texts))] == sizes
    assert [got[i].kept for i in range(len(texts))] == [i == r for i, r in enumerate(roots)]


def test_a_sample_of_rows_with_one_id(spark):
    """Ids that repeat, rows that repeat, and more labels than rows wanted."""
    same = spark.range(3000).select(F.lit(1).alias("doc_id"), F.lit("en").alias("lang"), F.concat(F.lit("text "), "id").alias("text"))
    equal = spark.range(3000).select(F.lit(None).cast("int").alias("doc_id"), F.lit("fr").alias("lang"), F.lit("le").alias("text"))
    sample = language.labelled_sample(same.unionByName(equal), "lang", 100)
    sizes = sample.groupby("label").size()
    assert 60 <= sizes["en"] <= 150 and sizes["fr"] == 1
    again = language.labelled_sample(same.unionByName(equal).repartition(7), "lang", 100)
    assert sample.equals(again)
    many = spark.range(900).select("id", F.concat(F.lit("l"), F.col("id") % 300).alias("lang"), F.concat(F.lit("t"), "id").alias("text"))
    assert set(language.labelled_sample(many, "lang", 5, "id", total=300).groupby("label").size()) <= {1, 2, 3}
    model = language.fit(many.withColumnRenamed("id", "doc_id"), per_language=3)
    assert len(model.languages) == 300


def test_one_of_each_group_stays(spark, odd_docs, no_docs):
    left = minhash.deduplicated(odd_docs)
    assert left.columns == odd_docs.columns
    assert Counter(r.doc_id for r in left.collect()) == {1: 1, 2: 1, None: 2, 3: 1, 4: 1, 5: 1, 6: 1, 7: 1}
    assert minhash.deduplicated(no_docs).count() == 0


def test_components(spark):
    rng = random.Random(6)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(400, 500)]
    links += [(600, i) for i in range(601, 800)] + [(7, 7)]
    parent = {i: i for pair in links for i in pair}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    frame = spark.createDataFrame(links, "a long, b long").repartition(5)
    alone = {i for i in parent if all(a == b for a, b in links if i in (a, b))}
    wanted = {i: root(i) for i in parent if i not in alone}
    assert {r.node: r.component for r in components.components(frame).collect()} == wanted
    halves = [spark.createDataFrame(links[i::2], "a long, b long") for i in (0, 1)]
    both = components.joined(components.joined(None, halves[0]), halves[1])
    assert {r.node: r.component for r in both.collect() if r.node not in alone} == wanted


def test_components_of_a_long_path_take_few_rounds(spark, monkeypatch):
    written = []

    def counted(df, name):
        written.append(name)
        return staging.stage(df, name)

    monkeypatch.setattr(components, "stage", counted)
    links = spark.range(10_000).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = components.components(links)
    assert found.agg(F.count("*"), F.min("component"), F.max("component")).first() == (10_001, 0, 0)
    assert written.count("component-roots") <= 20


# --- fingerprints -----------------------------------------------------------


def sketch_by_hand(text, size=5, k=128):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if w]
    found = set()
    for i in range(max(1, len(words) - size + 1) if words else 0):
        value = 42
        for word in words[i : i + size]:
            value = xxhash.xxh64_intdigest(word.encode(), seed=value)
        found.add(value >> 16)
    return sorted(found)[:k]


def test_fingerprints_by_hand(spark):
    texts = texts_of(7, 70, 400, 90) + ["", "a", "é\U0001f600 b", texts_of(7, 1, 400, 90)[0]]
    docs = spark.createDataFrame([(i * 3 % 101 + 1000 * (i % 2), t) for i, t in enumerate(texts)], "doc_id long, text string")
    by_id = {r.doc_id: r.text for r in docs.collect()}
    order = sorted(by_id, reverse=True)
    following = dict(zip(order, order[1:] + order[:1], strict=True))
    got = fingerprints.edited_fingerprints(docs.repartition(7)).collect()
    assert len(got) == len(texts)
    for r in got:
        text, after = by_id[r.doc_id], by_id[following[r.doc_id]]
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        own, new, other = sketch_by_hand(text), sketch_by_hand(edited), sketch_by_hand(after)
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.fingerprint == "".join(f"{h:012x}" for h in own)
        assert r.edited_fingerprint == "".join(f"{h:012x}" for h in new)
        for value, side in ((r.near_edited, new), (r.near_next, other)):
            union = sorted({*own, *side})[:128]
            share = len({*union} & {*own} & {*side}) / len(union) if union else 1.0
            assert value == pytest.approx(share)


def test_sketches_merge_and_estimate(spark):
    text = " ".join(texts_of(8, 40, 400, 5000))
    words = text.split()
    cut = len(words) // 2
    parts = (" ".join(words[:cut]), " ".join(words[cut - 4 :]), text)
    row = spark.createDataFrame([parts], "a string, b string, whole string")
    a, b, whole = (fingerprints.sketch(F.col(c)) for c in ("a", "b", "whole"))
    got = row.select(
        (fingerprints.merged(a, b) == whole).alias("same"),
        fingerprints.containment(a, whole).alias("inside"),
        fingerprints.distinct_shingles(whole).alias("distinct"),
        (fingerprints.from_text(fingerprints.as_text(whole)) == whole).alias("back"),
        F.size(fingerprints.from_text(F.lit(""))).alias("none"),
    ).first()
    exact = len({tuple(words[i : i + 5]) for i in range(len(words) - 4)})
    assert got.same and got.back and got.none == 0
    assert got.inside > 0.7 and abs(got.distinct - exact) < 0.3 * exact


def test_buckets_of_neighbours(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "LEAST_BUCKET_ROWS", 3)
    ids = [0, 1, 2, 3, 50, 51, 52, 53, 54, 55, 56, 10**12, 10**12 + 1, -(10**12), None]
    docs = spark.createDataFrame([(i, f"text {i}") for i in ids], "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.next_text for r in fingerprints.with_next(docs, "doc_id", ["text"]).collect()}
    order = [*sorted((i for i in ids if i is not None), reverse=True), None]
    assert got == {i: f"text {j}" for i, j in zip(order, order[1:] + order[:1], strict=True)}


@pytest.mark.parametrize(
    "ids",
    [
        [*range(2_000), 2**60],
        [-(2**63), 2**63 - 1, 0, *range(5, 900), *(2**i for i in range(12, 63)), *(-(2**i) for i in range(12, 63))],
        [*range(300), *[77] * 1_500, *range(400, 700)],
        [*range(300), *[None] * 1_500],
    ],
)
def test_buckets_stay_small_whatever_the_ids(spark, monkeypatch, ids):
    monkeypatch.setattr(fingerprints, "LEAST_BUCKET_ROWS", 50)
    rows = [(i, f"text {n} {i}") for n, i in enumerate(ids)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    tie = F.xxhash64("text")
    cuts, tied = fingerprints._cuts(docs, "doc_id", tie)
    keys = fingerprints._key(docs, "doc_id", tie if tied else F.lit(0))
    sizes = keys.select(fingerprints._bucket(cuts).alias("b")).groupBy("b").count().collect()
    assert max(r["count"] for r in sizes) < 250 and len(sizes) >= len(ids) / 250
    hashed = dict(docs.select("text", tie.alias("h")).collect())
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashed[r[1]]), reverse=True)
    got = {r.text: r.next_text for r in fingerprints.with_next(docs, "doc_id", ["text"]).collect()}
    assert got == {a[1]: b[1] for a, b in zip(order, order[1:] + order[:1], strict=True)}


def test_odd_fingerprints(spark, odd_docs, no_docs):
    assert fingerprints.edited_fingerprints(odd_docs).count() == odd_docs.count()
    assert fingerprints.edited_fingerprints(no_docs).count() == 0
    one = fingerprints.edited_fingerprints(doc_frame(spark, ["a b c d"])).first()
    assert one.near_next == 1.0 and one.near_edited < 1.0


# --- WARC -------------------------------------------------------------------


def test_a_length_beyond_all_payloads_ends_the_chain(spark, tmp_path):
    good = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Length: 2\r\n\r\nab\r\n\r\n"
    for number, length in enumerate((9_999_999_999, 999_999_999_999_999_999, 2**31 - 1)):
        place = tmp_path / str(number)
        place.mkdir()
        bad = f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:2>\r\nContent-Length: {length}\r\n\r\ncd\r\n\r\n"
        (place / "a.warc").write_bytes((good + bad).encode())
        assert [r.page_id for r in warc.page_records(warc.read(spark, str(place))).collect()] == [1]


def test_a_revisit_takes_its_figures_from_the_response_read(spark, tmp_path):
    def record(page, kind, payload, said, refers=""):
        head = f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:page:{page}>\r\nWARC-Payload-Digest: sha256:{said}\r\n"
        head += f"WARC-Payload-Length: 7\r\n{refers and f'WARC-Refers-To: <urn:page:{refers}>' + chr(13) + chr(10)}"
        return (head + f"Content-Length: {len(payload)}\r\n\r\n{payload}\r\n\r\n").encode()

    digest = hashlib.sha256(b"abcde").hexdigest()
    records = [
        record(1, "response", "abcde", digest),
        record(2, "revisit", "", digest, 1),
        record(3, "revisit", "", digest, 9),  # its response is not there
        record(4, "revisit", "", "00" * 32, 1),  # another payload
        record(5, "response", "", hashlib.sha256(b"").hexdigest()),
    ]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(gzip.compress(r) for r in records))
    got = {r.page_id: (r.payload_bytes, r.record_type, r.refers_to) for r in warc.page_records(warc.read(spark, str(tmp_path))).collect()}
    assert got == {1: (5, "response", None), 2: (5, "revisit", 1), 5: (0, "response", None)}


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_warc_with_records_inside_payloads(spark, tmp_path, compression):
    inner = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n"
    pages = [
        (1, "http://a b/\r\nX: 1", inner * 3 + "x" * 100),
        (2, "u", inner),
        (3, "u", inner * 3 + "x" * 100),
        (4, None, None),
        (5, "u", "WARC/1.1\r\n"),
        (6, "u", "é" * 60),
        (7, "u", "é" * 60),
        (8, "u", "short"),
        (9, "u", "short"),
        (10, "u", "\r\n\r\nWARC/1.1\r\n\r\n"),
        (11, "u", "y" * 30_000),
    ]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("head", F.lit("mine"))
    path = str(tmp_path / "w")
    warc.write(warc.with_revisits(frame.coalesce(2)), path, compression)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert warc.candidates(warc.pieces(spark, path)).count() > len(pages)
        got = {r.page_id: r for r in warc.page_records(warc.read(spark, path)).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert set(got) == {p[0] for p in pages}
    for page, _, html in pages:
        raw = (html or "").encode()
        assert got[page].payload_bytes == len(raw) and got[page].payload_digest == hashlib.sha256(raw).hexdigest()
    assert {p: r.refers_to for p, r in got.items() if r.record_type == "revisit"} == {3: 1, 7: 6}
    assert warc.round_trip(frame.limit(0)).count() == 0


def test_reachable(spark):
    rows = [("f", i, i + 1) for i in range(100)] + [("f", 500, 501), ("g", 0, 70), ("g", 35, 70), ("g", 70, 99), ("h", 3, 0)]
    got = {(r.file, r.offset) for r in warc.reachable(spark.createDataFrame(rows, "file string, offset long, successor long")).collect()}
    assert got == {("f", i) for i in range(100)} | {("g", 0), ("g", 70)}


# --- language ---------------------------------------------------------------


@pytest.fixture(scope="module")
def tongues(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    return docs.withColumn("held_out", F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0)


def test_language_on_unseen_texts(spark, tongues):
    model = language.fit(tongues.filter("not held_out"), per_language=200)
    assert model.languages == ["de", "en", "es", "fr"] and 0.05 <= model.temperature <= 20
    assert 0.02 < np.mean(model.weights == 0)
    rows = language.predict(tongues.filter("held_out"), model).select("lang", "lang_pred", "score").collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.97 and all(0 <= r.score <= 1 for r in rows)


def test_odd_texts_have_a_language(spark, odd_docs, no_docs):
    model = language.fit(odd_docs)
    rows = language.predict(odd_docs, model)
    assert rows.count() == odd_docs.count() and rows.columns[-2:] == ["lang_pred", "score"]
    assert {r.doc_id for r in rows.filter("lang_pred = 'und'").collect()} == {2, None, 3, 4, 6}
    nothing = language.fit(no_docs)
    assert nothing.languages == [] and language.predict(no_docs, nothing).count() == 0
    assert {r.lang_pred for r in language.predict(odd_docs, nothing).collect()} == {"und"}


def test_temperature_calibrates():
    rng = np.random.default_rng(1)
    logits = rng.normal(0, 1, (4000, 3))
    labels = np.array([rng.choice(3, p=language.softmax(x)) for x in logits])
    assert language.fit_temperature(logits * 4, labels) == pytest.approx(4, rel=0.15)


# --- packing ----------------------------------------------------------------


def test_packing_keeps_every_token(spark, odd_docs, no_docs):
    from public_tokenizers import path
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(80).select("doc_id", "text")
    more = [(10_000, None), (10_001, ""), (10_002, "<|endoftext|> x"), (10_003, "y" * 9000), (10_004, " " * 5000)]
    docs = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = packing.pack(docs.repartition(3)).collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert set(by_doc) == set(texts)
    for doc, pieces in by_doc.items():
        ids = [*tokenizer.encode(texts[doc] or "", add_special_tokens=False).ids, 1]
        pieces.sort(key=lambda r: r.start)
        assert [i for r in pieces for i in r.ids] == ids and {r.doc_tokens for r in pieces} == {len(ids)}
        assert [r.start for r in pieces] == [sum(p.length for p in pieces[:k]) for k in range(len(pieces))]
        for r in pieces:
            assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, dtype="<u4").tobytes())
    padding = 0
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == [sum(p.length for p in pieces[:k]) for k in range(len(pieces))]
        total = sum(r.length for r in pieces)
        assert total <= 2048
        padding += 2048 - total if total & (total - 1) else 0
        kinds = {r.class_pieces for r in pieces}
        assert len(kinds) == 1 and (kinds == {0} or len(pieces) == pieces[0].class_pieces)
    assert padding < 0.02 * sum(r.length for r in rows)
    assert packing.pack(odd_docs).select("doc_id").distinct().count() == 8
    assert packing.pack(no_docs).count() == 0


@pytest.mark.parametrize("tokens", [1, 63, 64, 65, 1023, 1024, 1025, 2047, 2048, 2049, 9999])
def test_cuts(tokens):
    kinds, rest = packing.cuts(tokens)
    assert sum(2048 // k for k in kinds) + rest == tokens and 0 <= rest < 64


# --- toxicity ---------------------------------------------------------------


def test_toxicity_on_unseen_texts(spark):
    from newsloom.llm.queries import op10_toxicity

    scored = op10_toxicity(spark, "/root/testdata/sf0.1")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").select("doc_id", "toxic")
    rows = scored.filter("held_out").join(labels, "doc_id").collect()
    hits = sum(r.predicted and r.toxic for r in rows)
    assert hits / sum(r.toxic for r in rows) > 0.85 and hits / sum(r.predicted for r in rows) > 0.85
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)


def test_misspellings_share_vectors():
    rng = random.Random(1)
    clean = texts_of(1, 300, 30, 200)
    toxic = [f"{a} {rng.choice(['horrible', 'stupidity', 'worthless'])} {b}" for a, b in zip(clean, texts_of(2, 150), strict=False)]
    model = toxicity.train(clean + toxic, np.array([0] * len(clean) + [1] * len(toxic)))
    seen, unseen, neither = (toxicity.text_logit(f"w1 w2 {w} w3", model) for w in ("horrible", "horriblle", "w7"))
    assert seen > neither and unseen > neither and unseen > 0 > neither


def test_odd_texts_have_a_score(spark, odd_docs, no_docs):
    rows = odd_docs.withColumn("toxic", (F.col("doc_id") % 2).cast("int"))
    got = toxicity.score(rows, toxicity.fit(rows))
    assert got.count() == rows.count() and got.filter("score between 0 and 1").count() == rows.count()
    nothing = toxicity.fit(no_docs.withColumn("toxic", F.lit(1)))
    assert toxicity.score(no_docs, nothing).count() == 0
    assert toxicity.score(odd_docs, nothing).first().score == pytest.approx(0.5)


def test_edited_texts_of_a_whole_table_equal_sql(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "LEAST_BUCKET_ROWS", 100)
    place = "/root/testdata/sf0.01/documents.parquet"
    docs = fingerprints.edited_fingerprints(spark.read.parquet(place))
    wanted = duckdb.sql(
        f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM '{place}'),
        n AS (SELECT *, coalesce(lead(t) OVER w, first_value(t) OVER w) AS nx FROM d WINDOW w AS (ORDER BY doc_id DESC))
        SELECT doc_id, length(t), sha256(left(t, length(t) - length(t) // 2) || left(nx, length(t) // 2)) FROM n"""
    ).fetchall()
    assert sorted(map(tuple, docs.select("doc_id", "n_chars", "edited_sha256").collect())) == sorted(wanted)
