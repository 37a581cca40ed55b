"""Manifest, whitening and covering hashing against versions written out by hand."""

from __future__ import annotations

import hashlib
import itertools
import math
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from newsloom.llm import language, merkle, packing, simhash, whitening
from newsloom.llm.queries import LOWER, UPPER

# --- manifest ---------------------------------------------------------------


def sha(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_by_hand(row, text):
    values = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return sha(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree_by_hand(digests: list[str]) -> tuple[str, list[list[tuple[str, str]]]]:
    """The root and, for each leaf, the digests left and right of it in each run."""
    paths, groups = [[] for _ in digests], [[i] for i in range(len(digests))]
    while len(digests) > 1:
        above, below = [], []
        for at in range(0, len(digests), 8):
            run = digests[at : at + 8]
            for place, members in enumerate(groups[at : at + 8]):
                for i in members:
                    paths[i].append(("".join(run[:place]), "".join(run[place + 1 :])))
            above.append(sha(*run))
            below.append([i for members in groups[at : at + 8] for i in members])
        digests, groups = above, below
    return digests[0], paths


def manifest_by_hand(rows, change):
    order = lambda r: (r["lang"] is not None, (r["lang"] or "").encode(), r["doc_id"] is not None, r["doc_id"] or 0,
                       leaf_by_hand(r, r["text"]))
    rows = sorted(rows, key=order)
    trees = [list(g) for _, g in itertools.groupby(rows, key=lambda r: r["lang"])]
    made = [tree_by_hand([leaf_by_hand(r, r["text"]) for r in tree]) for tree in trees]
    root, tops = tree_by_hand([subroot for subroot, _ in made]) if made else (None, [])
    found = []
    for tree, (subroot, paths), top in zip(trees, made, tops, strict=True):
        for row, path in zip(tree, paths, strict=True):
            folded = leaf_by_hand(row, change(row))
            for left, right in path + top:
                folded = sha(left, folded, right)
            proof = sha(*[left + right for left, right in path + top])
            leaf = leaf_by_hand(row, row["text"])
            found.append((row["doc_id"], leaf, subroot, root, proof, folded, folded == root))
    return sorted(found, key=str)


def tampered(row):
    if row["doc_id"] is None or zlib.crc32(str(row["doc_id"]).encode()) % 3 or row["text"] is None:
        return row["text"]
    return row["text"].translate(str.maketrans(UPPER, LOWER))


def manifest(docs):
    lowered = F.translate("text", UPPER, LOWER)
    share = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))
    changed = F.when(share == 0, lowered).otherwise(F.col("text"))
    found = merkle.verified(merkle.build(merkle.rows_of(docs, changed={"text": changed})))
    assert found.columns == ["id", "key", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in found.drop("key").collect()), key=str)


@pytest.mark.parametrize("block", [512, 8])
def test_manifest_by_hand(spark, docs_schema, monkeypatch, block):
    """Trees of 1, 8, 9, 65 and 200 leaves; a copy of the higher nodes for each block."""
    monkeypatch.setattr(merkle, "BLOCK", block)
    rows, number = [], 0
    for lang, count in ((None, 9), ("", 1), ("de", 8), ("en", 200), ("é", 65)):
        for _ in range(count):
            number += 7
            text = [None, "", "Ab C ÄÖ " * (number % 5), "lower case", "X" * 9000][number % 5]
            rows.append({"doc_id": number, "text": text, "lang": lang, "source": ["s", None, "é"][number % 3],
                         "n_chars": None if number % 4 == 0 else number})
    random.Random(3).shuffle(rows)
    docs = spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], docs_schema)
    found = manifest(docs.repartition(5))
    assert found == manifest_by_hand(rows, tampered)
    assert {r[-1] for r in found} == {True, False}


def test_manifest_of_odd_rows(spark, odd_docs, no_docs, docs_schema):
    rows = [r.asDict() for r in odd_docs.collect()]
    assert manifest(odd_docs) == manifest_by_hand(rows, tampered)
    assert manifest(no_docs) == []
    one = spark.createDataFrame([(3, "One", "en", None, 3)], docs_schema)
    assert manifest(one) == manifest_by_hand([r.asDict() for r in one.collect()], tampered)
    assert merkle.build(merkle.rows_of(no_docs)).root is None


def test_the_limit_of_recursion_is_put_back(spark, odd_docs):
    name = "spark.sql.cteRecursionRowLimit"
    spark.conf.set(name, "5")
    try:
        assert merkle.verified(merkle.build(merkle.rows_of(odd_docs))).filter("NOT verified").count() == 0
        assert spark.conf.get(name) == "5"
    finally:
        spark.conf.unset(name)


# --- whitening --------------------------------------------------------------


def whole_by_hand(vector):
    return [math.floor(Fraction(c) * 64) + 1_000_000 for c in vector]


def covariance_by_hand(rows):
    n, d = len(rows), len(rows[0])
    sums = [sum(r[i] for r in rows) for i in range(d)]
    of = lambda i, j: sum((n * r[i] - sums[i]) * (n * r[j] - sums[j]) for r in rows)
    return n, sums, np.array([[float(Fraction(of(i, j), n**3)) for j in range(d)] for i in range(d)])


def check_whitening(spark, vectors, schema="vec_id long, embedding array<float>"):
    frame = spark.createDataFrame(vectors, schema).repartition(3)
    kept = [(i, v) for i, v in vectors if v and all(c is not None and math.isfinite(c) for c in v) and len(v) == 5]
    distinct = sorted({tuple(whole_by_hand(v)) for _, v in kept})
    n, sums, covariance = covariance_by_hand(distinct)
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    found = whitening.whitened(frame).collect()
    assert len(found) == len(kept) * 5
    by_row: dict = {}
    for r in found:
        by_row.setdefault(r.id, set()).add((r.component, r.deviation, r.whitened, r.n, r.explained))
        assert r.identity_error < 1e-6
    signs: dict = {}
    for i, v in kept:
        x = whole_by_hand(v)
        deviation = sum((n * a - s) ** 2 for a, s in zip(x, sums, strict=True))
        exact = np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums, strict=True)])
        wanted = exact @ axes / np.sqrt(values)
        for component, found_deviation, z, rows, explained in by_row[i]:
            assert (rows, found_deviation) == (n, deviation if deviation < 1 << 63 else None)
            assert explained == pytest.approx(values[component - 1] / covariance.trace(), rel=1e-9)
            assert abs(z) == pytest.approx(abs(wanted[component - 1]), rel=1e-6, abs=1e-7)
            if abs(z) > 1e-3:
                assert signs.setdefault(component, z * wanted[component - 1] > 0) == (z * wanted[component - 1] > 0)
    return found


def test_whitening_by_hand(spark):
    rng = random.Random(5)
    rows = [(i, [float(np.float32(rng.gauss(0, 1 + k) + k)) for k in range(5)]) for i in range(150)]
    rows += [(200 + i, rows[i][1]) for i in range(20)]  # copies count once in the fit
    nan, inf = float("nan"), float("inf")
    rows += [(300, None), (301, []), (302, [1.0] * 4 + [None]), (303, [nan] + [1.0] * 4), (304, [inf] * 5), (305, [1.0] * 6)]
    found = check_whitening(spark, rows)
    assert {r.id for r in found} == set(range(150)) | set(range(200, 220))


def test_whitening_of_wide_entries(spark):
    """Differences of 50 bits take several limbs; sums of squares beyond 64 bits are NULL."""
    rng = random.Random(8)
    rows = [(i, [rng.uniform(-1, 1) * 2.0 ** (40 + k) for k in range(5)]) for i in range(130)]
    check_whitening(spark, rows, "vec_id long, embedding array<double>")


def test_whitening_of_odd_tables(spark):
    schema = "vec_id string, embedding array<double>, x string, n string, component string"
    empty = whitening.whitened(spark.createDataFrame([], schema))
    assert empty.count() == 0 and empty.columns[:2] == ["id", "component"]
    same = spark.createDataFrame([("a", [1.0, 2.0], "", "", ""), (None, [1.0, 2.0], "", "", "")], schema)
    assert whitening.whitened(same).count() == 0
    flat = [("a", [1.0, 2.0], "", "", ""), (None, [1.0, 3.0], "", "", ""), ("a", [1.0, 3.0], "", "", ""), ("b", [1e300, 0.0], "", "", "")]
    found = whitening.whitened(spark.createDataFrame(flat, schema)).collect()
    assert sorted((str(r.id), r.component, r.n, r.deviation) for r in found) == [
        ("None", 1, 2, 4096), ("a", 1, 2, 4096), ("a", 1, 2, 4096)]
    assert all(abs(r.whitened) == pytest.approx(1) and r.explained == pytest.approx(1) for r in found)
    named_x = spark.createDataFrame(flat, schema).drop("x").withColumnRenamed("vec_id", "x")
    assert whitening.whitened(named_x, "x").count() == 3


def test_planes_give_exact_products():
    rng = np.random.default_rng(4)
    values = rng.integers(0, 1 << 20, size=(201, 7), dtype=np.uint64)
    totals, sums = np.zeros((3, 7, 7), dtype=np.int64), np.zeros((3, 7), dtype=np.int64)
    whitening.scatter(whitening.bit_planes(values, 20), totals, sums)
    weights = [1 << (whitening.LIMB * i) for i in range(3)]
    for i, j in itertools.combinations_with_replacement(range(7), 2):
        wanted = sum(int(a) * int(b) for a, b in zip(values[:, i], values[:, j], strict=True))
        assert sum(int(totals[k, i, j]) * weights[k] for k in range(3)) == wanted
    assert [sum(int(sums[k, i]) * weights[k] for k in range(3)) for i in range(7)] == [int(c) for c in values.sum(axis=0)]


# --- covering hashing -------------------------------------------------------


def fingerprint_by_hand(text):
    words = (text or "").translate(str.maketrans(UPPER, LOWER))
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", words) if w]
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def groups_by_hand(ids, prints, radius=2):
    parent = list(range(len(ids)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(ids)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= radius:
            parent[root(j)] = root(i)
    best: dict = {}
    for i, own in enumerate(ids):
        at = root(i)
        known = best.setdefault(at, own)
        best[at] = min((v for v in (known, own) if v is not None), default=None)
    return [best[root(i)] for i in range(len(ids))]


@pytest.mark.parametrize("radius", [1, 2, 3, 4])
def test_masks_cover_all_places_within_the_radius(radius):
    found = simhash.masks(radius, 24 if radius > 2 else 64)
    assert len(found) == 2 ** (radius + 1) - 1
    for places in itertools.combinations(range(24 if radius > 2 else 64), radius):
        changed = sum(1 << p for p in places)
        assert any(not mask & changed for mask in found)


def near_texts(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(12):
        words = [f"W{rng.randrange(900)}" for _ in range(rng.choice([2, 9, 200, 700]))]
        texts.append(" ".join(words))
        for _ in range(4):
            changed = list(words)
            changed[rng.randrange(len(words))] = f"x{rng.randrange(99)}"
            texts.append("\t".join(changed) if rng.random() < 0.5 else " \n".join(changed).lower())
    return texts + ["", None, " \t", "é É one", "a b", "a b"]


@pytest.mark.parametrize("paired", [simhash.PAIRED, 1])
def test_simhash_by_hand(spark, monkeypatch, paired):
    monkeypatch.setattr(simhash, "PAIRED", paired)
    texts = near_texts(2)
    ids = [None if i % 13 == 12 else (i * 37) % 101 for i in range(len(texts))]
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string").repartition(4)
    found = simhash.near_duplicates(docs).collect()
    prints = [fingerprint_by_hand(t) for t in texts]
    wanted = zip(ids, prints, groups_by_hand(ids, prints), strict=True)
    assert sorted(((r.id, r.fingerprint, r.component_id) for r in found), key=str) == sorted(
        ((i, f"{p:016x}", c) for i, p, c in wanted), key=str
    )
    assert all(r.kept == (r.id == r.component_id) for r in found)


@pytest.mark.parametrize("paired", [16, 2])
def test_links_of_crowded_fingerprints(spark, monkeypatch, paired):
    """Hundreds of nodes around a few centres: the links connect just what all pairs connect."""
    monkeypatch.setattr(simhash, "PAIRED", paired)
    rng, prints = random.Random(9), set()
    for _ in range(4):
        centre = rng.getrandbits(64)
        for _ in range(90):
            prints.add(centre ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3, 5]))))
    prints = sorted(prints)
    signed = [simhash._signed(p) for p in prints]
    links = simhash.links(spark.createDataFrame([(s,) for s in signed], "node long")).collect()
    place = {s: i for i, s in enumerate(signed)}
    assert all((prints[place[r.a]] ^ prints[place[r.b]]).bit_count() <= 2 for r in links)
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for r in links:
        x, y = sorted((root(place[r.a]), root(place[r.b])))
        parent[y] = x
    least: dict = {}
    for i in range(len(prints)):
        least.setdefault(root(i), i)
    assert [least[root(i)] for i in range(len(prints))] == groups_by_hand(list(range(len(prints))), prints)


def test_simhash_of_odd_tables(spark, odd_docs, no_docs):
    assert simhash.near_duplicates(no_docs).count() == 0
    found = simhash.near_duplicates(odd_docs).collect()
    texts = [(r.doc_id, fingerprint_by_hand(r.text)) for r in odd_docs.collect()]
    wanted = groups_by_hand([i for i, _ in texts], [p for _, p in texts])
    assert sorted((str(r.id), r.fingerprint, str(r.component_id)) for r in found) == sorted(
        (str(i), f"{p:016x}", str(c)) for (i, p), c in zip(texts, wanted, strict=True)
    )
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "node long"), 1)


def test_a_long_text_is_counted_in_blocks(monkeypatch):
    text = " ".join(f"w{i % 91}" for i in range(5000))
    monkeypatch.setattr(simhash, "BLOCK", 64)
    assert simhash.fingerprint(simhash.shingle_hashes(text)) == fingerprint_by_hand(text)


# --- steps of older operators by hand ---------------------------------------


def test_all_ids_are_those_of_the_tokenizer_file(spark):
    """The rank file gives the same ids as the tokenizer file on every text of a table, and on odd ones."""
    import public_tokenizers
    from tokenizers import Tokenizer

    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    texts += ["", " ", "\n\n \t", "a" * 3000, "<|endoftext|> x", "é\U0001f600\u200d", "\u0000\ufeff", "  two  blanks ", "١٢٣ 123"]
    by_file = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = packing.encoder()
    for text, wanted in zip(texts, by_file.encode_batch(texts, add_special_tokens=False), strict=True):
        assert encode(text).tolist() == wanted.ids


def test_ftrl_steps_by_hand():
    """One number at a time, after the published update rules."""
    settings = language.Ftrl(epochs=2)
    rows = [(np.array([0, 2]), np.array([0.5, 1.5])), (np.array([1]), np.array([2.0])), (np.array([0, 1]), np.array([1.0, 0.25]))]
    labels, classes, size = np.array([0, 1, 2]), 3, 3
    z = [[0.0] * classes for _ in range(size + 1)]
    n = [[0.0] * classes for _ in range(size + 1)]

    def weight(i, c):
        if abs(z[i][c]) <= settings.l1:
            return 0.0
        sign = 1 if z[i][c] > 0 else -1
        return -(z[i][c] - sign * settings.l1) / ((settings.beta + math.sqrt(n[i][c])) / settings.alpha + settings.l2)

    order = np.random.default_rng(7)
    for _ in range(settings.epochs):
        for at in order.permutation(len(rows)):
            row = [*zip(*(part.tolist() for part in rows[at]), strict=True), (size, 1.0)]
            old = {i: [weight(i, c) for c in range(classes)] for i, _ in row}
            powers = [math.exp(sum(v * old[i][c] for i, v in row)) for c in range(classes)]
            for i, v in row:
                for c in range(classes):
                    g = v * (powers[c] / sum(powers) - (c == labels[at]))
                    sigma = (math.sqrt(n[i][c] + g * g) - math.sqrt(n[i][c])) / settings.alpha
                    z[i][c] += g - sigma * old[i][c]
                    n[i][c] += g * g
    found, bias = language.train_ftrl(rows, labels, classes, size, settings)
    wanted = [[weight(i, c) for c in range(classes)] for i in range(size + 1)]
    assert np.allclose(found, wanted[:size]) and np.allclose(bias, wanted[size]) and np.abs(found).max() > 0.01
