"""MinHash near-duplicates by a join over inverted signature coordinates.

A text's signature has `COORDINATES` smallest hashes of its word shingles. Texts
are posted under each (coordinate, value) pair. Two texts as alike as wanted
agree in at least `MATCHES` coordinates but for a chance of about one in a
million, so it is enough to merge the lists of a prefix: of a text's
coordinates in one common order, rarest values first, the first
`COORDINATES - MATCHES + 1`; two texts with that many agreements share one of
them, and the long lists of common passages are skipped. Collisions of the
pairs that meet are counted on whole signatures, and links are confirmed on the
full shingle sets.

No list is expanded as long as a link could still be implied: in every list,
each text is first paired with one member only, another one in each list, and
rounds of "best pair between two components" merge what can be merged. Only
pairs across components that are left after that, and whose shingles shared
with anyone allow a link, are made out in full.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.components import joined
from newsloom.llm.tables import free, small, small_batches
from newsloom.staging import stage

COORDINATES = 40
MATCHES = 20
SEED = 11
#: Rounds of best pairs before all open pairs are tested; a number of rounds, not a bound on pairs.
ROUNDS = 1
#: Lists, rarest first, whose heads a text is paired with in these rounds; later passes take all lists.
FIRST_LISTS = 5

SIGNATURES = "id long, text_hash long, n_shingles long, set_key string, signature array<int>"


@dataclass(frozen=True)
class Likeness:
    """What counts as a link: `size` words per shingle and a share of common shingles, in percent."""

    size: int = 5
    percent: int = 80


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a whole text's word shingles.

    A-Z are lowered; words are parted by ASCII white space. Fewer words than
    `size` make one shingle; no words give none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    n = max(1, len(words) - size + 1)
    mixed = np.full(n, min(size, len(words)), dtype=np.uint64)
    for i in range(min(size, len(words))):
        mixed = _mixed(mixed * np.uint64(0x9E3779B97F4A7C15) + hashes[i : i + n])
    return np.unique(mixed)


def signature(hashes: np.ndarray, coordinates: int = COORDINATES) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    factors = rng.integers(0, 1 << 63, size=coordinates, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    least = np.full(coordinates, np.iinfo(np.uint64).max, dtype=np.uint64)
    for start in range(0, len(hashes), 1024):
        block = hashes[start : start + 1024]
        least = np.minimum(least, (block[:, None] * factors[None, :]).min(axis=0))
    return (least >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _signature_rows(size: int, coordinates: int):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            counts, keys, signs = [], [], []
            for text in batch.column(2).to_pylist():
                found = shingles(text, size)
                counts.append(len(found))
                keys.append(xxhash.xxh3_128_hexdigest(found.tobytes()) if len(found) else None)
                signs.append(signature(found, coordinates).tolist() if len(found) else None)
            made = [pa.array(counts, pa.int64()), pa.array(keys, pa.string()), pa.array(signs, pa.list_(pa.int32()))]
            names = ["id", "text_hash", "n_shingles", "set_key", "signature"]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *made], names=names)

    return run


def _set_rows(size: int):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            sets = [shingles(text, size).view(np.int64) for text in batch.column(0).to_pylist()]
            keys = [xxhash.xxh3_128_hexdigest(s.tobytes()) for s in sets]
            arrays = [pa.array(keys, pa.string()), pa.array(sets, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["set_key", "shingles"])

    return run


def _prefixes(texts: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """`(coordinate, value, node, shared, place)`: the postings of every text's prefix that other texts can meet.

    `shared` tells how many of the text's coordinates are shared with any other
    text, `place` how many rarer ones the posting has before it.
    """
    postings = texts.select("node", F.posexplode("signature").alias("coordinate", "value"))
    lengths = postings.groupBy("coordinate", "value").agg(F.count("*").alias("n")).filter("n > 1")
    shared = postings.join(lengths, ["coordinate", "value"])
    # Values of one text alone come first in the order, so they take up places of the prefix.
    own = shared.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("n", "coordinate", "value"))).alias("lists"))
    room = F.greatest(F.lit(0), F.lit(coordinates - matches + 1) - (F.lit(coordinates) - F.size("lists")))
    prefix = F.posexplode(F.slice("lists", F.lit(1), room)).alias("place", "list")
    kept = own.select("node", F.size("lists").alias("shared"), prefix)
    return kept.select("list.coordinate", "list.value", "node", "shared", "place")


def _agreements(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda total, x: total + x
    )


def _possible(pairs: DataFrame, texts: DataFrame, matches: int, percent: int) -> DataFrame:
    """`(a, b, agreements)` of distinct pairs whose sizes and signatures allow a link."""
    side = texts.select("node", "n_shingles", "signature")
    both = pairs.join(side.toDF("a", "size_a", "sign_a"), "a").join(side.toDF("b", "size_b", "sign_b"), "b")
    near = F.least("size_a", "size_b") * 100 >= F.greatest("size_a", "size_b") * percent
    counted = both.filter(near).select("a", "b", _agreements(F.col("sign_a"), F.col("sign_b")).alias("agreements"))
    return counted.filter(F.col("agreements") >= matches)


def _common(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """`(a, b, common, size_a, size_b)`: what the full shingle sets of pairs have in common."""
    both = pairs.select("a", "b").join(sets.toDF("a", "set_a"), "a").join(sets.toDF("b", "set_b"), "b")
    sizes = [F.size(f"set_{side}").cast("long").alias(f"size_{side}") for side in "ab"]
    return both.select("a", "b", F.size(F.array_intersect("set_a", "set_b")).cast("long").alias("common"), *sizes)


def _alike(percent: int) -> Column:
    return F.col("common") * 100 >= (F.col("size_a") + F.col("size_b") - F.col("common")) * percent


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full shingle sets are alike enough."""
    return _common(pairs, sets).filter(_alike(percent)).select("a", "b")


def _across(pairs: DataFrame, groups: DataFrame | None) -> DataFrame:
    """Add the components of both ends as `group_a`, `group_b`, and keep the pairs that join two."""
    if groups is None:
        return pairs.withColumns({"group_a": F.col("a"), "group_b": F.col("b")})
    by_a = groups.select(F.col("node").alias("a"), F.col("component").alias("group_a"))
    by_b = groups.select(F.col("node").alias("b"), F.col("component").alias("group_b"))
    known = pairs.join(by_a, "a", "left").join(by_b, "b", "left")
    known = known.withColumns({"group_a": F.coalesce("group_a", "a"), "group_b": F.coalesce("group_b", "b")})
    return known.filter("group_a <> group_b")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    likeness: Likeness = Likeness(),
    coordinates: int = COORDINATES,
    matches: int = MATCHES,
) -> DataFrame:
    """`(id, text_hash, n_shingles, set_key, component_id, kept)`, one row per row of `docs`.

    Rows are linked when their shingle sets have at least `likeness.percent` of
    their union in common; components are taken over all links. `component_id` is
    the smallest id that can be reached, `kept` marks the row with that id. NULL
    and empty texts are linked with nothing and kept. Rows with equal sets are one
    node from the start, so copies are never paired. NULL ids come after all others;
    of rows that share the smallest id, those with the smallest text hash are
    kept. Rows equal in both columns are marked alike. Only the two named columns are read.
    """
    rows = small_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.select("id", F.xxhash64("text").alias("text_hash"), "text")
    signed = stage(rows.mapInArrow(_signature_rows(likeness.size, coordinates), SIGNATURES), "minhash-signatures")
    # One node per distinct set, numbered as it is written: ids may be NULL or repeated.
    first = F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")
    found = signed.filter("set_key IS NOT NULL").groupBy("set_key").agg(
        F.min(first).alias("least"), F.first("n_shingles").alias("n_shingles"), F.first("signature").alias("signature")
    )
    texts = stage(found.withColumn("node", F.monotonically_increasing_id()), "minhash-texts")
    lists = stage(_prefixes(texts, coordinates, matches), "minhash-lists")

    key = ["coordinate", "value"]
    heads = lists.groupBy(*key).agg(
        # The texts that share most lie in the middle of a group: most others are linked with one of them.
        F.min_by("node", F.struct(-F.floor(F.col("shared") / 4), F.xxhash64("node", "coordinate"))).alias("head"),
        F.count("*").alias("n"),
    )
    stars = (
        lists.join(heads.filter("n > 1").drop("n"), key)
        .filter((F.col("node") != F.col("head")) & (F.col("place") < FIRST_LISTS))
        .select(F.least("node", "head").alias("a"), F.greatest("node", "head").alias("b"))
        .distinct()
    )
    open_pairs = stage(_possible(stars, texts, matches, likeness.percent), "minhash-stars")

    sets = stage(_sets(rows, texts.join(_ends(open_pairs), "node", "left_semi"), likeness.size), "minhash-sets")

    groups: DataFrame | None = None
    tested = open_pairs.select("a", "b").limit(0)
    for _ in range(ROUNDS):
        crossing = _across(open_pairs, groups)
        between = [F.least("group_a", "group_b"), F.greatest("group_a", "group_b")]
        best = crossing.groupBy(*[c.alias(n) for c, n in zip(between, ("low", "high"), strict=True)]).agg(
            F.max_by(F.struct("a", "b"), F.struct("agreements", F.xxhash64("a", "b"))).alias("pair")
        )
        if groups is None:
            # No components yet: each text's best pair.
            ends = open_pairs.select(
                F.explode(F.array("a", "b")).alias("node"), F.struct("a", "b").alias("pair"), "agreements"
            )
            best = ends.groupBy("node").agg(
                F.max_by("pair", F.struct("agreements", F.xxhash64("pair.a", "pair.b"))).alias("pair")
            )
        tried = stage(best.select("pair.*").distinct(), "minhash-tried")
        if tried.isEmpty():
            break
        tested = tested.unionByName(tried)
        new = stage(_confirmed(tried, sets, likeness.percent), "minhash-links")
        open_pairs = stage(open_pairs.join(tried, ["a", "b"], "left_anti"), "minhash-open")
        if not new.isEmpty():
            groups = joined(groups, new)

    # What is left: pairs of one list in different components that were not tested yet. Texts that
    # share most of their shingles are the middle of a group; pairs with them come before all others.
    lists = stage(lists.join(heads.filter("n > 1").select(*key), key, "left_semi").drop("shared", "place"), "minhash-lists")
    open_lists = _several(lists, groups)
    sets = _with_sets(sets, rows, texts, open_lists.select("node").distinct(), likeness.size)
    linkable = stage(_linkable(open_lists, sets, likeness.percent), "minhash-linkable")
    lists = stage(lists.join(linkable, "node"), "minhash-lists")
    rest = _several(lists, groups)
    most = F.max_by("node", F.struct(F.col("shared") / F.col("n_shingles"), F.xxhash64("node")))
    middles = stage(rest.groupBy(*key).agg(most.alias("middle")), "minhash-middles")
    pairs = rest.join(middles, key).select(F.col("node").alias("a"), F.col("middle").alias("b")).distinct()
    common = stage(_common(pairs, sets), "minhash-common")
    new = stage(common.filter("a <> b").filter(_alike(likeness.percent)).select("a", "b"), "minhash-links")
    if not new.isEmpty():
        groups = joined(groups, new)
        rest = _several(lists, groups)

    # Two texts have no more in common than, of the middle's shingles, the smaller share, and of their
    # other shared ones the smaller number.
    with_middle = common.select(F.col("a").alias("node"), F.col("b").alias("middle"), F.col("common").alias("inner"))
    rest = rest.join(middles, key).join(with_middle, ["node", "middle"]).withColumn("outer", F.col("shared") - F.col("inner"))
    rest = rest.join(texts.select("node", "signature"), "node")
    own = rest.groupBy("node").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("coordinate"))).alias("posted"))
    rest = stage(rest.join(own, "node"), "minhash-rest")
    one, two = rest.alias("one"), rest.alias("two")
    most = F.least("one.inner", "two.inner") + F.least("one.outer", "two.outer")
    bound = most * 100 >= (F.col("one.n_shingles") + F.col("two.n_shingles") - most) * likeness.percent
    # A pair comes up in the first list that both are posted in, and in no other.
    agree = F.zip_with("one.signature", "two.signature", lambda x, y: x == y)
    both = F.col("one.posted").bitwiseAND(F.col("two.posted"))
    earlier = F.transform(agree, lambda same, i: same & (i < F.col("one.coordinate")) & (F.getbit(both, i) == 1))
    crossing = (
        one.join(two, key)
        .filter((F.col("one.node") < F.col("two.node")) & (F.col("one.component") != F.col("two.component")) & bound)
        .filter((F.size(F.filter(agree, lambda same: same)) >= matches) & ~F.exists(earlier, lambda same: same))
        .select(F.col("one.node").alias("a"), F.col("two.node").alias("b"))
    )
    crossing = stage(crossing.join(tested, ["a", "b"], "left_anti"), "minhash-crossing")
    if not crossing.isEmpty():
        new = stage(_confirmed(crossing, sets, likeness.percent), "minhash-links")
        groups = groups if new.isEmpty() else joined(groups, new)
    if groups is None:
        groups = texts.select("node", F.col("node").alias("component"))

    named = texts.join(groups, "node", "left").select(
        "set_key", "least", F.coalesce("component", "node").alias("component")
    )
    smallest = named.groupBy("component").agg(F.min("least").alias("best"))
    by_set = stage(named.join(smallest, "component").select("set_key", "best"), "minhash-groups")
    own = F.struct(F.col("id").isNull().alias("none"), "id", "text_hash")
    return signed.drop("signature").join(by_set, "set_key", "left").select(
        "id",
        "text_hash",
        "n_shingles",
        "set_key",
        F.when(F.col("best").isNull(), F.col("id")).otherwise(F.col("best.id")).alias("component_id"),
        (F.col("best").isNull() | F.col("best").eqNullSafe(own)).alias("kept"),
    )


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", likeness: Likeness = Likeness()) -> DataFrame:
    """One row of each group of near-duplicates, with all columns.

    Rows without words are all kept. Rows equal in id and text are one document: one of them stays.
    """
    marked = stage(near_duplicates(docs, id_col, text_col, likeness), "minhash-marked")
    names = free(["_id", "_hash"], docs.columns)
    dropped = marked.filter("NOT kept").select("id", "text_hash").distinct().toDF(*names)
    repeated = marked.filter("kept AND set_key IS NOT NULL").groupBy("id", "text_hash").agg(F.count("*").alias("n"))
    repeated = repeated.filter("n > 1").select("id", "text_hash").toDF(*names)
    match = F.col(names[0]).eqNullSafe(F.col(id_col).cast("long")) & (
        F.col(names[1]) == F.xxhash64(F.col(text_col).cast("string"))
    )
    left = docs.join(small(stage(dropped, "minhash-dropped")), match, "left_anti")
    repeated = stage(repeated, "minhash-repeated")
    if repeated.isEmpty():
        return left
    once = left.join(repeated, match, "left_semi").dropDuplicates([id_col, text_col])
    return left.join(repeated, match, "left_anti").unionByName(once)


def _several(lists: DataFrame, groups: DataFrame | None) -> DataFrame:
    """The written postings of lists that hold more than one component, with each one's component."""
    key = ["coordinate", "value"]
    if groups is None:
        placed = lists.withColumn("component", F.col("node"))
    else:
        placed = lists.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = placed.groupBy(*key).agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return stage(placed.join(several.filter("low <> high").select(*key), key, "left_semi"), "minhash-mixed")


def _with_sets(sets: DataFrame, rows: DataFrame, texts: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """`sets` and those of further nodes."""
    more = texts.join(nodes.join(sets, "node", "left_anti"), "node", "left_semi")
    return sets.unionByName(stage(_sets(rows, more, size), "minhash-sets"))


def _linkable(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """`(node, n_shingles, shared)` of the nodes that may have a link to another one.

    A shingle that no other node has counts against every link: no two nodes have
    more in common than the smaller of their `shared` counts, and with too many
    shingles of its own a node is alike to none.
    """
    known = sets.join(nodes.select("node").distinct(), "node", "left_semi")
    alone = (
        known.select("node", F.explode("shingles").alias("shingle"))
        .groupBy("shingle")
        .agg(F.count("*").alias("n"), F.min("node").alias("node"))
        .filter("n = 1")
        .groupBy("node")
        .agg(F.count("*").alias("alone"))
    )
    counted = known.select("node", F.size("shingles").cast("long").alias("n_shingles")).join(alone, "node", "left")
    shared = (F.col("n_shingles") - F.coalesce("alone", F.lit(0))).alias("shared")
    return counted.select("node", "n_shingles", shared).filter(F.col("shared") * 100 >= F.col("n_shingles") * percent)


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()


def _sets(rows: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """`(node, shingles)` of the wanted sets, computed again from one text each."""
    one = wanted.select("set_key", "node", F.col("least.id").alias("_id"), F.col("least.text_hash").alias("_hash"))
    match = F.col("_id").eqNullSafe(F.col("id")) & (F.col("_hash") == F.col("text_hash"))
    # The wanted rows go to all tasks if their count allows, so that no text is shuffled.
    texts = rows.join(small(stage(one.select("_id", "_hash"), "minhash-wanted")), match, "left_semi").select("text")
    found = texts.mapInArrow(_set_rows(size), "set_key string, shingles array<long>")
    return found.join(one, "set_key").groupBy("node").agg(F.first("shingles").alias("shingles"))
