"""SimHash near-duplicates by covering locality-sensitive hashing.

A bit of a fingerprint is set when it is set in over half of the hashes of the
text's word shingles. The places of the bits are dealt to the points of a small
projective space over GF(2), one point for each vector of `radius + 1` bits but zero;
the mask of a vector keeps the places whose points are not orthogonal to it.
`radius` points never span the space, so for any `radius` places there is a vector
orthogonal to all of their points: its mask drops just these places, and two
fingerprints that differ in no others collide in that table. No pair within the
radius is missed, with 7 tables of 36 or 37 kept bits for a radius of 2.

Equal fingerprints are one node from the start. In a bucket of a few nodes all pairs are
compared. In a larger one, nodes are dealt out again by the centres around them:
two of them differ in at most `radius` of the dropped places just if some
centre lies at most half the radius from both. A centre has a bounded number
of nodes around it, so the work is in proportion to a bucket's nodes at any size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.components import components
from newsloom.llm.tables import small_batches
from newsloom.staging import stage

BITS = 64
SHINGLE = 3
RADIUS = 2
SEED = 42
#: Nodes of a bucket up to which comparing all pairs is less work than dealing them out by centres.
PAIRED = 16
#: Hashes whose bits are counted at a time.
BLOCK = 1 << 16

_BYTE_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)


def masks(radius: int = RADIUS, bits: int = BITS) -> list[int]:
    """Masks of kept places: for any `radius` places, one of the masks drops them all."""
    vectors = range(1, 1 << (radius + 1))
    points = [vectors[place % len(vectors)] for place in range(bits)]
    return [sum(1 << i for i, point in enumerate(points) if (point & v).bit_count() % 2) for v in vectors]


def shingle_hashes(text: str | None, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of every word shingle of a whole text, repeats included.

    A-Z are lowered, words parted by ASCII white space and joined by one blank.
    Fewer words than `size` make one shingle; no words give none.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    size = min(size, len(words))
    grams = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
    return np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), dtype=np.uint64, count=len(words) - size + 1)


def fingerprint(hashes: np.ndarray) -> int:
    """The bits that are set in over half of the hashes, as an unsigned number; 0 for none."""
    counts = np.zeros(BITS, dtype=np.int64)
    offsets = (np.arange(8) * 256).astype(np.int64)
    for start in range(0, len(hashes), BLOCK):
        block = hashes[start : start + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8)
        tally = np.bincount((block + offsets).ravel(), minlength=8 * 256).reshape(8, 256)
        counts += (tally @ _BYTE_BITS).ravel()
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprint_rows(size: int):
    def run(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            found = [fingerprint(shingle_hashes(text, size)) for text in batch.column(1).to_pylist()]
            values = pa.array(np.array(found, dtype=np.uint64).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), values], names=["id", "node"])

    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """`(id, node)`: the fingerprint of every row's whole text as a signed number. NULL and empty texts have 0."""
    rows = small_batches(docs).select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_fingerprint_rows(size), "id long, node long")


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def _distance(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Distinct links `(a, b)` between 64-bit nodes that differ in at most `radius` bits.

    `radius` is even. `nodes` holds every `node` once. In a bucket of more than `PAIRED`
    nodes, those around a centre are linked with the first of them, which
    connects what all their pairs would connect.
    """
    if radius < 0 or radius % 2:
        raise ValueError("the radius must be an even number")
    kept = [_signed(m) for m in masks(radius)]
    keys = F.array(*[F.col("node").bitwiseAND(F.lit(m)) for m in kept])
    postings = nodes.select("node", F.posexplode(keys).alias("table", "key"))
    buckets = postings.groupBy("table", "key").agg(F.count("*").alias("size")).filter("size > 1")
    shared = stage(postings.join(buckets, ["table", "key"]), "simhash-buckets")

    few = shared.filter(F.col("size") <= PAIRED).select("table", "key", "node")
    pairs = few.withColumnRenamed("node", "a").join(few.withColumnRenamed("node", "b"), ["table", "key"])
    near = pairs.filter((F.col("a") < F.col("b")) & (_distance("a", "b") <= radius)).select("a", "b")

    steps = [_changes(m, radius // 2) for m in masks(radius)]
    change = F.get(F.array(*[F.array(*[F.lit(_signed(c)) for c in step]) for step in steps]), F.col("table"))
    around = (
        shared.filter(F.col("size") > PAIRED)
        .select("table", "node", F.explode(F.transform(change, lambda c: F.col("node").bitwiseXOR(c))).alias("centre"))
        .groupBy("table", "centre")
        .agg(F.array_sort(F.collect_list("node")).alias("members"))  # as many as a centre has changes at most
        .filter(F.size("members") > 1)
        .select(F.get("members", F.lit(0)).alias("a"), F.explode(F.slice("members", F.lit(2), F.size("members"))).alias("b"))
    )
    return near.unionByName(around).distinct()


def _changes(mask: int, most: int) -> list[int]:
    """All ways to change up to `most` of the places that a mask drops."""
    dropped = [1 << i for i in range(BITS) if not mask >> i & 1]
    return [sum(some) for count in range(most + 1) for some in combinations(dropped, count)]


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE, radius: int = RADIUS
) -> DataFrame:
    """`(id, fingerprint, component_id, kept)`, one row per row of `docs`; the fingerprint has 16 hexadecimal digits.

    Fingerprints that differ in at most `radius` bits are linked; `component_id` is
    the smallest id that can be reached, `kept` marks the rows with that id. NULL and empty
    texts and texts of white space have the fingerprint 0 and are linked like any other. NULL
    ids come after all others: a group of them alone has a NULL `component_id`. Rows with an
    id that repeats are marked alike if their texts are linked. An empty table gives no rows;
    only the two named columns are read.
    """
    signed = stage(fingerprints(docs, id_col, text_col, size), "simhash-fingerprints")
    least = F.min(F.struct(F.col("id").isNull().alias("none"), "id")).alias("least")
    nodes = stage(signed.groupBy("node").agg(least), "simhash-nodes")
    found = stage(links(nodes.select("node"), radius), "simhash-links")
    groups = components(found)
    named = nodes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    named = stage(named, "simhash-groups")
    smallest = stage(named.groupBy("component").agg(F.min("least").alias("best")), "simhash-smallest")
    by_node = stage(
        named.join(smallest, "component").select("node", F.col("best.id").alias("component_id")), "simhash-components"
    )
    return signed.join(by_node, "node").select(
        "id",
        F.lpad(F.lower(F.hex("node")), BITS // 4, "0").alias("fingerprint"),
        "component_id",
        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
