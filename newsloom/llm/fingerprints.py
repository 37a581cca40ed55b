"""Bottom-k sketches of word-shingle hashes: mergeable document fingerprints.

A fingerprint keeps the `K` smallest distinct hashes of a text's shingles, so the
fingerprint of a text put together from parts follows from theirs and that of
the words around the seam. Two of them estimate resemblance and containment, and one the
number of distinct shingles; texts with fewer than `K` shingles are measured exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.scores import with_value

SHINGLE = 5
K = 128
BITS = 48
HEX = BITS // 4

#: Buckets of neighbours, at most: a table with a row for each is small enough to send to all executors.
BUCKETS = 50_000
LEAST_BUCKET_ROWS = 2_048
#: Rows drawn for each bucket to find where buckets begin. They say where rows are sorted, never how.
DRAWN = 16
#: A border that no key lies below.
LOWEST = (False, 0, -(1 << 63))


def sketch(text: Column, size: int = SHINGLE, k: int = K) -> Column:
    """The `k` smallest distinct shingle hashes, ascending. NULL and empty texts have none.

    Words are lowered and parted by ASCII white space; fewer than `size` words
    make one shingle.
    """

    def hashed(words: Column) -> Column:
        def one(place: Column) -> Column:
            return F.shiftrightunsigned(F.xxhash64(*[F.get(words, place + i) for i in range(size)]), 64 - BITS)

        starts = F.sequence(F.lit(0), F.greatest(F.size(words) - size, F.lit(0)))
        return F.when(F.size(words) > 0, F.transform(starts, one)).otherwise(F.array().cast("array<long>"))

    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x20\x09-\x0D]+"), "")
    return bottom(with_value(words, hashed), k)


def bottom(hashes: Column, k: int = K) -> Column:
    return F.slice(F.sort_array(F.array_distinct(hashes)), 1, k)


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts taken together."""
    return bottom(F.concat(a, b), k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of common shingles; 1 for two empty sketches, 0 for one."""

    def share(both: Column) -> Column:
        common = F.size(F.array_intersect(F.array_intersect(both, a), b))
        return F.when(F.size(both) == 0, 1.0).otherwise(common / F.size(both))

    return with_value(merged(a, b, k), share)


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles, exact below `k`."""
    largest = F.get(a, F.lit(k - 1)) + 1
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(F.lit((k - 1) * 2.0**BITS) / largest)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first one's shingles that the second has; 1 when the first is empty."""
    near, size_a, size_b = resemblance(a, b, k), distinct_shingles(a, k), distinct_shingles(b, k)
    share = near / (1 + near) * (size_a + size_b) / size_a
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(share, F.lit(1.0)))


def as_text(a: Column) -> Column:
    """A sketch as text: twelve hexadecimal digits per hash."""
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), HEX, "0")), "")


def from_text(text: Column) -> Column:
    count = (F.char_length(text) / HEX).cast("int")
    places = F.filter(F.sequence(F.lit(0), F.greatest(count, F.lit(1)) - 1), lambda _: count > 0)
    return F.transform(places, lambda i: F.conv(F.substring(text, i * HEX + 1, F.lit(HEX)), 16, 10).cast("long"))


def _borders(keys: DataFrame, buckets: int, share: float) -> list[tuple]:
    """Keys `(there, id, tie)`, ascending, at which a drawn share of rows is cut into about equal buckets."""
    drawn = keys.sample(share, seed=1) if share < 1 else keys
    found = drawn.agg(F.sort_array(F.collect_list(F.struct("there", "id", "tie"))).alias("all"))
    step = F.greatest(F.ceil(F.size("all") / buckets), F.lit(1))
    cuts = F.filter("all", lambda _, i: (i > 0) & (i % step == 0))
    return [tuple(cut) for cut in found.select(cuts.alias("cuts")).first().cuts]


def _key(docs: DataFrame, id_col: str, tie: Column, kept: tuple[str, ...] = ()) -> DataFrame:
    ids = F.col(id_col).cast("long")
    number = F.coalesce(ids, F.lit(0).cast("long"))
    return docs.select(*kept, ids.isNotNull().alias("there"), number.alias("id"), tie.cast("long").alias("tie"))


def _cuts(docs: DataFrame, id_col: str, tie: Column) -> tuple[list[tuple], bool]:
    """Borders of buckets, ascending, and whether any id has so many rows that ties are cut too.

    Rows drawn by chance show how ids lie, whatever their range: a bucket holds about equally many
    rows beside an id far from all others, and ids are only compared. An id that fills a bucket
    is cut again by the hash of what its rows hold.
    """
    rows = docs.count()
    buckets = min(BUCKETS, -(-rows // LEAST_BUCKET_ROWS))
    if buckets < 2:
        return [], False
    share = min(1.0, buckets * DRAWN / rows)
    cuts = _borders(_key(docs, id_col, F.lit(0)), buckets, share)
    heavy = sorted({a for a, b in zip(cuts, cuts[1:], strict=False) if a == b})
    if not heavy:
        return sorted(set(cuts)), False
    known = F.broadcast(docs.sparkSession.createDataFrame(heavy, "there boolean, id long, tie long").drop("tie"))
    ties = _borders(_key(docs, id_col, tie).join(known, ["there", "id"]), sum(c in heavy for c in cuts), share)
    least = [(there, number, -(1 << 63)) for there, number, _ in heavy]
    return sorted({*(c for c in cuts if c not in heavy), *ties, *least}), True


def _longs(values: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<long>")


def _bucket(cuts: list[tuple]) -> Column:
    """The number of borders that are not above the row's key: halving steps over their sorted list."""
    cuts = cuts or [LOWEST]
    there, ids, ties = (_longs([int(c[i]) for c in cuts]) for i in range(3))
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(cuts).bit_length()))])

    def further(at: Column, step: Column) -> Column:
        place = at + step - 1
        border = F.struct(F.get(there, place), F.get(ids, place), F.get(ties, place))
        own = F.struct(F.col("there").cast("long"), F.col("id"), F.col("tie"))
        return F.when((at + step <= len(cuts)) & (border <= own), at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), further).cast("long")


def with_next(docs: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """Add `next_<column>` of the next row by descending id; the last row is followed by the first.

    Ids are ranged into buckets, so rows with text are shuffled once. A bucket's
    first row is sent to the bucket before it as well, whose last row it
    follows. `docs` must have no columns `there`, `id` and `tie`. Ties go by the hash of the first of the columns, then by the order of all; NULL ids come
    last. Ids may be any 64-bit numbers, far apart or repeated; only rows alike in id and
    first column share a bucket however many they are.
    """
    spark = docs.sparkSession
    tie = F.xxhash64(columns[0])
    cuts, tied = _cuts(docs, id_col, tie)
    own_tie = tie if tied else F.lit(0)
    key = F.struct("there", "id", "tie")

    def bucketed(df: DataFrame) -> DataFrame:
        return df.withColumn("_bucket", _bucket(cuts))

    tops = bucketed(_key(docs, id_col, own_tie)).groupBy("_bucket").agg(F.max(key).alias("top")).collect()
    firsts = sorted((r["_bucket"], tuple(r["top"])) for r in tops)  # one row per bucket
    above = [b for b, _ in firsts[1:]] + [b for b, _ in firsts[:1]]
    heads = [(b, top, receiver) for (b, top), receiver in zip(firsts, above, strict=True)]
    shape = "_bucket long, _top struct<there:boolean,id:long,tie:long>, _receiver long"
    heads = F.broadcast(spark.createDataFrame(heads, shape))
    targets = F.filter(
        F.array(
            F.struct(F.col("_bucket").alias("bucket"), F.lit(False).alias("copy")),
            F.struct(F.col("_receiver").alias("bucket"), F.lit(True).alias("copy")),
        ),
        lambda t: ~t["copy"] | (key == F.col("_top")),
    )
    names = docs.columns
    ids = F.col(id_col).cast("long")
    sent = (
        bucketed(_key(docs, id_col, own_tie, tuple(names)))
        .join(heads, "_bucket")
        .select(*names, F.explode(targets).alias("_to"))
        .select(*names, F.col("_to.bucket").alias("_bucket"), F.col("_to.copy").alias("_copy"))
    )
    order = Window.partitionBy("_bucket").orderBy("_copy", ids.desc_nulls_last(), tie.desc(), *columns)
    following = {f"next_{c}": F.lead(c).over(order) for c in columns}
    return sent.withColumns(following).filter(~F.col("_copy")).drop("_bucket", "_copy")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of all texts and of their edited texts, with estimates of likeness.

    The edited text ends in as much of the next document (by descending id) as
    its second half, or all of it. NULL texts are empty; an empty text's fingerprint is the empty string.
    One row per row; an empty table gives none. Other columns are not read.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    both = with_next(rows.withColumn("own", sketch(F.col("text"))), "doc_id", ["text", "own"])
    chars = F.char_length("text")
    half = F.floor(chars / 2).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), chars - half), F.substring("next_text", F.lit(1), half)
    )
    changed = both.select("doc_id", chars.cast("long").alias("n_chars"), "own", "next_own", edited.alias("edited"))
    sketched = changed.select("*", sketch(F.col("edited")).alias("new"))
    return sketched.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("new")).alias("edited_fingerprint"),
        resemblance(F.col("own"), F.col("new")).alias("near_edited"),
        resemblance(F.col("own"), F.col("next_own")).alias("near_next"),
        distinct_shingles(F.col("own")).alias("distinct_shingles"),
        containment(F.col("own"), F.col("new")).alias("contained_in_edited"),
    )
