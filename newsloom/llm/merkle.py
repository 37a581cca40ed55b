"""A Merkle manifest of a data set: trees by key, proofs by a recursive query.

Leaves are digests of rows. The leaves of one key, in the order of their ids, are
taken eight at a time to nodes, nodes to higher nodes, and so on to the key's subroot;
the subroots, in the order of the keys, likewise to the root. Levels are built one after
another and written as rows that name their parent. A proof is made by climbing: a
recursive query takes every leaf to its parent, appends the other digests of the
run and folds the leaf's own digest, as claimed, into the parent's, level by level.

At the top all leaves meet in few nodes. A node is therefore copied for every block of
leaves below it, and leaves climb with the number of their block, so no task
gets more than one block's leaves for a key. Copies are few: a level has one per block at most, and one per node.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.operators.positions import number_by
from newsloom.staging import stage

FAN = 8
HEX = 64
#: Leaves of a block; more for so many leaves that a node would get over `MOST_BLOCKS` copies.
BLOCK = 512
MOST_BLOCKS = 1 << 20
#: The tree above the subroots, and the height of its first nodes.
TOP, TOP_HEIGHT = -1, 100

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


@dataclass(frozen=True)
class Manifest:
    """Written tables: `leaves` (position, tree, ordinal, size of the tree, key, id, leaf, claimed if it differs, and the
    parent's key and the place in its run), `nodes` (a row per inner node: tree, height, ordinal, run, the parent's
    key, the place in its run, first and last position), and `subroots` (tree, subroot). Digests are bytes but for the subroots;
    `run` holds those of a node's children one after another. `root` is None without rows.
    """

    leaves: DataFrame
    nodes: DataFrame
    subroots: DataFrame
    root: str | None
    rows: int


def digest(*parts: Column) -> Column:
    """Lowercase hexadecimal SHA-256 of the concatenated parts."""
    return F.sha2(F.concat(*parts) if len(parts) > 1 else parts[0], 256)


def leaf(fields: list[Column]) -> Column:
    """The digest of a row: every field as its UTF-8 length, a colon and its text, or `-` for NULL."""
    texts = [f.cast("string") for f in fields]
    return digest(*[F.coalesce(F.concat(F.octet_length(t), F.lit(":"), t), F.lit("-")) for t in texts])


def rows_of(
    docs: DataFrame,
    fields: tuple[str, ...] = FIELDS,
    id_col: str = "doc_id",
    key_col: str = "lang",
    changed: dict[str, Column] | None = None,
) -> DataFrame:
    """`(key, id, leaf, claimed)`: every row's digest, and that of the row with the `changed` columns."""
    own = leaf([F.col(f) for f in fields])
    claimed = leaf([changed.get(f, F.col(f)) for f in fields]) if changed else own
    return docs.select(
        F.col(key_col).cast("string").alias("key"), F.col(id_col).alias("id"), own.alias("leaf"), claimed.alias("claimed")
    )


def _link(columns: list[str], height: Column, ordinal: Column, size: Column, many: bool) -> list[Column]:
    """The parent's tree, height and ordinal, and the place in its run, of a node whose level has `size` nodes."""
    inside = size > 1
    top = F.lit(many) & (F.col("tree") != TOP)
    to_tree = F.when(inside, F.col("tree")).when(top, TOP)
    to_height = F.when(inside, height + 1).when(top, TOP_HEIGHT)
    at = F.when(inside, ordinal).when(top, F.col("tree"))
    to_ordinal = F.floor(at / FAN).cast("long")
    return [*columns, to_tree.cast("long").alias("to_tree"), to_height.cast("int").alias("to_height"),
            to_ordinal.alias("to_ordinal"), (at % FAN).cast("int").alias("place")]


def _levels(level: DataFrame, most: int, height: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """All levels above one of `(tree, ordinal, size, first, last, digest)` rows, and the levels' last nodes.

    `size` counts the nodes of the tree's level, `most` is the largest one.
    """
    inner, roots = [], []
    while True:
        roots.append(level.filter("size = 1").select("tree", "digest", "first", "last"))
        if most <= 1:
            return inner, roots
        runs = level.filter("size > 1").groupBy("tree", F.floor(F.col("ordinal") / FAN).cast("long").alias("ordinal")).agg(
            # At most FAN digests.
            F.array_join(F.transform(
                F.array_sort(F.collect_list(F.struct("ordinal", "digest"))), lambda c: c["digest"]), "").alias("run"),
            F.ceil(F.max("size") / FAN).cast("long").alias("size"),
            F.min("first").alias("first"),
            F.max("last").alias("last"),
        )
        level = stage(runs.withColumn("digest", digest(F.col("run"))), "merkle-level")
        inner.append(level.withColumn("height", F.lit(height)))
        most, height = -(-most // FAN), height + 1


def build(rows: DataFrame) -> Manifest:
    """The trees over `(key, id, leaf, claimed)` rows: keys in bytewise order, NULL first, and ids ascending in each.

    NULL ids come before others, equal ids are in the order of their digests; rows equal in all are
    separate leaves. Every table is written, and no key's rows meet in one task.
    """
    order = F.concat(F.when(F.col("key").isNull(), "0").otherwise("1"), F.coalesce("key", F.lit("")))
    digests = rows.select("key", "id", F.unhex("leaf").alias("leaf"), F.unhex("claimed").alias("claimed"))
    differing = F.when(F.col("leaf") != F.col("claimed"), F.col("claimed"))
    marked = digests.withColumns({"claimed": differing, "_order": order, "_mark": F.monotonically_increasing_id()})
    marked = stage(marked, "merkle-digests")
    by = [F.col("_order"), F.col("id").asc_nulls_first(), F.col("leaf"), F.col("claimed"), F.col("_mark")]
    numbered = number_by(marked, by).drop("_mark")
    keys = numbered.groupBy("_order").agg(F.count("*").alias("size"), F.min("position").alias("start"))
    trees = number_by(keys, [F.col("start")]).withColumnRenamed("position", "tree")
    trees = stage(trees, "merkle-trees")
    sizes = trees.agg(F.coalesce(F.max("size"), F.lit(0)).alias("most"), F.count("*").alias("trees"),
                      F.coalesce(F.sum("size"), F.lit(0)).alias("rows")).first()

    many = sizes.trees > 1
    placed = numbered.join(trees, "_order").withColumn("ordinal", F.col("position") - F.col("start"))
    columns = ["position", "tree", "ordinal", "size", "key", "id", "leaf", "claimed"]
    leaves = stage(placed.select(*_link(columns, F.lit(0), F.col("ordinal"), F.col("size"), many)), "merkle-leaves")

    ends = {"first": F.col("position"), "last": F.col("position"), "digest": _hex("leaf")}
    lowest = leaves.withColumns(ends).select("tree", "ordinal", "size", "first", "last", "digest")
    inner, roots = _levels(lowest, sizes.most, 1)
    found = roots[0]
    for one in roots[1:]:
        found = found.unionByName(one)
    subroots = stage(found, "merkle-subroots")
    above = subroots.select(
        F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("ordinal"),
        F.lit(sizes.trees).cast("long").alias("size"), "first", "last", "digest")
    higher, tops = _levels(above, sizes.trees, TOP_HEIGHT)
    root = tops[-1].first()

    empty = "tree long, ordinal long, run string, size long, first long, last long, digest string, height int"
    nodes = rows.sparkSession.createDataFrame([], empty)
    for level in inner + higher:
        nodes = nodes.unionByName(level)
    columns = ["tree", "height", "ordinal", "first", "last", F.unhex("run").alias("run")]
    nodes = nodes.select(*_link(columns, F.col("height"), F.col("ordinal"), F.col("size"), many))
    return Manifest(
        leaves, stage(nodes, "merkle-nodes"), subroots.select("tree", F.col("digest").alias("subroot")),
        root.digest if root else None, sizes.rows)


#: Every leaf climbs, step 0 being the leaf as claimed, until it has no parent. What lies beside the way from a run's
#: node up is the same for all leaves of the run, so the run's first leaf appends it for them, from step `since` on.
CLIMB = f"""
WITH RECURSIVE climb(position, block, step, since, tree, height, ordinal, place, folded, siblings) AS (
  SELECT position, position DIV {{block}}, 0, since, to_tree, to_height, to_ordinal, place, claimed, CAST(NULL AS BINARY)
  FROM {{leaves}}
  UNION ALL
  SELECT position, block, step + 1, since, to_tree, to_height, to_ordinal, next_place,
    unhex(sha2(concat(substr(run, 1, place * {HEX}), lower(hex(folded)), substr(run, (place + 1) * {HEX} + 1)), 256)),
    CASE WHEN step + 1 >= since THEN unhex(concat(substr(run, 1, place * {HEX}), substr(run, (place + 1) * {HEX} + 1))) END
  FROM (SELECT c.position, c.block, c.step, c.since, c.place, c.folded, lower(hex(n.run)) AS run,
      n.to_tree, n.to_height, n.to_ordinal, n.place AS next_place
    FROM climb c JOIN {{nodes}} n
      ON c.tree = n.tree AND c.height = n.height AND c.ordinal = n.ordinal AND c.block = n.block)
)
SELECT position, step, CASE WHEN tree IS NULL THEN folded END AS folded, siblings
FROM climb WHERE tree IS NULL OR siblings IS NOT NULL
"""


@contextmanager
def _any_number_of_rows(spark: SparkSession) -> Iterator[None]:
    """Spark ends recursive queries of over a million rows; here rows are bounded by leaves and levels."""
    name = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "-1")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def climbed(manifest: Manifest) -> DataFrame:
    """`(position, step, folded, siblings)`: the root each claimed leaf leads to, and the siblings that each step of a
    run's first leaf appended."""
    spark = manifest.leaves.sparkSession
    block = max(BLOCK, -(-manifest.rows // MOST_BLOCKS))
    blocks = F.sequence(F.floor(F.col("first") / block), F.floor(F.col("last") / block)).cast("array<long>")
    nodes = stage(manifest.nodes.withColumn("block", F.explode(blocks)).drop("first", "last"), "merkle-copies")
    leaves = manifest.leaves.withColumns({
        # A leaf that is alone in its tree has no run below the top, and keeps all that it meets.
        "since": F.when(F.col("size") == 1, 1).when(F.col("place") == 0, 2),
        "claimed": F.coalesce("claimed", "leaf"),
    })
    with _any_number_of_rows(spark):
        return stage(spark.sql(CLIMB.replace("{block}", str(block)), leaves=leaves, nodes=nodes), "merkle-climb")


def _hex(value: str) -> Column:
    return F.lower(F.hex(value))


def verified(manifest: Manifest) -> DataFrame:
    """`(id, key, leaf, subroot, root, proof_sha256, folded_root, verified)`, one row per leaf.

    `proof_sha256` is the digest of all siblings from the leaf to the root, `folded_root` the root that the
    claimed leaf leads to with them, `verified` whether that is the manifest's. All else is as the manifest has it.
    """
    climb = climbed(manifest)
    root = F.lit(manifest.root).cast("string")
    steps = F.array_sort(F.collect_list(F.struct("step", _hex("siblings").alias("siblings"))))  # one per level
    above = climb.filter("siblings IS NOT NULL").groupBy(F.col("position").alias("head")).agg(
        F.array_join(F.transform(steps, lambda s: s["siblings"]), "").alias("above")
    )
    runs = manifest.nodes.filter("height = 1").select(F.col("first").alias("head"), _hex("run").alias("run"))
    shared = stage(runs.join(above, "head", "full"), "merkle-shared")
    head = F.when(F.col("size") == 1, F.col("position")).otherwise(F.col("position") - F.col("place"))
    leaves = manifest.leaves.select("position", "tree", "key", "id", "leaf", "place", head.alias("head"))
    inside = F.concat(F.expr(f"substr(run, 1, place * {HEX})"), F.expr(f"substr(run, (place + 1) * {HEX} + 1)"))
    proof = digest(F.coalesce(inside, F.lit("")), F.coalesce("above", F.lit("")))
    folded = climb.filter("folded IS NOT NULL").select("position", _hex("folded").alias("folded_root"))
    return (
        leaves.join(folded, "position")
        .join(shared, "head", "left")
        .join(manifest.subroots, "tree")
        .select(
            "id", "key", _hex("leaf").alias("leaf"), "subroot", root.alias("root"), proof.alias("proof_sha256"), "folded_root",
            (F.col("folded_root") == root).alias("verified"))
    )
