"""Benchmark decontamination by template windows and slot consistency.

A text becomes a template: numbers, units after a number, and names inside a
sentence turn into typed placeholders, other words are lowered. Windows of
`WINDOW` template tokens are hashed and joined with those of the benchmark. A document holds an item
when enough of the item's windows are found in it and the slots agree: wherever
the item repeats a value, the document must repeat one too. So a question asked
again with other numbers or names is caught, and boilerplate with the same
frame but freely changing values is not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.functions.scores import with_value
from newsloom.llm.tables import free, small
from newsloom.staging import stage

WINDOW = 5
#: Words of a window that are no placeholders, at least; a table of numbers is no template.
LEAST_WORDS = 2
COVERAGE = 0.8
CONSISTENCY = 0.8
#: Template tokens by which parts of one occurrence of an item may be shifted.
SHIFT = 3

#: Unit words, as they follow a number.
UNITS = (
    "%", "percent", "mm", "cm", "m", "km", "meters", "metres", "miles", "mile", "feet", "foot", "inches", "inch",
    "mg", "g", "kg", "grams", "pounds", "lb", "ml", "l", "liters", "litres", "s", "sec", "seconds", "min", "minutes",
    "h", "hours", "hour", "days", "day", "weeks", "years", "year", "mph", "kmh", "dollars", "euros", "cents", "usd", "eur",
)

#: Placeholder tokens. No digit of a text survives, so they cannot be spelled by one.
NUMBER, NAME, UNIT = "0", "1", "2"

NUMBERS = r"[0-9]+(?:[.,][0-9]+)*"
UNIT_AFTER = rf"(?i)( {NUMBER} )\s*({'|'.join(UNITS)})([^\p{{L}}]|$)"
NAME_INSIDE = r"([\p{Ll},;:]\s)(\p{Lu}\p{L}*)"


def numbered(text: Column) -> Column:
    return F.regexp_replace(text, NUMBERS, f" {NUMBER} ")


def tokens(text: Column) -> Column:
    """Template tokens of a whole text; NULL and empty texts have none."""
    marked = F.regexp_replace(numbered(F.coalesce(text, F.lit(""))), UNIT_AFTER, f"$1 {UNIT} $3")
    named = F.regexp_replace(marked, NAME_INSIDE, f"$1 {NAME} ")
    return F.array_remove(F.split(F.lower(named), r"[^\p{L}012]+"), "")


def windows(text: Column, size: int = WINDOW) -> Column:
    """Hash of every window of template tokens, in order; NULL where a window has too few words.

    A text with fewer tokens than `size` has one window, all of them.
    """

    def hashed(all_tokens: Column) -> Column:
        def one(place: Column) -> Column:
            parts = [F.get(all_tokens, place + i) for i in range(size)]
            words = sum(F.when(part.isin(NUMBER, NAME, UNIT), 0).otherwise(1) for part in parts)
            return F.when(words >= LEAST_WORDS, F.xxhash64(*parts))

        last = F.size(all_tokens) - size
        return F.when(
            F.size(all_tokens) > 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), one)
        ).otherwise(F.array().cast("array<long>"))

    return with_value(tokens(text), hashed)


def slots(text: Column) -> Column:
    """`array<struct<place, kind, value>>`: every placeholder of a template with the text it stands for."""
    marked = F.regexp_replace(numbered(text), UNIT_AFTER, f"$1 {UNIT} $3")

    def of(all_tokens: Column, kind: str, values: Column) -> Column:
        places = F.filter(
            F.transform(all_tokens, lambda t, i: F.when(t == kind, i)), lambda place: place.isNotNull()
        )
        return F.zip_with(
            places,
            values,
            lambda place, value: F.struct(place.alias("place"), F.lit(kind).alias("kind"), F.lower(value).alias("value")),
        )

    def found(all_tokens: Column) -> Column:
        return F.filter(
            F.concat(
                of(all_tokens, NUMBER, F.regexp_extract_all(text, F.lit(NUMBERS), 0)),
                of(all_tokens, UNIT, F.regexp_extract_all(numbered(text), F.lit(UNIT_AFTER), 2)),
                of(all_tokens, NAME, F.regexp_extract_all(marked, F.lit(NAME_INSIDE), 2)),
            ),
            lambda slot: slot["place"].isNotNull() & slot["value"].isNotNull(),
        )

    return with_value(tokens(text), found)


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    coverage: float = COVERAGE,
    consistency: float = CONSISTENCY,
) -> DataFrame:
    """`(id, text_hash, item_id, coverage, consistency, changed)`: items that documents hold.

    One row per document, told by id and text, and item. `coverage` is the share of
    the item's distinct windows found, `consistency` the share of slot values that are
    replaced in one way only (1 without slots), in the whole document or in the best single
    occurrence that has enough of the windows; `changed` whether any value there
    differs from the item's. Items without words, and rows without text, have no
    windows and are never part of a row; equal items are each reported. Repeated rows of a
    document count once. NULL ids are compared like values.
    """
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text"))
    spread = items.select("item_id", F.posexplode(windows(F.col("text"))).alias("item_place", "window"))
    spread = stage(spread.filter("window IS NOT NULL"), "benchmark-windows")
    totals = spread.groupBy("item_id").agg(F.count_distinct("window").alias("windows"))

    keyed = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.xxhash64(F.col(text_col).cast("string")).alias("text_hash"),
        F.col(text_col).cast("string").alias("text"),
    )
    placed = keyed.select("id", "text_hash", F.posexplode(windows(F.col("text"))).alias("place", "window"))
    hits = stage(placed.join(small(spread), "window").distinct(), "benchmark-hits")
    key = ["id", "text_hash", "item_id"]
    covered = (
        hits.groupBy(*key)
        .agg(F.count_distinct("window").alias("found"))
        .join(totals, "item_id")
        .withColumn("coverage", F.col("found") / F.col("windows"))
        .filter(F.col("coverage") >= coverage)
        .select(*key, "coverage")
    )
    covered = stage(covered, "benchmark-covered")

    item_slots = items.select("item_id", F.inline(slots(F.col("text")))).toDF("item_id", "slot", "kind", "item_value")
    item_slots = stage(item_slots, "benchmark-slots")
    if item_slots.isEmpty():
        return covered.withColumns({"consistency": F.lit(1.0), "changed": F.lit(False)})
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in ("id", "text_hash")]
    held = covered.select("id", "text_hash").distinct()
    doc_slots = (
        keyed.distinct()
        .alias("l")
        .join(held.alias("r"), same, "left_semi")
        .select("id", "text_hash", F.inline(slots(F.col("text"))))
        .toDF("id", "text_hash", "slot", "kind", "value")
    )
    both = [F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}")) for c in key]
    here = hits.alias("l").join(covered.alias("r"), both, "left_semi")
    here = stage(here.withColumn("offset", F.col("place") - F.col("item_place")), "benchmark-here")
    # An occurrence: hits of one offset, or of offsets that follow each other closely. The whole document is one more.
    in_order = Window.partitionBy(*key).orderBy("offset")
    apart = F.coalesce(F.col("offset") - F.lag("offset").over(in_order) > SHIFT, F.lit(True)).cast("long")
    runs = here.select(*key, "offset").distinct().withColumn("apart", apart)
    runs = runs.select(*key, "offset", F.sum("apart").over(in_order).alias("run"))
    near = [*both, F.col("l.offset") == F.col("r.offset")]
    found = here.alias("l").join(runs.alias("r"), near).select("l.*", "r.run")
    found = found.withColumn(
        "part",
        F.explode(F.array(F.lit("all"), F.concat(F.lit("at "), F.col("offset")), F.concat(F.lit("run "), F.col("run")))),
    )
    enough = (
        found.groupBy(*key, "part")
        .agg(F.count_distinct("window").alias("found"))
        .join(totals, "item_id")
        .filter(F.col("found") / F.col("windows") >= coverage)
        .select(*key, "part")
    )
    enough = stage(enough, "benchmark-parts")
    each = [*both, F.col("l.part") == F.col("r.part")]
    aligned = (
        found.alias("l")
        .join(enough.alias("r"), each, "left_semi")
        .join(item_slots, "item_id")
        .filter(F.col("slot").between(F.col("item_place"), F.col("item_place") + WINDOW - 1))
        .select(*key, "part", "kind", "item_value", (F.col("slot") + F.col("offset")).alias("slot"))
        .distinct()
    )
    pairs = (
        aligned.alias("l")
        .join(
            doc_slots.alias("r"),
            [*same, F.col("l.slot") == F.col("r.slot"), F.col("l.kind") == F.col("r.kind")],
        )
        .select("l.id", "l.text_hash", "l.item_id", "l.part", "l.kind", "l.item_value", "r.value")
    )
    agreed = (
        pairs.groupBy(*key, "part", "kind", "item_value")
        .agg(F.count_distinct("value").alias("values"), F.max(F.col("value") != F.col("item_value")).alias("other"))
        .groupBy(*key, "part")
        .agg(F.avg(F.when(F.col("values") == 1, 1.0).otherwise(0.0)).alias("consistency"), F.max("other").alias("changed"))
    )
    best = (
        enough.alias("l")
        .join(agreed.alias("r"), each, "left")
        .select(
            *[F.col(f"l.{c}") for c in key],
            F.struct(
                (-F.coalesce("consistency", F.lit(1.0))).alias("less"),
                F.coalesce("changed", F.lit(False)).alias("changed"),
            ).alias("one"),
        )
        .groupBy(*key)
        .agg(F.min("one").alias("one"))
        .select(*key, (-F.col("one.less")).alias("consistency"), F.col("one.changed").alias("changed"))
    )
    return (
        covered.alias("l")
        .join(best.alias("r"), both)
        .select(*[F.col(f"l.{c}") for c in key], "coverage", "consistency", "changed")
        .filter(F.col("consistency") >= consistency)
    )


def flag(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Add `contaminated`, `leaked_items` (sorted ids) and `coverage` (the best) to every row of `docs`.

    All rows and columns stay; columns with those three names are replaced. An
    empty benchmark flags nothing.
    """
    found = leaks(docs, benchmark, id_col, text_col).groupBy("id", "text_hash").agg(
        F.array_sort(F.collect_set("item_id")).alias("leaked_items"), F.max("coverage").alias("coverage")
    )
    there, there_hash, here, here_hash = free(["_id", "_hash", "_doc", "_text"], docs.columns)
    found = stage(found.toDF(there, there_hash, "leaked_items", "coverage"), "benchmark-leaks")
    kept = [c for c in docs.columns if c.lower() not in ("contaminated", "leaked_items", "coverage")]
    match = F.col(there).eqNullSafe(F.col(here)) & (F.col(there_hash) == F.col(here_hash))
    rows = docs.select(
        *kept,
        F.col(id_col).cast("long").alias(here),
        F.xxhash64(F.col(text_col).cast("string")).alias(here_hash),
    )
    return rows.join(small(found), match, "left").select(
        *kept,
        F.col(there_hash).isNotNull().alias("contaminated"),
        F.coalesce("leaked_items", F.array().cast("array<long>")).alias("leaked_items"),
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
    )
