"""Personal data: patterns with checks, and terms that corpus co-occurrence shows to disclose them.

E-mail and IP addresses, card and phone numbers are found by patterns. Such
values are the protected entities. For words near an entity the corpus tells
how strongly they reveal it: pointwise mutual information of word and entity,
as a share of the entity's own information content. Words that come up beside
an entity in several different contexts, and hardly anywhere else, exceed the
threshold and are generalised in all documents, also in those that hold no entity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.scores import with_value
from newsloom.llm.tables import free, small
from newsloom.staging import stage

# The patterns match what their plain forms match; possessive parts and the look-behinds only
# keep long runs from being scanned again from each of their characters.
EMAIL = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[ -]?[0-9])++"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"

#: Kinds in the order of results, with a cheap test that a text may hold one.
KINDS = ("email", "ip", "card", "phone")
TERM = "term"
PATTERNS = {"email": EMAIL, "ip": IP, "card": CARD, "phone": PHONE}
MAYBE = {
    "email": lambda text: text.contains("@"),
    "ip": lambda text: text.rlike(r"[0-9]\.[0-9]++\.[0-9]"),
    "card": lambda text: text.rlike(r"[0-9](?:[ -]?[0-9]){12}"),
    "phone": lambda text: text.contains("+"),
}

#: Words on each side of an entity that count as its context.
CONTEXT_WORDS = 5
CONTEXT_CHARS = 120
#: Different contexts in which a word must stand beside an entity.
LEAST_CONTEXTS = 2
#: Share of an entity's information that a word may give away.
DISCLOSURE = 0.8

SPANS = "array<struct<kind:string,start:long,end:long,value:string>>"


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """The check digit test of card numbers."""

    def doubled(digit: Column, place: Column) -> Column:
        twice = digit.cast("int") * 2
        return F.when(place % 2 == 0, digit.cast("int")).otherwise(twice - F.when(twice > 9, 9).otherwise(0))

    each = F.transform(F.filter(F.split(F.reverse(number), ""), lambda d: d != ""), doubled)
    return F.aggregate(each, F.lit(0), lambda total, d: total + d) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    if kind == "ip":
        return F.forall(
            F.split(value, r"\."),
            lambda part: F.length(F.ltrim(part, F.lit("0"))).between(0, 3)
            & (F.coalesce(F.substring(F.ltrim(part, F.lit("0")), 1, 3).try_cast("int"), F.lit(0)) <= 255),
        )
    if kind == "card":
        return F.length(digits(value)).between(13, 19) & luhn(digits(value))
    if kind == "phone":
        return F.length(digits(value)).between(9, 15)
    return F.lit(True)


def located(text: Column, pattern: Column, kind: str) -> Column:
    """Spans of the valid matches of a pattern, by code points.

    The pattern also splits the text; the lengths of what lies between and of the
    matches before give a match's place.
    """

    def spans(matches: Column) -> Column:
        def placed(between: Column) -> Column:
            def chars(parts: Column, most: Column) -> Column:
                return F.aggregate(
                    F.slice(parts, F.lit(1), most), F.lit(0).cast("long"), lambda total, p: total + F.char_length(p)
                )

            def span(index: Column) -> Column:
                start = chars(between, index + 1) + chars(matches, index)
                value = F.get(matches, index)
                return F.struct(
                    F.lit(kind).alias("kind"),
                    start.alias("start"),
                    (start + F.char_length(value)).alias("end"),
                    value.alias("value"),
                )

            chosen = F.filter(
                F.transform(matches, lambda m, i: F.when(valid(kind, m), i)), lambda index: index.isNotNull()
            )
            return F.transform(chosen, span)

        return F.when(F.size(matches) > 0, with_value(F.split(text, pattern), placed))

    return with_value(F.regexp_extract_all(text, pattern, 0), spans)


def base_spans(text: Column) -> Column:
    """Spans of all kinds, by kind and then by start; `text` must not be NULL."""
    empty = F.array().cast(SPANS)
    parts = [
        F.coalesce(F.when(MAYBE[kind](text), located(text, F.lit(PATTERNS[kind]), kind)), empty) for kind in KINDS
    ]
    return F.concat(*parts)


def maybe(text: Column) -> Column:
    """Whether any kind may be found."""
    found = F.lit(False)
    for kind in KINDS:
        found = found | MAYBE[kind](text)
    return found


def listed(spans: Column) -> Column:
    """`kind:start:end`, comma-joined."""
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"))
        ),
        ",",
    )


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}]+"), "")


def contexts(entities: DataFrame) -> DataFrame:
    """`(entity, term, context)` from rows `(row, text, spans)`: the words beside each span."""
    each = entities.select("row", "text", F.explode("spans").alias("span"))
    value = F.col("span.value")
    name = F.concat(
        F.col("span.kind"),
        F.lit(":"),
        F.when(F.col("span.kind").isin("card", "phone"), digits(value)).otherwise(F.lower(value)),
    )
    first = F.greatest(F.col("span.start") - CONTEXT_CHARS, F.lit(0))
    before = F.substring("text", (first + 1).cast("int"), (F.col("span.start") - first).cast("int"))
    after = F.substring("text", (F.col("span.end") + 1).cast("int"), F.lit(CONTEXT_CHARS))
    near = each.select(
        "row",
        name.alias("entity"),
        F.reverse(F.slice(F.reverse(words(before)), 1, CONTEXT_WORDS)).alias("left"),
        F.slice(words(after), 1, CONTEXT_WORDS).alias("right"),
    )
    return near.select(
        "row",
        "entity",
        F.xxhash64("left", "right").alias("context"),
        F.explode(F.array_distinct(F.concat("left", "right"))).alias("term"),
    )


def disclosing(rows: DataFrame, found: DataFrame, threshold: float, least: int) -> DataFrame:
    """`(term)` that give away an entity. `rows` holds all texts, `found` `(row, text, spans)` with entities.

    Counts cover all rows, each copy of a text too: how many hold the term, the entity, and the one beside the other.
    """
    copies = stage(found.groupBy("row").agg(F.count("*").alias("copies")), "pii-copies")
    beside = contexts(found).distinct()
    counted = beside.join(small(copies), "row")
    pairs = (
        counted.groupBy("entity", "term", "context")
        .agg(F.sum("copies").alias("rows"))
        .groupBy("entity", "term")
        .agg(F.count("*").alias("contexts"), F.sum("rows").alias("together"))
        .filter(F.col("contexts") >= least)
        .select("entity", "term", "together")
    )
    pairs = stage(pairs, "pii-pairs")
    terms = stage(pairs.select("term").distinct(), "pii-terms")
    holds = rows.select(F.explode(F.array_distinct(words(F.col("text")))).alias("term"))
    with_term = holds.join(small(terms), "term").groupBy("term").agg(F.count("*").alias("with_term"))
    holders = beside.select("row", "entity").distinct().join(small(copies), "row")
    with_entity = holders.groupBy("entity").agg(F.sum("copies").alias("with_entity"))
    total = rows.count()
    strength = F.ln(F.lit(float(total)) * F.col("together") / (F.col("with_term") * F.col("with_entity")))
    information = -F.ln(F.col("with_entity") / F.lit(float(total)))
    return (
        pairs.join(with_term, "term")
        .join(with_entity, "entity")
        .filter((information > 0) & (strength >= threshold * information))
        .select("term")
        .distinct()
    )


def annotate(
    docs: DataFrame,
    text_col: str = "text",
    threshold: float = DISCLOSURE,
    least: int = LEAST_CONTEXTS,
) -> DataFrame:
    """Add `spans` to every row: personal data by kind and start, then disclosing terms by start.

    NULL texts count as empty and have no spans. Rows are told apart by their
    text, so repeated rows and rows with NULL ids get the same spans as any
    other. All rows and columns stay; a column `spans` is replaced. Terms are
    looked for in all rows; a term inside an entity's span is no span of its own.
    """
    kept = [c for c in docs.columns if c.lower() != "spans"]
    row, base, found_terms = free(["_row", "_base", "_terms"], docs.columns)
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(text.alias("text"))
    with_spans = (
        docs.select(text.alias("text"))
        .filter(maybe(F.col("text")))
        .select(F.xxhash64("text").alias("row"), "text", base_spans(F.col("text")).alias("spans"))
    )
    found = stage(with_spans.filter(F.size("spans") > 0), "pii-found")
    terms = stage(disclosing(texts, found, threshold, least), "pii-disclosing")
    hits = (
        texts.select(F.xxhash64("text").alias("row"), F.explode(F.array_distinct(words(F.col("text")))).alias("term"))
        .join(small(terms), "term")
        .groupBy("row")
        .agg(F.array_sort(F.collect_set("term")).alias(found_terms))
    )
    hits = stage(hits.withColumnRenamed("row", row), "pii-hits")

    held = docs.select(*kept, F.xxhash64(text).alias(row), base_spans(text).alias(base))
    joined = held.join(small(hits), row, "left")
    pattern = F.concat(F.lit(r"(?iu)(?<!\p{L})(?:"), F.array_join(found_terms, "|"), F.lit(r")(?!\p{L})"))

    def apart(span: Column) -> Column:
        return ~F.exists(base, lambda b: (span["start"] < b["end"]) & (b["start"] < span["end"]))

    more = F.when(F.col(found_terms).isNotNull(), F.filter(located(text, pattern, TERM), apart))
    spans = F.concat(base, F.coalesce(more, F.array().cast(SPANS))).cast(SPANS)
    return joined.select(*kept, spans.alias("spans"))


def redacted(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans share one."""
    ordered = F.array_sort(
        F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    )
    first = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def add(done: Column, span: Column) -> Column:
        gap = F.substring(text, (done["at"] + 1).cast("int"), F.greatest(span["start"] - done["at"], F.lit(0)).cast("int"))
        mark = F.when(span["start"] >= done["at"], F.concat(F.lit("["), F.upper(span["kind"]), F.lit("]"))).otherwise("")
        return F.struct(
            F.greatest(done["at"], span["end"]).alias("at"), F.concat(done["out"], gap, mark).alias("out")
        )

    def close(done: Column) -> Column:
        return F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.lit(2**31 - 1)))

    return F.when(F.size(spans) > 0, F.aggregate(ordered, first, add, close)).otherwise(text)
