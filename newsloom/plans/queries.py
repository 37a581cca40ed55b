"""Every operator as a query over the given tables, with SQL for its check."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom import model_store
from newsloom.functions import scores as sc
from newsloom.functions import text as tx
from newsloom.functions.timestamps import parse_timestamp, timestamp_text
from newsloom.operators import (
    batches,
    calibration,
    cleaning,
    epochs,
    labels,
    metrics,
    naive_bayes,
    pipeline,
    scoring,
    subwords,
    vocabulary,
)
from newsloom.operators.positions import first_n, number_by, positions
from newsloom.operators.split import split_sizes
from newsloom.plans import jobs
from newsloom.plans import oracle as sql
from newsloom.sources import files
from newsloom.sources.articles import raw_records
from newsloom.staging import new_path, stage
from newsloom.streaming import progress
from newsloom.streaming.articles import classify_stream, clean_stream, read_parquet_stream, read_results

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(check: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if check:
            ORACLES[run.__name__] = check
        return run

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def fixed(value: Column) -> Column:
    """A number with six decimals."""
    return value.cast("decimal(9,6)")


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Articles with their language as category."""
    rows = table(spark, folder, "documents")
    return rows.select(F.col("doc_id").alias("id"), "text", "source", F.col("lang").alias("category"))


def coded(spark: SparkSession, folder: str) -> DataFrame:
    """All articles, with a label code 0-3 made of the two quality labels where there are any."""
    codes = table(spark, folder, "labels").select("doc_id", (F.col("quality") + 2 * F.col("toxic")).alias("label"))
    rows = table(spark, folder, "documents").join(codes, "doc_id", "left")
    return rows.select(F.col("doc_id").alias("id"), "text", "source", "label")


def named(spark: SparkSession, folder: str) -> DataFrame:
    """The same with the category name."""
    return coded(spark, folder).withColumn("category", labels.code_to_category(F.col("label"))).drop("label")


def news(spark: SparkSession, folder: str) -> DataFrame:
    """Articles of a known category, to train on."""
    return named(spark, folder).filter(F.col("category") != labels.NO_CATEGORY)


def turns(spark: SparkSession, folder: str) -> DataFrame:
    """Unlabelled texts; added to them are blank ones, some with ids that others have, and some without an id."""
    return with_planted_turns(table(spark, folder, "conversations"))


def with_planted_turns(rows: DataFrame) -> DataFrame:
    number = F.col("conv_id") * 1000 + F.col("turn")
    real = F.struct(number.alias("id"), F.col("text").alias("text"))
    blank = F.struct(number.alias("id"), F.lit(" \u00a0\t").alias("text"))
    nameless = F.struct(F.lit(None).cast("long").alias("id"), F.concat("text", F.lit(" more")).alias("text"))
    repeated = F.struct((number - 1).alias("id"), F.concat(F.lit("the "), "text").alias("text"))
    planted = F.when(F.col("turn") == 3, F.array(real, blank)).when(F.col("turn") == 1, F.array(real, nameless, repeated))
    return rows.select(F.inline(F.coalesce(planted, F.array(real))))


TURNS = """SELECT conv_id * 1000 + turn AS id, text FROM conversations
  UNION ALL SELECT conv_id * 1000 + turn, ' ' || chr(160) || chr(9) FROM conversations WHERE turn = 3
  UNION ALL SELECT NULL, text || ' more' FROM conversations WHERE turn = 1
  UNION ALL SELECT conv_id * 1000 + turn - 1, 'the ' || text FROM conversations WHERE turn = 1"""


# --- scalar functions -------------------------------------------------------


def _per_document(change: Callable[[Column], Column], out: str) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return table(spark, folder, "documents").select("doc_id", change(F.col("text")).alias(out))

    return run


@query(f"SELECT doc_id, {sql.clean('text')} AS cleaned_text FROM documents")
def clean_text(spark, folder):
    return _per_document(tx.clean_text, "cleaned_text")(spark, folder)


@query("SELECT doc_id, lower(text) AS lowered FROM documents")
def lowercase(spark, folder):
    return _per_document(F.lower, "lowered")(spark, folder)


@query(f"SELECT page_id, {sql.urls(chr(39) + 'see ' + chr(39) + ' || url || html')} AS stripped FROM pages")
def strip_urls(spark, folder):
    pages = table(spark, folder, "pages")
    return pages.select("page_id", tx.strip_urls(F.concat(F.lit("see "), "url", "html")).alias("stripped"))


@query(f"SELECT doc_id, {sql.mentions('text')} AS stripped FROM documents")
def strip_mentions(spark, folder):
    return _per_document(tx.strip_mentions, "stripped")(spark, folder)


@query(f"SELECT doc_id, {sql.hashtags('text')} AS stripped FROM documents")
def strip_hashtags(spark, folder):
    return _per_document(tx.strip_hashtags, "stripped")(spark, folder)


@query(f"SELECT doc_id, {sql.letters('lower(text)')} AS letters FROM documents")
def letters_only(spark, folder):
    return _per_document(lambda c: tx.letters_only(F.lower(c)), "letters")(spark, folder)


@query(f"SELECT doc_id, {sql.collapse('text')} AS collapsed FROM documents")
def collapse_ws(spark, folder):
    return _per_document(tx.collapse_spaces, "collapsed")(spark, folder)


@query(f"""SELECT doc_id, {sql.strip("chr(160) || ' ' || text || chr(8195) || chr(10)")} AS stripped FROM documents""")
def unicode_strip(spark, folder):
    return _per_document(
        lambda c: tx.strip(F.concat(F.lit("\u00a0 "), c, F.lit("\u2003\n"))), "stripped"
    )(spark, folder)


@query("SELECT doc_id, substr(text, 1, 200) || '...' AS excerpt FROM documents")
def excerpt(spark, folder):
    return _per_document(tx.excerpt, "excerpt")(spark, folder)


@query("""SELECT event_id, printf('%.4f', value) AS fixed4, printf('%.4f', (event_id % 4000) / 32000.0::DOUBLE) AS tied4,
  printf('%.2f%%', (event_id % 801) / 800.0::DOUBLE * 100) AS percent,
  printf('%.0f%%', (event_id % 801) / 800.0::DOUBLE * 100) AS whole_percent FROM events""")
def number_formats(spark, folder):
    share = (F.col("event_id") % 801) / F.lit(800.0)
    return table(spark, folder, "events").select(
        "event_id",
        sc.fixed4(F.col("value")).alias("fixed4"),
        sc.fixed4((F.col("event_id") % 4000) / F.lit(32000.0)).alias("tied4"),
        sc.percent(share).alias("percent"),
        sc.percent(share, 0).alias("whole_percent"),
    )


@query("SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp FROM events")
def timestamp_string(spark, folder):
    return table(spark, folder, "events").select("event_id", timestamp_text(F.col("ts")).alias("timestamp"))


def _event_times(spark, folder):
    return _event_times_of(table(spark, folder, "events"))


def _event_times_of(events: DataFrame) -> DataFrame:
    """Event times as text in eight shapes, half of them no valid time."""
    ts, kind = F.col("ts"), F.pmod("event_id", F.lit(8))
    day, time = F.date_format(ts, "yyyy-MM-dd"), F.date_format(ts, "HH:mm:ss")
    text = (
        F.when(kind == 0, F.concat_ws(" ", day, time))
        .when(kind == 1, F.date_format(ts, "yyyy-M-d H:m:s"))
        .when(kind == 2, F.concat(day, F.lit(" \t\u2003 "), time))
        .when(kind == 3, F.concat_ws("T", day, time))
        .when(kind == 4, F.concat(day, F.lit(" "), time, F.lit(" ")))
        .when(kind == 5, F.concat(F.lit("0000"), F.date_format(ts, "-MM-dd HH:mm:ss")))
        .when(kind == 6, F.concat(F.date_format(ts, "yyyy"), F.lit("-02-30 "), time))
    )
    return events.select("event_id", text.alias("timestamp"))


TIMES = r"""times AS (SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS good, CASE event_id % 8
  WHEN 0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') WHEN 1 THEN strftime(ts, '%Y-%-m-%-d %-H:%-M:%-S')
  WHEN 2 THEN strftime(ts, '%Y-%m-%d') || ' ' || chr(9) || chr(8195) || ' ' || strftime(ts, '%H:%M:%S')
  WHEN 3 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S') WHEN 4 THEN strftime(ts, '%Y-%m-%d %H:%M:%S ')
  WHEN 5 THEN strftime(ts, '0000-%m-%d %H:%M:%S') WHEN 6 THEN strftime(ts, '%Y-02-30 %H:%M:%S') END AS t FROM events)"""


@query(f"""WITH {TIMES} SELECT event_id, t AS raw, CASE WHEN event_id % 8 IN (0, 1, 2) THEN good END AS parsed FROM times""")
def parse_timestamp_lenient(spark, folder):
    parsed = timestamp_text(parse_timestamp("timestamp", "lenient"))
    return _event_times(spark, folder).select("event_id", F.col("timestamp").alias("raw"), parsed.alias("parsed"))


@query(f"""WITH {TIMES} SELECT event_id, CASE
  WHEN regexp_full_match(t, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}} [0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}') AND NOT starts_with(t, '0000')
  THEN strftime(try_strptime(t, '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') END AS parsed FROM times""")
def parse_timestamp_strict(spark, folder):
    parsed = timestamp_text(parse_timestamp("timestamp", "strict"))
    return _event_times(spark, folder).select("event_id", parsed.alias("parsed"))


@query("""SELECT l_orderkey, l_linenumber, CASE l_linenumber - 2 WHEN 0 THEN 'World' WHEN 1 THEN 'Sports'
  WHEN 2 THEN 'Business' WHEN 3 THEN 'Sci/Tech' ELSE 'unknown' END AS category FROM lineitem""")
def code_to_category(spark, folder):
    number = F.col("l_linenumber")
    code = F.when(number != 7, number - 2)
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", labels.code_to_category(code).alias("category")
    )


@query("""SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 4 <> 0 THEN 'unknown' WHEN l_linenumber = 1 THEN 'World'
  WHEN l_linenumber = 2 THEN 'Sports' WHEN l_linenumber = 3 THEN 'Business' WHEN l_linenumber = 4 THEN 'Sci/Tech'
  ELSE 'unknown' END AS category FROM lineitem""")
def odd_codes(spark, folder):
    """Whole codes, and codes that are fractional or wider than an integer."""
    number, kind = F.col("l_linenumber") - 1, F.col("l_orderkey") % 4
    code = F.when(kind == 0, number).when(kind == 1, number + 0.5).when(kind == 2, number + 4294967296).otherwise(-1e300)
    return table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", labels.code_to_category(code.cast("double")).alias("category")
    )


# --- ingest and cleaning ----------------------------------------------------

MOMENT = "2024-03-05 06:07:08"


@query(f"SELECT id, '{MOMENT}' AS timestamp, text, 'newswire' AS source, category FROM ({sql.CODED})")
def ingest_records(spark, folder):
    moment = F.lit(MOMENT).cast("timestamp")
    return raw_records(coded(spark, folder), "newswire", None, moment=moment)


@query("SELECT doc_id AS id, '' AS text, 'newswire' AS source, 'unknown' AS category FROM documents")
def ingest_without_fields(spark, folder):
    ids = table(spark, folder, "documents").select(F.col("doc_id").alias("id"))
    return raw_records(ids, "newswire").drop("timestamp")


@query(f"""SELECT row_number() OVER (ORDER BY doc_id) - 1 AS id, '{MOMENT}' AS timestamp, text, 'newswire' AS source,
  'unknown' AS category FROM documents""")
def ingest_numbered(spark, folder):
    """Records of a table without ids get the numbers of their rows."""
    moment = F.lit(MOMENT).cast("timestamp")
    return raw_records(table(spark, folder, "documents").drop("doc_id"), "newswire", moment=moment)


@query(f"""SELECT row_number() OVER (ORDER BY source, doc_id, text) - 1 AS id, '{MOMENT}' AS timestamp, text,
  'newswire' AS source, 'unknown' AS category FROM documents""")
def ingest_renumbered(spark, folder):
    """Ids that repeat become places in their order."""
    moment = F.lit(MOMENT).cast("timestamp")
    rows = table(spark, folder, "documents").select(F.col("source").alias("id"), "doc_id", "text")
    return raw_records(rows, "newswire", moment=moment, renumber=True)


@query("""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
  o_orderpriority FROM orders ORDER BY o_orderkey LIMIT 12000""")
def first_n_rows(spark, folder):
    rows = table(spark, folder, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
    return first_n(rows, 12_000, "o_orderkey")


def _loose_keys(spark, folder) -> DataFrame:
    """Orders with a key that repeats and is NULL in every fifth row."""
    key = F.when(F.col("o_orderkey") % 5 != 0, F.floor(F.col("o_orderkey") / 7))
    return table(spark, folder, "orders").select(key.alias("key"), "o_orderkey", "o_totalprice")


LOOSE = """SELECT CASE WHEN o_orderkey % 5 <> 0 THEN o_orderkey // 7 END AS key, o_orderkey, o_totalprice FROM orders
  ORDER BY key NULLS LAST, o_orderkey, o_totalprice"""


@query(f"{LOOSE} LIMIT 9000")
def first_n_repeated(spark, folder):
    return first_n(_loose_keys(spark, folder), 9_000, "key")


@query(f"{LOOSE} LIMIT 13001")
def first_n_nulls(spark, folder):
    return first_n(_loose_keys(spark, folder), 13_001, "key")


@query("""SELECT CAST(key AS VARCHAR) AS key, doc_id FROM (SELECT source || '-' || lang AS key, doc_id FROM documents
  ORDER BY key, doc_id LIMIT 333)""")
def first_n_text_keys(spark, folder):
    rows = table(spark, folder, "documents").select(F.concat_ws("-", "source", "lang").alias("key"), "doc_id")
    return first_n(rows, 333, "key")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS position FROM orders")
def sequential_id(spark, folder):
    return positions(table(spark, folder, "orders"), "o_orderkey")


@query(f"""SELECT id, '{MOMENT}' AS timestamp, source, category, text, {sql.clean('text')} AS cleaned_text
  FROM ({sql.DOCUMENTS})""")
def cleaned_articles(spark, folder):
    raw = documents(spark, folder).withColumn("timestamp", F.lit(MOMENT))
    return cleaning.clean_articles(raw).withColumn("timestamp", timestamp_text(F.col("timestamp")))


def _timed(spark, folder):
    return _event_times(spark, folder).withColumn("timestamp", parse_timestamp("timestamp"))


@query("SELECT event_id FROM events WHERE event_id % 8 > 2")
def null_timestamp_filter(spark, folder):
    return cleaning.null_timestamps(_timed(spark, folder)).select("event_id")


@query("""SELECT count(*) AS records, count(*) FILTER (WHERE event_id % 8 > 2) AS null_timestamps,
  count(*) FILTER (WHERE event_id % 3 = 0) AS null_ids
  FROM events""")
def quality_counts(spark, folder):
    rows = _timed(spark, folder).withColumn("id", F.when(F.col("event_id") % 3 != 0, F.col("event_id")))
    return cleaning.quality_counts(rows)


@query(f"""SELECT id, source, category, {sql.clean('text')} AS cleaned_text FROM ({sql.DOCUMENTS}) ORDER BY id LIMIT 5""")
def head_preview(spark, folder):
    raw = documents(spark, folder).withColumn("timestamp", timestamp_text())
    return cleaning.preview(cleaning.clean_articles(raw)).select("id", "source", "category", "cleaned_text")


# --- predicates -------------------------------------------------------------


def _spoiled(spark, folder):
    """Documents, and beside some of them a blank, missing or marked text with a negative id."""
    kind = F.pmod("doc_id", F.lit(7))
    odd = (
        F.when(kind == 1, F.lit(" \t ")).when(kind == 2, F.lit("\u00a0\u2003")).when(kind == 3, F.lit("N/A"))
    )  # NULL for kind 0
    rows = F.array(F.struct("doc_id", "text"), F.struct((-1 - F.col("doc_id")).alias("doc_id"), odd.alias("text")))
    return table(spark, folder, "documents").select(F.inline(F.when(kind < 4, rows).otherwise(F.slice(rows, 1, 1))))


SPOILED = """spoiled AS (SELECT doc_id, text, 9 AS kind FROM documents UNION ALL
  SELECT -1 - doc_id, CASE doc_id % 7 WHEN 1 THEN ' ' || chr(9) || ' ' WHEN 2 THEN chr(160) || chr(8195)
    WHEN 3 THEN 'N/A' END, doc_id % 7 FROM documents WHERE doc_id % 7 < 4)"""


@query(f"WITH {SPOILED} SELECT doc_id, {sql.blank('text')} AS invalid FROM spoiled")
def invalid_guard(spark, folder):
    return _spoiled(spark, folder).select("doc_id", tx.is_blank("text").alias("invalid"))


@query("""SELECT doc_id, length(source || ' ' || doc_id) >= 10 AS long_enough FROM documents""")
def short_guard(spark, folder):
    padded = F.concat(F.lit("\u00a0"), "source", F.lit(" "), "doc_id", F.lit(" \n"))
    return table(spark, folder, "documents").select("doc_id", tx.is_long_enough(padded).alias("long_enough"))


@query(f"WITH {SPOILED} SELECT doc_id, text FROM spoiled WHERE text IS NOT NULL AND text <> 'N/A'")
def drop_missing(spark, folder):
    return files.drop_missing(_spoiled(spark, folder))


@query(f"WITH {SPOILED} SELECT doc_id, text FROM spoiled WHERE text IS NOT NULL AND kind <> 1")
def drop_blank(spark, folder):
    return _spoiled(spark, folder).filter(tx.has_ascii_content("text"))


# --- labels and split -------------------------------------------------------


@query(f"WITH {sql.labelled(sql.NEWS)} SELECT * FROM lmap")
def label_map(spark, folder):
    return labels.label_map(news(spark, folder))


@query(f"WITH arts AS ({sql.NEWS}) SELECT category, min(id) AS first_id FROM arts GROUP BY category")
def distinct_categories(spark, folder):
    return labels.distinct_categories(news(spark, folder))


@query(f"""WITH {sql.labelled(sql.DOCUMENTS)}, known AS (SELECT * FROM lmap WHERE category <> 'es')
  SELECT id, a.category, label_idx FROM arts a LEFT JOIN known USING (category)""")
def label_encode(spark, folder):
    rows = documents(spark, folder).select("id", "category")
    known = stage(labels.label_map(rows), "label-map").filter("category <> 'es'")
    return labels.encode(rows, known)


@query(f"""WITH {sql.labelled(sql.DOCUMENTS)} SELECT l_orderkey, l_linenumber, coalesce(category, 'Unknown') AS category
  FROM lineitem LEFT JOIN lmap ON label_idx = l_linenumber - 1""")
def label_decode(spark, folder):
    known = stage(labels.label_map(documents(spark, folder)), "label-map")
    lines = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_linenumber") - 1).alias("idx")
    )
    return labels.decode(lines, known, "idx", "category").drop("idx")


@query(f"WITH {sql.split(sql.DOCUMENTS)} SELECT id, category, label_idx, is_val FROM parts")
def stratified_split(spark, folder):
    _, rows = jobs.split_articles(documents(spark, folder))
    return rows.select("id", "category", "label_idx", "is_val")


@query(f"WITH {sql.split(sql.NEWS)} SELECT is_val, count(*) AS rows FROM parts GROUP BY is_val")
def split_counts(spark, folder):
    return split_sizes(jobs.split_articles(news(spark, folder))[1])


# --- features and model -----------------------------------------------------


@query(f"""SELECT doc_id, array_to_string(string_split({sql.clean('text')}, ' ')[1:{sql.TOKENS}], ' ') AS tokens
  FROM documents""")
def tokens_truncated(spark, folder):
    def cut(text: Column) -> Column:
        return F.array_join(sc.word_tokens(tx.clean_text(text), sc.MAX_TOKENS), " ")

    return _per_document(cut, "tokens")(spark, folder)


@query(f"""SELECT word, count(*) AS n FROM (
    SELECT unnest(string_split({sql.clean('text')}, ' ')) AS word FROM documents)
  WHERE word <> '' GROUP BY word ORDER BY n DESC, word LIMIT 5000""")
def vocabulary_top(spark, folder):
    words = vocabulary.word_counts(documents(spark, folder).select(tx.clean_text("text").alias("cleaned_text")))
    return vocabulary.top_words(stage(words, "word-counts"), 5000)


@query(f"WITH {sql.model(sql.DOCUMENTS)} SELECT word, label_idx, weight FROM weights")
def nb_weights(spark, folder):
    _, _, model = jobs.train_on_articles(documents(spark, folder))
    return model.weights.select("word", F.posexplode("weight").alias("label_idx", "weight"))


def vocabulary_file() -> str:
    """A public vocabulary of lower-case pieces, as installed."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query(f"""SELECT word, word AS joined, count(*) AS n, true AS has_pieces FROM (
    SELECT unnest(string_split({sql.clean('text')}, ' ')) AS word FROM documents) WHERE word <> '' GROUP BY word""")
def subword_pieces(spark, folder):
    """All words with what their pieces spell."""
    words = vocabulary.word_counts(documents(spark, folder).select(tx.clean_text("text").alias("cleaned_text")))
    words = stage(words, "word-counts")
    spelt = F.regexp_replace(F.array_join("pieces", ""), f"{subwords.WORD_END}$", "")
    pieces = subwords.word_pieces(words, vocabulary_file())
    spelt = pieces.select("word", spelt.alias("joined"), (F.size("pieces") > 0).alias("has_pieces"))
    return words.join(spelt, "word").select("word", "joined", "n", "has_pieces")


@query(f"""WITH {sql.split(sql.NEWS)}, tok AS (SELECT id, label_idx, unnest(string_split({sql.clean('text')}, ' ')) AS word
    FROM parts WHERE NOT is_val)
  SELECT label_idx, sum(length(word))::BIGINT AS letters, count(*) AS words, count(DISTINCT id) AS articles FROM tok
  WHERE word <> '' GROUP BY label_idx""")
def subword_counts(spark, folder):
    """Counts of pieces per label add up to the letters, words and articles that were read."""
    _, rows = jobs.split_articles(news(spark, folder))
    train = rows.filter("not is_val").withColumn("cleaned_text", tx.clean_text("text"))
    counts = naive_bayes.counted(train, None, vocabulary_file())
    ends = F.col("word").endswith(subwords.WORD_END)
    letters = F.char_length("word") - F.when(ends, len(subwords.WORD_END)).otherwise(0)
    return counts.groupBy("label_idx").agg(
        F.sum(letters * F.col("n")).alias("letters"),
        F.sum(F.when(ends, F.col("n")).otherwise(0)).alias("words"),
        F.sum("first_words").alias("articles"),
    )


CUT = {"vocabulary": 2000, "most": 128}


@query(f"WITH {sql.model(sql.NEWS, **CUT)} SELECT word, label_idx, weight FROM weights")
def nb_weights_cut(spark, folder):
    """A model told to read the first words of each text and to keep the most frequent ones."""
    _, _, model = jobs.train_on_articles(news(spark, folder), CUT["vocabulary"], CUT["most"])
    return model.weights.select("word", F.posexplode("weight").alias("label_idx", "weight"))


@query(f"WITH {sql.predictions(sql.NEWS, **CUT)} SELECT * FROM preds")
def predictions_cut(spark, folder):
    _, rows, model = jobs.train_on_articles(news(spark, folder), CUT["vocabulary"], CUT["most"])
    return scoring.evaluate_rows(rows.filter("is_val"), model)


@query(f"""WITH {sql.model(sql.NEWS)} SELECT category, label_idx, CAST(articles AS BIGINT) AS articles,
  CAST(tokens AS BIGINT) AS tokens, prior FROM lstat""")
def nb_labels(spark, folder):
    return jobs.train_on_articles(news(spark, folder))[2].labels


@query(f"""WITH {sql.model(sql.DOCUMENTS)},
  {sql.scored(f"SELECT id, {sql.clean('text')} AS cleaned FROM parts WHERE is_val")}
  SELECT id, label_idx, score FROM scores""")
def nb_scores(spark, folder):
    _, rows, model = jobs.train_on_articles(documents(spark, folder))
    found = naive_bayes.score(rows.filter("is_val"), model)
    return found.select("id", F.posexplode("scores").alias("label_idx", "score"))


@query(f"""WITH {sql.model(sql.NEWS)},
  {sql.scored(f"SELECT id, {sql.clean('text')} AS cleaned FROM parts WHERE is_val")}
  SELECT id, label_idx, {sql.fixed('p')} AS probability FROM probs""")
def nb_probabilities(spark, folder):
    _, rows, model = jobs.train_on_articles(news(spark, folder))
    scored = naive_bayes.score(rows.filter("is_val"), model)
    rows = scored.select("id", F.posexplode(scoring.probabilities(F.col("scores"))).alias("label_idx", "p"))
    return rows.select("id", "label_idx", fixed(F.col("p")).alias("probability"))


def _predicted(spark, folder) -> tuple[DataFrame, DataFrame]:
    known, rows, model = jobs.train_on_articles(news(spark, folder))
    return scoring.evaluate_rows(rows.filter("is_val"), model), known


@query(f"WITH {sql.predictions(sql.NEWS)} SELECT * FROM preds")
def predictions(spark, folder):
    return _predicted(spark, folder)[0]


# --- vectors ----------------------------------------------------------------

VECTORS = """cells AS (SELECT vec_id, CAST(unnest(embedding) AS DOUBLE) AS x, unnest(range(len(embedding))) AS i
  FROM embeddings),
parts AS (SELECT *, max(x) OVER (PARTITION BY vec_id) AS top, exp(x - max(x) OVER (PARTITION BY vec_id)) AS e FROM cells),
soft AS (SELECT vec_id, i, x, e / sum(e) OVER (PARTITION BY vec_id) AS p,
  row_number() OVER (PARTITION BY vec_id ORDER BY x DESC, i) AS place FROM parts)"""
NAMES = list(labels.CATEGORIES.values())


def _logits(spark, folder):
    return table(spark, folder, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("logits"))


@query(f"WITH {VECTORS} SELECT vec_id, CAST(i AS INTEGER) AS label_idx FROM soft WHERE place = 1")
def argmax_index(spark, folder):
    return _logits(spark, folder).select("vec_id", sc.argmax(F.col("logits")).alias("label_idx"))


@query(f"WITH {VECTORS} SELECT vec_id, CAST(i AS INTEGER) AS label_idx, {sql.fixed('p')} AS probability FROM soft")
def softmax_rows(spark, folder):
    rows = _logits(spark, folder).select("vec_id", F.posexplode(sc.softmax(F.col("logits"))).alias("label_idx", "p"))
    return rows.select("vec_id", "label_idx", fixed(F.col("p")).alias("probability"))


@query(f"WITH {VECTORS} SELECT vec_id, {sql.fixed('p')} AS confidence FROM soft WHERE place = 1")
def confidence_value(spark, folder):
    return _logits(spark, folder).select("vec_id", fixed(sc.confidence(sc.softmax(F.col("logits")))).alias("confidence"))


@query(f"""WITH {VECTORS} SELECT vec_id AS id, CASE i WHEN 0 THEN 'World' WHEN 1 THEN 'Sports' WHEN 2 THEN 'Business'
  WHEN 3 THEN 'Sci/Tech' ELSE 'L_' || i END AS category, {sql.fixed('p')} AS probability FROM soft""")
def probability_map_rows(spark, folder):
    named = sc.probability_map(sc.softmax(F.col("logits")), NAMES)
    rows = _logits(spark, folder).select(F.col("vec_id").alias("id"), named.alias("raw_probabilities"))
    return scoring.probability_rows(rows).withColumn("probability", fixed(F.col("probability")))


# --- evaluation -------------------------------------------------------------


@query(f"""WITH {sql.predictions(sql.NEWS)} SELECT count(*) AS rows,
  count(*) FILTER (WHERE true_label_idx = predicted_label_idx) AS correct,
  {sql.fixed("avg(CASE WHEN true_label_idx = predicted_label_idx THEN 1.0 ELSE 0 END)")} AS accuracy FROM preds""")
def accuracy(spark, folder):
    return metrics.accuracy(_predicted(spark, folder)[0]).withColumn("accuracy", fixed(F.col("accuracy")))


@query(f"WITH {sql.predictions(sql.NEWS)} SELECT * FROM preds WHERE true_label_idx <> predicted_label_idx")
def misclassified_rows(spark, folder):
    return metrics.misclassified(_predicted(spark, folder)[0])


@query(f"""WITH {sql.predictions(sql.NEWS)} SELECT
  count(*) FILTER (WHERE true_label_idx <> predicted_label_idx) AS errors FROM preds""")
def error_count(spark, folder):
    return metrics.error_count(_predicted(spark, folder)[0])


RATES = ", ".join(f"{sql.fixed(n)} AS {n}" for n in ("precision", "recall", "f1"))


def _rates(report: DataFrame) -> DataFrame:
    return report.withColumns({n: fixed(F.col(n)) for n in ("precision", "recall", "f1")})


@query(f"WITH {sql.report(sql.NEWS)} SELECT label_idx, category, {RATES}, support FROM rep")
def class_report(spark, folder):
    return _rates(metrics.class_report(*_predicted(spark, folder)))


@query(f"""WITH {sql.report(sql.NEWS)},
  avgs AS (SELECT 'macro avg' AS average, avg(precision) AS precision, avg(recall) AS recall, avg(f1) AS f1,
    sum(support) AS support FROM rep
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
    sum(f1 * support) / sum(support), sum(support) FROM rep
  UNION ALL SELECT 'accuracy', sum(hits) / sum(support), sum(hits) / sum(support), sum(hits) / sum(support),
    sum(support) FROM rep)
  SELECT average, {RATES}, CAST(support AS BIGINT) AS support FROM avgs""")
def report_averages(spark, folder):
    return _rates(metrics.report_averages(*_predicted(spark, folder)))


@query(f"""WITH {sql.predictions(sql.NEWS)} SELECT t.label_idx AS true_label_idx, p.label_idx AS predicted_label_idx,
  (SELECT count(*) FROM preds WHERE true_label_idx = t.label_idx AND predicted_label_idx = p.label_idx) AS n
  FROM lmap t CROSS JOIN lmap p""")
def confusion_long(spark, folder):
    return metrics.confusion_matrix(*_predicted(spark, folder))


CELLS = ", ".join(f"count(*) FILTER (WHERE predicted_label_idx = {i}) AS predicted_{i}" for i in range(4))


@query(f"""WITH {sql.predictions(sql.NEWS)} SELECT label_idx AS true_label_idx, {CELLS}
  FROM lmap LEFT JOIN preds ON true_label_idx = label_idx GROUP BY label_idx""")
def confusion_wide(spark, folder):
    return metrics.confusion_wide(*_predicted(spark, folder))


@query(f"""WITH {sql.predictions(sql.NEWS)} SELECT CAST(row_number() OVER (ORDER BY id) AS INTEGER) AS example, id,
  substr(text, 1, 200) || '...' AS excerpt, true_category, predicted_category
  FROM preds WHERE true_label_idx <> predicted_label_idx ORDER BY id LIMIT 5""")
def error_sample(spark, folder):
    return metrics.error_sample(*_predicted(spark, folder))


# --- classifying new text ---------------------------------------------------


def _classified(spark, folder, articles: DataFrame) -> DataFrame:
    return scoring.classify(articles, jobs.train_on_articles(news(spark, folder))[2])


RESULT = f"id, text, predicted_category, {sql.fixed('confidence')} AS confidence, probabilities"


def shown(results: DataFrame) -> DataFrame:
    """Results with the confidence to six decimals and the probabilities as sorted text."""
    entries = F.transform(
        F.array_sort(F.map_entries("raw_probabilities")),
        lambda e: F.concat(e["key"], F.lit(":"), fixed(e["value"]).cast("string")),
    )
    return results.select(
        "id",
        "text",
        "predicted_category",
        fixed(F.col("confidence")).alias("confidence"),
        F.array_join(entries, ",").alias("probabilities"),
    )


@query(f"WITH {sql.results(sql.NEWS, TURNS)} SELECT {RESULT} FROM res")
def classify_batch(spark, folder):
    return shown(_classified(spark, folder, turns(spark, folder)))


ITEMS = "SELECT item_id AS id, text FROM benchmark"


@query(f"""WITH {sql.results(sql.NEWS, "SELECT row_number() OVER (ORDER BY item_id) - 1 AS id, text FROM benchmark")}
  SELECT {RESULT} FROM res""")
def adhoc_texts(spark, folder):
    """The benchmark's questions in their order, as texts typed in by hand would be numbered."""
    model = jobs.train_on_articles(news(spark, folder))[2]
    texts = number_by(table(spark, folder, "benchmark").select("item_id", "text"), [F.col("item_id")])
    return shown(scoring.classify_numbered(texts.select(F.col("position").alias("id"), "text"), model))


@query(f"""WITH {sql.results(sql.NEWS, ITEMS)} SELECT id, category, {sql.fixed('p')} AS probability FROM item_shares""")
def classify_probabilities(spark, folder):
    items = table(spark, folder, "benchmark").select(F.col("item_id").alias("id"), "text")
    rows = scoring.probability_rows(_classified(spark, folder, items))
    return rows.withColumn("probability", fixed(F.col("probability")))


@query(f"WITH {sql.results(sql.NEWS, TURNS)} SELECT {RESULT} FROM res WHERE confidence >= 0.75")
def confidence_filter(spark, folder):
    return shown(scoring.above_threshold(_classified(spark, folder, turns(spark, folder))))


@query(f"""WITH {sql.results(sql.NEWS, TURNS)} SELECT id, predicted_category,
  CASE WHEN confidence >= 0.75 THEN 'ok' ELSE 'below_threshold' END AS flag FROM res""")
def confidence_flag(spark, folder):
    results = _classified(spark, folder, turns(spark, folder))
    return results.select("id", "predicted_category", sc.confidence_flag(F.col("confidence")).alias("flag"))


@query(f"""WITH {sql.results(sql.NEWS, TURNS)} SELECT predicted_category, count(*) AS count FROM res
  WHERE confidence >= 0 GROUP BY predicted_category""")
def category_distribution(spark, folder):
    return metrics.category_distribution(_classified(spark, folder, turns(spark, folder)), 0.0)


@query(f"SELECT id, text FROM ({TURNS}) ORDER BY id NULLS LAST, text LIMIT 100")
def batch_cap(spark, folder):
    return batches.cap_batch(turns(spark, folder), 100)


@query(f"SELECT count(*) AS articles, count(*) > 100 AS over_cap FROM ({TURNS})")
def article_count(spark, folder):
    return batches.article_count(turns(spark, folder), 100)


BATCHES = """sized AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS position, count(*) OVER () AS n,
    greatest(1, count(*) OVER () // 10) AS k FROM orders),
batched AS (SELECT o_orderkey, position, CAST(CASE WHEN position < (n % k) * (n // k + 1) THEN position // (n // k + 1)
    ELSE n % k + (position - (n % k) * (n // k + 1)) // (n // k) END AS INTEGER) AS batch FROM sized)"""


@query(f"WITH {BATCHES} SELECT * FROM batched")
def batch_assign(spark, folder):
    return batches.assign_batches(table(spark, folder, "orders"), "o_orderkey")


@query(f"""WITH {BATCHES}, sizes AS (SELECT batch, count(*) AS rows FROM batched GROUP BY batch)
  SELECT batch, rows, CAST(sum(rows) OVER (ORDER BY batch) AS BIGINT) AS done FROM sizes""")
def batch_progress(spark, folder):
    return batches.batch_progress(batches.assign_batches(table(spark, folder, "orders"), "o_orderkey"))


# --- files ------------------------------------------------------------------


@query(f"SELECT id, '{MOMENT}' AS timestamp, text, 'newswire' AS source, category FROM ({sql.CODED})")
def jsonl_roundtrip(spark, folder):
    path = new_path(spark, "jsonl")
    files.write_jsonl(ingest_records(spark, folder), path)
    return files.read_jsonl(spark, path)


@query(f"""SELECT id, '{MOMENT}' AS timestamp, source, category, text, {sql.clean('text')} AS cleaned_text,
  count(*) OVER () AS records, 0 AS null_timestamps, 0 AS null_ids FROM ({sql.CODED})""")
def process_job(spark, folder):
    raw, out = new_path(spark, "raw"), new_path(spark, "cleaned")
    files.write_jsonl(named(spark, folder).withColumn("timestamp", F.lit(MOMENT)), raw)
    counts = jobs.process(spark, raw, out)
    rows = files.read_cleaned(spark, out).withColumns({name: F.lit(n).cast("long") for name, n in counts.items()})
    return rows.withColumn("timestamp", timestamp_text(F.col("timestamp")))


@query(f"SELECT id, category, {sql.clean('text')} AS cleaned_text FROM ({sql.DOCUMENTS})")
def parquet_column_prune(spark, folder):
    out = new_path(spark, "cleaned")
    raw = documents(spark, folder).withColumn("timestamp", F.lit(MOMENT))
    files.write_parquet(cleaning.clean_articles(raw), out, ["category"])
    return files.read_model_input(spark, out).select("id", "category", "cleaned_text")


@query("SELECT CAST(doc_id AS VARCHAR) AS doc_id, text, lang FROM documents")
def csv_roundtrip(spark, folder):
    path = new_path(spark, "csv")
    files.write_csv(table(spark, folder, "documents").select("doc_id", "text", "lang"), path)
    return files.read_csv(spark, path)


@query("""SELECT row_number() OVER (ORDER BY doc_id) - 1 AS id, text FROM documents""")
def csv_articles(spark, folder):
    path = new_path(spark, "csv")
    files.write_csv(table(spark, folder, "documents").select("doc_id", "text").orderBy("doc_id"), path)
    return files.read_csv_articles(spark, path)


@query(f"""WITH lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
    unnest(range(len(string_split(text, chr(10))))) AS place FROM documents)
  SELECT row_number() OVER (ORDER BY doc_id, place) - 1 AS id, {sql.strip('line')} AS text
  FROM lines WHERE regexp_matches(line, '[^\\t-\\r ]')""")
def txt_articles(spark, folder):
    path = new_path(spark, "txt")
    table(spark, folder, "documents").orderBy("doc_id").select("text").write.text(path)
    return files.read_txt_articles(spark, path)


@query(f"WITH {sql.labelled(sql.NEWS)} SELECT * FROM lmap")
def label_map_roundtrip(spark, folder):
    path = new_path(spark, "labels")
    files.write_label_map(labels.label_map(news(spark, folder)), path)
    return files.read_label_map(spark, path)


@query(f"WITH {sql.model(sql.NEWS)} SELECT word, label_idx, weight FROM weights")
def model_roundtrip(spark, folder):
    saved = jobs.train_on_articles(news(spark, folder))[2]
    loaded = naive_bayes.load(spark, naive_bayes.save(saved, new_path(spark, "saved")).path)
    return loaded.weights.select("word", F.posexplode("weight").alias("label_idx", "weight"))


@query(f"""WITH {sql.predictions(sql.NEWS)} SELECT CAST(id AS VARCHAR) AS id, text,
  CAST(true_label_idx AS VARCHAR) AS true_label_idx, CAST(predicted_label_idx AS VARCHAR) AS predicted_label_idx,
  true_category, predicted_category FROM preds""")
def predictions_export(spark, folder):
    path = new_path(spark, "predictions")
    files.write_csv(_predicted(spark, folder)[0], path)
    return files.read_csv(spark, path)


@query(f"""WITH {sql.results(sql.NEWS, TURNS)} SELECT CAST(id AS VARCHAR) AS id, text, predicted_category,
  {sql.fixed('confidence')} AS confidence, probabilities FROM res""")
def results_export(spark, folder):
    """All five columns, read back from CSV with the probabilities as JSON."""
    path = new_path(spark, "results")
    files.write_csv(files.results_table(_classified(spark, folder, turns(spark, folder))), path)
    rows = files.read_csv(spark, path).withColumn(
        "raw_probabilities", F.from_json("raw_probabilities", "map<string,double>")
    )
    return shown(rows.withColumn("confidence", F.col("confidence").cast("double")))


@query(f"""WITH {sql.model(sql.NEWS, smoothing=0.25)} SELECT word, label_idx, weight FROM weights""")
def versioned_model(spark, folder):
    """The model that is served after two saves and one that failed half-way."""
    place, trained = new_path(spark, "store"), jobs.train_on_articles(news(spark, folder))
    known, rows, first = trained
    second = naive_bayes.fit(rows.filter(~F.col("is_val")), known, smoothing=0.25)
    for model in (first, second):
        model_store.save(spark, place, lambda path, model=model: naive_bayes.save(model, path))

    def fail(path: str) -> None:
        first.words.write.parquet(f"{path}/words")
        raise InterruptedError

    try:
        model_store.save(spark, place, fail)
    except InterruptedError:
        pass
    loaded = naive_bayes.load(spark, model_store.resolve(spark, place))
    return loaded.weights.select("word", F.posexplode("weight").alias("label_idx", "weight"))


@query("""WITH known AS (SELECT source AS category, row_number() OVER (ORDER BY min(doc_id), source) - 1 AS label_idx
    FROM documents WHERE lang <> 'en' GROUP BY source),
  fresh AS (SELECT source AS category, min(doc_id) AS first FROM documents GROUP BY source)
  SELECT category, label_idx::INTEGER AS label_idx FROM known UNION ALL
  SELECT category, (row_number() OVER (ORDER BY first, category) - 1 + (SELECT count(*) FROM known))::INTEGER
  FROM fresh ANTI JOIN known USING (category)""")
def label_map_growth(spark, folder):
    """The sources of all articles, after a load that had those in other languages than English."""
    rows = documents(spark, folder).select("id", F.col("source").alias("category"), F.col("category").alias("lang"))
    known = stage(labels.label_map(rows.filter("lang <> 'en'")), "label-map")
    return labels.grow_label_map(known, labels.label_map(rows))


@query("""SELECT 'record' AS kind, doc_id AS id, NULL AS record FROM documents UNION ALL
  SELECT 'malformed', NULL, CASE doc_id % 3 WHEN 0 THEN '{"id": ' || doc_id WHEN 1 THEN '{"id": "no ' || doc_id || '"}'
    ELSE 'no json ' || doc_id END FROM documents""")
def quarantine(spark, folder):
    """As many lines that are cut off, are of another type or no JSON at all, beside all records."""
    path = new_path(spark, "jsonl")
    rows = named(spark, folder).withColumn("timestamp", F.lit(MOMENT))
    kind = F.pmod("id", F.lit(3))
    bad = F.when(kind == 0, F.concat(F.lit('{"id": '), "id")).when(kind == 1, F.concat(F.lit('{"id": "no '), "id", F.lit('"}')))
    bad = F.coalesce(bad, F.concat(F.lit("no json "), "id"))
    lines = rows.select(F.explode(F.array(F.to_json(F.struct("id", "timestamp", "text", "source", "category")), bad)).alias("value"))
    lines.write.text(path)
    checked = files.read_jsonl_checked(spark, path)
    good = files.good_records(checked).select(F.lit("record").alias("kind"), "id", F.lit(None).cast("string").alias("record"))
    return good.unionByName(files.quarantined(checked).select(F.lit("malformed").alias("kind"), "id", "record"))


# --- calibration ------------------------------------------------------------


def _held_out(spark, folder) -> tuple[DataFrame, naive_bayes.BayesModel]:
    _, rows, model = jobs.train_on_articles(news(spark, folder))
    return rows.filter("is_val"), model


@query(f"""WITH {sql.losses(sql.NEWS, calibration.TEMPERATURES)}
  SELECT temperature, rows, {sql.fixed('least(loss, 900)')} AS loss FROM losses""")
def temperature_losses(spark, folder):
    rows, model = _held_out(spark, folder)
    scored = naive_bayes.score(rows, model).select(naive_bayes.logs(F.col("scores")).alias("logs"), "label_idx")
    found = calibration.temperature_losses(scored)
    return found.withColumn("loss", fixed(F.least("loss", F.lit(900.0))))


@query(f"""WITH {sql.calibrated(sql.NEWS, calibration.TEMPERATURES)},
  bins AS (SELECT temperature, least(floor(round(p, 9) * 10), 9) AS bin, count(*) AS n, avg(p) AS confidence,
    avg(own::INT) AS accuracy FROM warm WHERE place = 1 GROUP BY ALL)
  SELECT temperature, sum(n)::BIGINT AS rows, {sql.fixed('sum(n * abs(accuracy - confidence)) / sum(n)')} AS error
  FROM bins GROUP BY temperature""")
def calibration_errors(spark, folder):
    """The expected calibration error before and after a temperature is fitted."""
    rows, model = _held_out(spark, folder)
    warm = naive_bayes.calibrated(model, rows)
    found = None
    for one in [model, *([warm] if warm.temperature != 1 else [])]:
        scored = scoring.scored(rows, one)
        right = F.col("predicted_label_idx") == F.col("label_idx")
        predicted = scored.select(sc.confidence(F.col("probabilities")).alias("confidence"), right.alias("is_right"))
        error = calibration.calibration_error(calibration.reliability(predicted))
        error = error.select(F.lit(one.temperature).alias("temperature"), "rows", fixed(F.col("error")).alias("error"))
        found = error if found is None else found.unionByName(error)
    return found


@query(f"""WITH {sql.calibrated(sql.NEWS, calibration.TEMPERATURES)}
  SELECT id, label_idx, {sql.fixed('p')} AS probability FROM warm WHERE temperature = (SELECT temperature FROM best)""")
def calibrated_probabilities(spark, folder):
    rows, model = _held_out(spark, folder)
    scored = scoring.scored(rows, naive_bayes.calibrated(model, rows))
    found = scored.select("id", F.posexplode("probabilities").alias("label_idx", "p"))
    return found.select("id", "label_idx", fixed(F.col("p")).alias("probability"))


# --- training by epochs -----------------------------------------------------


def _epochs(spark, folder) -> tuple[DataFrame, str]:
    train, held_out = _split_news(spark, folder)
    path = new_path(spark, "epochs")
    epochs.train(train, held_out, NAMES, path, SCHEDULE)
    return held_out, path


SCHEDULE = epochs.Schedule(epochs=3, batch=16, shards=8)


@query(f"""WITH {sql.split(sql.NEWS)} SELECT id, label_idx AS true_label_idx, true AS is_argmax,
  CAST(1 AS DECIMAL(9, 6)) AS probability_sum FROM parts WHERE is_val""")
def epoch_predictions(spark, folder):
    """The best of three epochs: what must hold of every row."""
    held_out, path = _epochs(spark, folder)
    predicted = epochs.predict(held_out, epochs.load(spark, path))
    total = F.aggregate("probabilities", F.lit(0.0), lambda whole, p: whole + p)
    return predicted.select(
        "id",
        F.col("label_idx").alias("true_label_idx"),
        (sc.argmax(F.col("probabilities")) == F.col("predicted_label_idx")).alias("is_argmax"),
        fixed(total).alias("probability_sum"),
    )


@query(f"""WITH {sql.split(sql.NEWS)} SELECT epoch, (SELECT count(*) FROM parts WHERE is_val) AS rows, true AS is_share,
  true AS beats_none, true AS is_resumed FROM (SELECT unnest([1, 2, 3]) AS epoch)""")
def epoch_history(spark, folder):
    """Every epoch's figures: a whole number of right rows, a loss below that of knowing nothing, and the same when resumed."""
    train, held_out = _split_news(spark, folder)
    whole, broken = new_path(spark, "epochs"), new_path(spark, "epochs")
    epochs.train(train, held_out, NAMES, whole, SCHEDULE)
    epochs.train(train, held_out, NAMES, broken, SCHEDULE, until=1)
    epochs.train(train, held_out, NAMES, broken, SCHEDULE)
    rows = held_out.count()
    found = [
        (a.number, rows, abs(a.accuracy * rows - round(a.accuracy * rows)) < 1e-6, a.loss < math.log(len(NAMES)),
         a.accuracy == b.accuracy and abs(a.loss - b.loss) < 1e-9)
        for a, b in zip(epochs.history(spark, whole), epochs.history(spark, broken), strict=True)
    ]
    return spark.createDataFrame(found, "epoch int, rows long, is_share boolean, beats_none boolean, is_resumed boolean")


# --- regression pipeline ----------------------------------------------------


def _split_news(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Training and validation rows, cleaned once for the passes of a fit."""
    _, rows = jobs.split_articles(news(spark, folder))
    cleaned = rows.select("id", "label_idx", "is_val", tx.clean_text("text").alias("cleaned_text"))
    cleaned = stage(cleaned, "cleaned")
    return cleaned.filter("not is_val").drop("is_val"), cleaned.filter("is_val").drop("is_val")


@query(f"""WITH {sql.split(sql.NEWS)} SELECT id, label_idx AS true_label_idx, true AS is_argmax,
  CAST(1 AS DECIMAL(9, 6)) AS probability_sum FROM parts WHERE is_val""")
def ml_predictions(spark, folder):
    """Regression: what must hold of every row whatever the fit comes to."""
    train, held_out = _split_news(spark, folder)
    predicted = pipeline.predict(held_out, pipeline.fit(train))
    total = F.aggregate("probabilities", F.lit(0.0), lambda whole, p: whole + p)
    return predicted.select(
        "id",
        F.col("label_idx").alias("true_label_idx"),
        (sc.argmax(F.col("probabilities")) == F.col("predicted_label_idx")).alias("is_argmax"),
        fixed(total).alias("probability_sum"),
    )


SELECTED = [naive_bayes.Candidate(1.0), naive_bayes.Candidate(0.25), naive_bayes.Candidate(1.0, 1000)]


def _selection_sql() -> str:
    rates = []
    for i, c in enumerate(SELECTED):
        text = sql.predictions(sql.NEWS, smoothing=c.smoothing, vocabulary=c.vocabulary_size, most=c.most)
        rates.append(
            f"SELECT {i} AS candidate, {c.smoothing}::DOUBLE AS smoothing, {c.vocabulary_size or 'NULL'}::BIGINT AS words, "
            f"(WITH {text} SELECT avg(CASE WHEN true_label_idx = predicted_label_idx THEN 1.0 ELSE 0 END) FROM preds) AS a"
        )
    return f"""WITH rates AS ({" UNION ALL ".join(rates)}) SELECT candidate, smoothing, words, {sql.fixed('a')} AS accuracy,
      row_number() OVER (ORDER BY a DESC, candidate) = 1 AS chosen FROM rates"""


@query(_selection_sql())
def model_selection(spark, folder):
    """The most accurate of several Bayes candidates."""
    known, rows = jobs.split_articles(news(spark, folder))
    rows = rows.withColumn("cleaned_text", tx.clean_text("text"))
    choice = naive_bayes.select_best(rows.filter("not is_val"), rows.filter("is_val"), known, SELECTED)
    found = [
        (i, c.smoothing, c.vocabulary_size, accuracy, c == choice.candidate)
        for i, (c, accuracy) in enumerate(zip(SELECTED, choice.accuracies, strict=True))
    ]
    table = spark.createDataFrame(found, "candidate int, smoothing double, words long, accuracy double, chosen boolean")
    return table.withColumn("accuracy", fixed(F.col("accuracy")))


@query(f"""WITH {sql.split(sql.NEWS)} SELECT max_iter, (SELECT count(*) FROM parts WHERE is_val) AS rows, true AS is_share,
  true AS not_above_chosen FROM (SELECT unnest([1, 2, 3]) AS max_iter)""")
def regression_candidates(spark, folder):
    """What must hold of every candidate of a selection: a whole number of right rows, and none better than the chosen one."""
    train, held_out = _split_news(spark, folder)
    tried = [pipeline.Candidate(n) for n in (1, 2, 3)]
    choice = pipeline.select_best(train, held_out, tried)
    scored = pipeline.predict(held_out, choice.model).withColumnRenamed("label_idx", "true_label_idx")
    served = metrics.accuracy(scored).first()
    found = [
        (c.max_iter, served.rows, abs(a * served.rows - round(a * served.rows)) < 1e-6,
         (a, -c.max_iter) <= (served.accuracy, -choice.candidate.max_iter))
        for c, a in zip(tried, choice.accuracies, strict=True)
    ]
    return spark.createDataFrame(found, "max_iter int, rows long, is_share boolean, not_above_chosen boolean")


@query()
def regression_selection(spark, folder):
    train, held_out = _split_news(spark, folder)
    choice = pipeline.select_best(train, held_out, [pipeline.Candidate(n) for n in (1, 2, 3)])
    scored = pipeline.predict(held_out, choice.model).withColumnRenamed("label_idx", "true_label_idx")
    return metrics.accuracy(scored).withColumn("max_iter", F.lit(choice.candidate.max_iter))


# --- streams ----------------------------------------------------------------


@query(f"""SELECT id, '{MOMENT}' AS timestamp, source, category, text, {sql.clean('text')} AS cleaned_text
  FROM ({sql.DOCUMENTS})""")
def stream_clean(spark, folder):
    arriving = read_parquet_stream(spark, f"{folder}/documents.parquet")
    raw = arriving.select(
        F.col("doc_id").alias("id"), F.lit(MOMENT).alias("timestamp"), "text", "source", F.col("lang").alias("category")
    )
    out = new_path(spark, "stream")
    clean_stream(raw, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    rows = files.read_cleaned(spark, f"{out}/rows")
    return rows.withColumn("timestamp", timestamp_text(F.col("timestamp")))


@query(f"WITH {sql.results(sql.NEWS, TURNS)} SELECT {RESULT} FROM res")
def stream_classify(spark, folder):
    model = jobs.train_on_articles(news(spark, folder))[2]
    items = with_planted_turns(read_parquet_stream(spark, f"{folder}/conversations.parquet"))
    out = new_path(spark, "stream")
    classify_stream(items, model, f"{out}/rows", f"{out}/checkpoint").awaitTermination()
    return shown(read_results(spark, f"{out}/rows"))


@query("""SELECT count(*) AS records, count(*) FILTER (WHERE event_id % 8 > 2) AS null_timestamps,
  count(*) FILTER (WHERE event_id % 3 = 0) AS null_ids FROM events""")
def stream_quality(spark, folder):
    """The counts that a cleaning stream keeps per batch, added up."""
    times = _event_times_of(read_parquet_stream(spark, f"{folder}/events.parquet"))
    raw = times.select(
        F.when(F.col("event_id") % 3 != 0, F.col("event_id")).alias("id"),
        "timestamp",
        F.lit("text").alias("text"),
        F.lit("events").alias("source"),
        F.lit("none").alias("category"),
    )
    out = new_path(spark, "stream")
    progress.clean_stream_with_counts(raw, out, f"{out}/checkpoint").awaitTermination()
    return progress.quality_total(spark, out)


@query(f"""SELECT count(*) AS rows, count(*) AS done, true AS rises, true AS all_done FROM ({TURNS})""")
def stream_progress(spark, folder):
    """A classifying stream that is watched: rows done never fall and end at the number of results."""
    model = jobs.train_on_articles(news(spark, folder))[2]
    arriving = progress.counted(with_planted_turns(read_parquet_stream(spark, f"{folder}/conversations.parquet", 1)))
    out, steps = new_path(spark, "stream"), []
    running = classify_stream(arriving, model, f"{out}/rows", f"{out}/checkpoint")
    last = progress.watch(running, lambda step: steps.append(step.done))
    rows = read_results(spark, f"{out}/rows").agg(F.count("*").alias("rows"))
    rises = steps == sorted(steps) and len(steps) == last.batches
    done = F.lit(last.done).cast("long")
    return rows.select("rows", done.alias("done"), F.lit(rises).alias("rises"), (F.col("rows") == done).alias("all_done"))
