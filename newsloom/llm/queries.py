"""The operators and the corpus pipeline as queries over the given tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import (
    chat,
    decontamination,
    fingerprints,
    language,
    merkle,
    minhash,
    oracle,
    packing,
    pii,
    pseudo_likelihood,
    simhash,
    toxicity,
    warc,
    whitening,
)

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


def share(key: str, parts: int):
    """The remainder of crc32 of the id as text."""
    return F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(parts))


@query(oracle.LEAKS)
def op1_template_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontamination.flag(docs, table(spark, folder, "benchmark"))
    items = F.array_join("leaked_items", ",").alias("leaked_items")
    return found.select("doc_id", "contaminated", items, "coverage")


OWN = "</s>[INST] ok [/INST]"

CHAT_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length(regexp_replace(text,
      '(<)(\\*)(<SYS>>|</SYS>>|s>|/s>)|(\[)(\\*)(INST\]|/INST\]|ROLE\]|/ROLE\])', '\1\4\\\2\5\3\6', 'g'))
    + CASE role WHEN 'system' THEN 8 + 11 WHEN 'user' THEN 7 + 8 WHEN 'assistant' THEN 4 + 5
      ELSE 7 + 1 + 8 + length(role) END AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


@query(CHAT_SQL)
def op2_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    own = spark.createDataFrame(
        [(-7, 0, "user", OWN), (-7, 1, "assistant", OWN)], "conv_id long, turn long, role string, text string"
    )
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.read_back(chat.format_conversations(turns)).drop("valid")


@query()
def op3_pseudo_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    return pseudo_likelihood.fit_and_score(table(spark, folder, "documents"))


@query(oracle.SPANS)
def op4_pii_sanitise(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.annotate(table(spark, folder, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["kind"] != pii.TERM)
    counts = [pii.count(F.col("spans"), kind).alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select(
        "doc_id", *counts, F.sha2(pii.listed(base), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans")
    )


@query()
def op5_minhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    found = minhash.near_duplicates(
        table(spark, folder, "documents"), likeness=minhash.Likeness(size=3, percent=85)
    )
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


@query()
def op6_bottom_k_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.edited_fingerprints(table(spark, folder, "documents"))


WARC_SQL = """
WITH sized AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), firsts AS (
  SELECT payload_digest, min(page_id) AS first FROM sized WHERE payload_bytes >= 100 GROUP BY 1
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first < page_id THEN first END AS refers_to
FROM sized LEFT JOIN firsts USING (payload_digest)
"""


@query(WARC_SQL)
def op7_warc_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    return warc.round_trip(table(spark, folder, "pages"))


@query()
def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    docs = docs.withColumn("held_out", share("doc_id", 5) == 0)
    model = language.fit(docs.filter(~F.col("held_out")))
    return language.predict(docs, model).select("doc_id", "held_out", "lang_pred", "score")


@query()
def op9_harmonic_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


@query()
def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    docs = docs.withColumn("held_out", share("doc_id", 4) == 2)
    labels = table(spark, folder, "labels").filter(share("doc_id", 4) != 2).select("doc_id", "toxic")
    model = toxicity.fit(docs.filter(~F.col("held_out")).join(labels, "doc_id"))
    return toxicity.score(docs, model).select("doc_id", "held_out", "score", "predicted")


#: A-Z to a-z and nothing else.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@query(oracle.MANIFEST)
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select(*merkle.FIELDS)
    tampered = F.when(share("doc_id", 3) == 0, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    found = merkle.verified(merkle.build(merkle.rows_of(docs, changed={"text": tampered})))
    return found.withColumnRenamed("id", "doc_id").drop("key")


@query()
def op12_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whitened(table(spark, folder, "embeddings")).withColumnRenamed("id", "vec_id")


@query()
def op13_simhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents")).withColumnRenamed("id", "doc_id")
