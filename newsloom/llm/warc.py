"""WARC archives: a writer with revisit records, and a reader that verifies boundary chains.

Reading splits archives at every place where the version line stands. Each such
place is only a candidate record: its header gives its successor's offset, and
pointer jumping from the start of each file keeps the candidates that a chain of
records reaches. A version line inside a payload is never reached, and its bytes
go back to the payload they belong to.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.llm.tables import small
from newsloom.staging import new_path, stage

MAGIC = "WARC/1.1\r\n"
BLOCK_END = "\r\n\r\n"
#: Payloads under this size are never stored as a revisit.
LEAST_REVISIT = 100
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"
#: Rounds of pointer jumping; 2**40 records in one file are more than any file holds.
MOST_ROUNDS = 40
#: The longest value of bytes that Spark holds.
LARGEST = (1 << 31) - 1


def with_revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """`(page_id, url, payload, payload_bytes, payload_digest, record_type, refers_to)`.

    Of equal payloads of at least `least` bytes the smallest page_id is the
    response. A NULL html is an empty payload. A NULL page_id never serves as the
    response of others: it comes after all numbers, and among NULLs alone each is
    a response. Rows with the same page_id and payload are all responses if they
    are the smallest.
    """
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.coalesce(F.col("url").cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload"),
    )
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long")).withColumn(
        "payload_digest", F.sha2(F.col("payload").cast("binary"), 256)
    )
    shared = (
        rows.filter(F.col("payload_bytes") >= least)
        .groupBy("payload_digest")
        .agg(F.count("*").alias("copies"), F.min("page_id").alias("first"))
        .filter("copies > 1")
        .select("payload_digest", "first")
    )
    shared = stage(shared, "warc-shared")
    is_revisit = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return rows.join(shared, "payload_digest", "left").select(
        "page_id",
        "url",
        "payload",
        "payload_bytes",
        "payload_digest",
        F.when(is_revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(is_revisit, F.col("first")).alias("refers_to"),
    )


def line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def write(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Write records as archives, one per task, through Spark's own text writer.

    A record ends with two line ends, which serve as the line separator. `compression`
    is one of the text source's; plain archives (`none`) take more disk, and byte ranges of one
    can be read by many tasks.
    """
    revisit = F.col("record_type") == "revisit"
    urn = F.lit("urn:page:")
    uri = F.regexp_replace("url", "[\\x00-\\x20\\x7F]", "%20")
    header = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.concat(F.lit("<"), urn, F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))),
        line("WARC-Date", F.lit(DATE)),
        line("WARC-Target-URI", uri),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        line("WARC-Payload-Length", F.col("payload_bytes").cast("string")),
        F.when(
            revisit,
            F.concat(
                line("WARC-Profile", F.lit(PROFILE)),
                line("WARC-Refers-To", F.concat(F.lit("<"), urn, F.col("refers_to").cast("string"), F.lit(">"))),
            ),
        ).otherwise(""),
        line("Content-Type", F.lit("text/html; charset=utf-8")),
        line("Content-Length", F.when(revisit, F.lit("0")).otherwise(F.col("payload_bytes").cast("string"))),
        F.lit("\r\n"),
    )
    body = F.when(revisit, "").otherwise(F.col("payload"))
    records.select(F.concat(header, body).alias("value")).write.text(
        path, compression=compression, lineSep=BLOCK_END
    )


def pieces(spark: SparkSession, path: str) -> DataFrame:
    """`(slot, file, block, content, head, head_bytes, length)`: what stands between version lines, written once.

    The text source splits plain archives by byte ranges, so one large file is read by
    many tasks; a compressed file is one task's, whether compressed whole or record by record, and
    offsets are those of its content. `content` runs from after a version line to the next one; `length`
    is NULL where no header with a length is found.
    """
    content = F.col("content")
    latin = F.decode(content, "ISO-8859-1")
    head_end = F.locate(BLOCK_END, latin)
    rows = spark.read.option("lineSep", MAGIC).text(path).select(
        F.monotonically_increasing_id().alias("slot"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("value").cast("binary").alias("content"),
    )
    rows = rows.withColumn("head", F.when(head_end > 0, F.substring(latin, F.lit(1), head_end + 1)).otherwise(""))
    length = F.regexp_extract("head", r"(?im)^Content-Length:[ \t]*([0-9]{1,18})[ \t]*\r?$", 1)
    rows = rows.select(
        "*",
        F.when(head_end > 0, (head_end + 3).cast("long")).alias("head_bytes"),
        F.when(length != "", length.cast("long")).alias("length"),
    )
    place = new_path(spark, "warc-pieces")
    rows.write.option("compression", "zstd").parquet(place)
    return spark.read.schema(rows.schema).parquet(place)


def candidates(parts: DataFrame) -> DataFrame:
    """`(slot, file, offset, successor)` for each place with a version line.

    A place's offset follows from the lengths of the pieces before it: first
    within its block, then over the blocks of the file. Payloads are not moved.
    """
    magic = len(MAGIC)
    sizes = parts.select(
        "file", "block", "slot", (F.octet_length("content") + magic).cast("long").alias("size"), "head_bytes", "length"
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (
        sizes.groupBy("file", "block")
        .agg(F.sum("size").alias("size"))
        .select("file", "block", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base"))
    )
    within = Window.partitionBy("file", "block").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0))).join(blocks, ["file", "block"])
    offset = F.col("base") + F.col("inner") - magic
    # The first piece of a file is what stands before its first version line: nothing in a sound archive.
    rows = placed.withColumn("offset", offset).filter("offset >= 0")
    successor = F.col("offset") + magic + F.col("head_bytes") + F.col("length") + len(BLOCK_END)
    return rows.select("slot", "file", "offset", successor.alias("successor"))


def reachable(links: DataFrame, first: int = 0) -> DataFrame:
    """`(file, offset)` of the nodes that chains from offset `first` of each file reach.

    `links` holds `(file, offset, successor)`. Pointer jumping: while every link
    doubles its length, the nodes reached so far send marks along it. After k
    rounds all nodes within 2**k steps are marked, so rounds are few even for
    long chains. Each round is written before the next one reads it.
    """
    jumps = stage(links.filter(F.col("successor") > F.col("offset")).select("file", "offset", "successor"), "warc-jumps")
    marked = stage(links.filter(F.col("offset") == first).select("file", "offset").distinct(), "warc-marked")
    for _ in range(MOST_ROUNDS):
        ahead = marked.join(jumps, ["file", "offset"]).select("file", F.col("successor").alias("offset"))
        # A pointer past the end of a file marks nothing: its offset is no node.
        grown = stage(
            marked.unionByName(ahead.join(links.select("file", "offset"), ["file", "offset"], "left_semi")).distinct(),
            "warc-marked",
        )
        after = jumps.select("file", F.col("offset").alias("successor"), F.col("successor").alias("further"))
        longer = stage(
            jumps.join(after, ["file", "successor"]).select("file", "offset", F.col("further").alias("successor")),
            "warc-jumps",
        )
        marked, jumps = grown, longer
        if jumps.isEmpty():
            return marked
    raise RuntimeError("a chain of records does not end")


def read(spark: SparkSession, path: str) -> DataFrame:
    """`(file, offset, head, payload)` of the true records of archives.

    A record whose payload holds version lines is put together from the pieces
    between it and its successor. Empty archives give no rows. A chain that
    breaks (no length, or a successor where no record starts) ends there, and
    the record with the broken link is kept only if its payload is whole. Payloads
    hold up to two gigabytes, as Spark's values do.
    """
    parts = pieces(spark, path)
    links = stage(candidates(parts), "warc-candidates")
    true = reachable(links.select("file", "offset", "successor")).withColumn("record", F.lit(True))
    in_order = Window.partitionBy("file").orderBy("offset").rowsBetween(Window.unboundedPreceding, 0)
    owner = F.last(F.when(F.col("record"), F.col("slot")), ignorenulls=True).over(in_order)
    owned = links.join(true, ["file", "offset"], "left").withColumn("owner", owner).filter("owner IS NOT NULL")
    owned = stage(owned.select("slot", "offset", "owner", "record"), "warc-owned")
    records = parts.join(small(owned.filter("record").select("slot", "offset")), "slot")
    inner = owned.filter("record IS NULL").select("slot", "offset", "owner")
    owners = small(stage(inner.select(F.col("owner").alias("slot")).distinct(), "warc-owners"))
    tails = (
        parts.select("slot", "content")
        .join(small(inner), "slot")
        .groupBy(F.col("owner").alias("slot"))
        .agg(F.array_sort(F.collect_list(F.struct("offset", "content"))).alias("parts"))
        .select(
            "slot",
            F.aggregate(
                "parts", F.lit(b""), lambda acc, part: F.concat(acc, F.lit(MAGIC.encode()), part["content"])
            ).alias("tail"),
        )
    )
    # Only records with version lines in their payload wait for what belongs to them.
    longer = records.join(owners, "slot", "left_semi").join(tails, "slot").withColumn("content", F.concat("content", "tail"))
    whole = records.join(owners, "slot", "left_anti").unionByName(longer.drop("tail"))
    # A length beyond what a value can hold belongs to no whole payload.
    length = F.least(F.col("length"), F.lit(LARGEST)).cast("int")
    payload = F.substring("content", (F.col("head_bytes") + 1).cast("int"), length)
    rows = whole.select("file", "offset", "head", "length", payload.alias("payload"))
    return rows.filter(F.octet_length("payload") == F.col("length")).drop("length")


def header(name: str) -> Column:
    return F.regexp_extract("head", rf"(?im)^{name}:[ \t]*([^\r\n]*?)[ \t]*\r?$", 1)


def page_records(records: DataFrame) -> DataFrame:
    """`(page_id, payload_bytes, payload_digest, record_type, refers_to)` from what archives hold.

    Responses are measured on the payload that was read. A revisit, which stores
    none, gets length and digest from the response that it refers to, if one with that id and the
    digest of the revisit's header was read; a revisit of a lost or other response is left out.
    Records of other types have the length and digest that their header says.
    """
    number = r"<urn:page:(-?[0-9]+)>"
    ident = F.regexp_extract(header("WARC-Record-ID"), number, 1)
    refers = F.regexp_extract(header("WARC-Refers-To"), number, 1)
    kind = header("WARC-Type")
    stored = kind == "response"
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    rows = records.select(
        F.when(ident != "", ident.try_cast("long")).alias("page_id"),
        F.when(stored, F.octet_length("payload").cast("long"))
        .otherwise(header("WARC-Payload-Length").try_cast("long"))
        .alias("payload_bytes"),
        F.when(stored, F.sha2(F.col("payload"), 256))
        .otherwise(F.regexp_extract(header("WARC-Payload-Digest"), "^sha256:(.*)$", 1))
        .alias("payload_digest"),
        kind.alias("record_type"),
        F.when(refers != "", refers.try_cast("long")).alias("refers_to"),
    )
    rows = stage(rows, "warc-records")
    revisits = rows.filter(F.col("record_type") == "revisit")
    key = ["refers_to", "payload_digest"]
    wanted = stage(revisits.select(*key).distinct(), "warc-wanted")
    responses = rows.filter(F.col("record_type") == "response").withColumn("refers_to", F.col("page_id"))
    met = responses.select(*key, "payload_bytes").join(small(wanted), key, "left_semi").distinct()
    resolved = revisits.drop("payload_bytes").join(small(stage(met, "warc-met")), key)
    return rows.filter(F.col("record_type") != "revisit").unionByName(resolved.select(columns))


def round_trip(pages: DataFrame) -> DataFrame:
    """Write pages to new archives in the shared folder and read them back."""
    spark = pages.sparkSession
    path = new_path(spark, "warc")
    write(with_revisits(pages), path)
    return page_records(read(spark, path))
