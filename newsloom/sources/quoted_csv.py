"""CSV whose quoted fields hold line breaks, each file read by many tasks.

Whether a line starts a record depends on whether all lines before it left a quote
open. Spark's text source deals a file out in blocks, and a block does not know; but
it can tell, for either state at its start, the state at its end and how many
records start in it. These two-state functions, one short row per block, are composed
in file order and give every block its true state. In a second pass each block
emits its records; what belongs to a record of a block before goes to that record's
owner, so only the pieces of records that cross a border are brought together.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsloom.staging import stage

QUOTE, COMMA = b'"', b","
BLOCK_KEY = ["file", "start", "length"]
STATES = "file string, start long, length long, open_after_closed boolean, open_after_open boolean, "
STATES += "records_after_closed long, records_after_open long"
RECORDS = "file string, start long, ordinal long, piece long, whole boolean, record binary"
#: Records handed back to Spark at a time.
BATCH = 2_000


def open_at_end(line: bytes, is_open: bool) -> bool:
    """Whether a quoted field is open after a line, given whether one was open before it.

    A quote opens a field only where the field starts; a doubled one stands for
    itself; after any other character behind a closing quote the field counts as unquoted.
    """
    if QUOTE not in line:
        return is_open
    at = 0
    while True:
        if not is_open:
            if not line.startswith(QUOTE, at):
                at = line.find(COMMA + QUOTE, at)
                if at < 0:
                    return False
                at += 1
            at += 1
        closing = line.find(QUOTE, at)
        if closing < 0:
            return True
        if line.startswith(QUOTE, closing + 1):
            is_open, at = True, closing + 2
            continue
        comma = line.find(COMMA, closing + 1)
        if comma < 0:
            return False
        is_open, at = False, comma + 1


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines, parted by line feeds only, with the block each one starts in."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("_metadata.file_block_length").alias("length"),
        F.col("value").cast("binary").alias("line"),
    )


def _is_blank(line: bytes) -> bool:
    return line in (b"", b"\r")


def _block_states(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The function of each block; the lines of one come one after another."""
    found: dict[tuple, list] = {}
    for batch in source:
        keys = zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)
        for key, line in zip(keys, batch.column(3).to_pylist(), strict=True):
            state = found.setdefault(key, [False, True, 0, 0])
            if not _is_blank(line):
                state[2] += not state[0]
                state[3] += not state[1]
            if QUOTE in line:
                state[0], state[1] = open_at_end(line, state[0]), open_at_end(line, state[1])
    columns = list(zip(*[(*key, *state) for key, state in found.items()], strict=True)) or [[]] * 7
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64()]
    names = [part.split()[0] for part in STATES.split(", ")]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def block_starts(states: DataFrame) -> DataFrame:
    """`(file, start, length, is_open, ends_open, first_record, owner)`: the functions of the blocks composed in file order.

    `is_open` is the state at a block's start, `ends_open` that at its end, `first_record` the number of records that start
    in its file before it, `owner` the last block before it where one starts. A block whose end is
    the same for both states settles the state; the others keep or turn it, so the state is
    that of the last settled block, turned as often as a block turned it since. There is one row
    per block of a file, as many as the scan has input splits.
    """
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    settled = F.col("open_after_closed") == F.col("open_after_open")
    turned = (~settled & F.col("open_after_closed")).cast("int")
    marked = states.withColumns({"_settled": settled.cast("int"), "_turned": turned})
    marked = marked.withColumns({
        "_run": F.coalesce(F.sum("_settled").over(before), F.lit(0)),
        "_last": F.last(F.when(settled, F.col("open_after_closed").cast("int")), ignorenulls=True).over(before),
    })
    # Turns since the last settled block, which is the first row of a run and never turns.
    all_turns = F.coalesce(F.sum("_turned").over(before), F.lit(0))
    marked = marked.withColumn("_turns", all_turns)
    since = Window.partitionBy("file", "_run")
    turns = F.col("_turns") - F.min("_turns").over(since)
    known = marked.withColumn("is_open", (F.coalesce("_last", F.lit(0)) + turns) % 2 == 1)
    starting = F.when(F.col("is_open"), F.col("records_after_open")).otherwise(F.col("records_after_closed"))
    ending = F.when(F.col("is_open"), F.col("open_after_open")).otherwise(F.col("open_after_closed"))
    known = known.withColumns({"_records": starting, "ends_open": ending})
    return known.select(
        *BLOCK_KEY,
        "is_open",
        "ends_open",
        F.coalesce(F.sum("_records").over(before), F.lit(0)).alias("first_record"),
        F.last(F.when(F.col("_records") > 0, F.col("start")), ignorenulls=True).over(before).alias("owner"),
    )


def _records(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of blocks whose state at the start is known.

    A record that ends in its block is whole. What is open at a block's end, and what
    comes before a block's first record, are pieces: of the record `ordinal` of block `start`, the owner,
    in the order of `piece`, the block they come from.
    """
    ready: list[tuple] = []
    block, owner, ordinal, is_open, lines = None, None, 0, False, []

    def close(whole: bool) -> None:
        file, start = block[0], block[1]
        text = b"\n".join(lines)
        if owner is None:
            ready.append((file, start, ordinal, start, whole, text))
        else:
            # The rest of a record of another block; -1 stands for its last one.
            ready.append((file, owner, -1, start, False, text))

    def flush() -> pa.RecordBatch:
        columns = list(zip(*ready, strict=True)) or [[]] * 6
        kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
        names = ["file", "start", "ordinal", "piece", "whole", "record"]
        made = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)
        ready.clear()
        return made

    for batch in source:
        for file, start, line, opened, first_owner in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if (file, start) != block:
                if lines:
                    close(False)
                block, ordinal, is_open, lines = (file, start), -1, opened, []
                owner = first_owner if opened else None
            if not is_open and not lines:
                if _is_blank(line):
                    continue
                ordinal, owner = ordinal + 1, None
            lines.append(line)
            is_open = open_at_end(line, is_open)
            if not is_open:
                close(True)
                lines = []
                if len(ready) >= BATCH:
                    yield flush()
    if lines:
        close(False)
    yield flush()


def records(spark: SparkSession, path: str) -> DataFrame:
    """`(file, start, ordinal, number, whole, record)`: every record's text, blank lines left out.

    `number` counts the records of a file from 0 (its header), `start` and `ordinal` tell the block a record
    starts in and its place there; `whole` is false for a record that shares a block's border, which is the last one
    of its block. Line breaks inside quotes are kept as they are; a carriage return before a
    line feed that ends a record is not part of it. A quote left open makes the rest of the file one record.
    """
    lines = _lines(spark, path)
    starts = stage(block_starts(stage(lines.mapInArrow(_block_states, STATES), "csv-states")), "csv-blocks")
    placed = lines.join(F.broadcast(starts), BLOCK_KEY, "left")  # one row per input split
    sure = F.when(F.col("first_record").isNull(), F.raise_error(F.lit("files were split differently"))).otherwise(F.col("is_open"))
    placed = placed.select("file", "start", "line", sure.alias("is_open"), "owner")
    columns = ["file", "start", "ordinal", "whole", "record"]
    found = placed.mapInArrow(_records, RECORDS).filter("whole").select(*columns)
    # The blocks that share a record with another one or end inside it, read again for its pieces alone.
    involved = starts.filter("is_open OR ends_open").select("file", "start")
    if not involved.isEmpty():
        some = placed.join(F.broadcast(involved), ["file", "start"], "left_semi")
        pieces = some.mapInArrow(_records, RECORDS).filter("NOT whole")
        texts = F.transform(F.array_sort(F.collect_list(F.struct("piece", "record"))), lambda p: p["record"].cast("string"))
        joined = pieces.groupBy("file", "start").agg(
            F.max("ordinal").alias("ordinal"), F.lit(False).alias("whole"), F.array_join(texts, "\n").cast("binary").alias("record")
        )
        found = found.unionByName(joined)
    text = F.regexp_replace(F.col("record").cast("string"), r"\r$", "")
    numbered = found.join(F.broadcast(starts.select("file", "start", "first_record")), ["file", "start"])
    number = (F.col("first_record") + F.col("ordinal")).alias("number")
    return numbered.select("file", "start", "ordinal", number, "whole", text.alias("record"))


def number_records(rows: DataFrame, id_col: str = "id") -> DataFrame:
    """Number what is left of the records of `records` from 0 in file order.

    Rows of a block keep their order in their task; a record that shares a border is
    the last of its block. Rows are written once with their slots, blocks are counted, and
    the sizes of the blocks before turn slots into numbers.
    """
    others = [c for c in rows.columns if c not in ("file", "start", "ordinal", "number", "whole")]
    slots = rows.select(F.monotonically_increasing_id().alias("_slot"), "file", "start", "whole", *others)
    kept = stage(slots, "csv-rows")
    before = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = stage(
        kept.groupBy("file", "start")
        .agg(F.count("*").alias("_n"), F.min(F.when(F.col("whole"), F.col("_slot"))).alias("_first"))
        .withColumn("_offset", F.coalesce(F.sum("_n").over(before), F.lit(0))),
        "csv-block-sizes",
    )
    inside = F.when(F.col("whole"), F.col("_slot") - F.col("_first")).otherwise(F.col("_n") - 1)
    return kept.join(F.broadcast(blocks), ["file", "start"]).select(
        (F.col("_offset") + inside).cast("long").alias(id_col), *others
    )
