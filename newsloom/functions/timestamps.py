"""Timestamps kept as text: writing and parsing them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.text import SPACE

# The text format of ingest times, and the shapes that count as
# such a time (exact, and with one-digit fields or wider gaps).
TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
EXACT_SHAPE = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}\z"
LENIENT_SHAPE = (
    r"\A[0-9]{4}-(1[0-2]|0[1-9]|[1-9])-(3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9])"
    rf"[{SPACE}]+(2[0-3]|[01][0-9]|[0-9]):([0-5][0-9]|[0-9]):([0-5][0-9]|[0-9])\z"
)


def timestamp_text(moment: Column | None = None) -> Column:
    """A time as text; the start of the query when none is given."""
    return F.date_format(F.current_timestamp() if moment is None else moment, TEXT_FORMAT)


def parse_timestamp(column: Column | str, mode: str = "lenient") -> Column:
    """Text to timestamp, NULL where it is not one.

    `lenient` takes one-digit fields and any whitespace between date and time;
    `strict` takes the exact format only. The year 0000 is never valid.
    """
    text = F.col(column) if isinstance(column, str) else column
    if mode == "strict":
        shape, tidy, pattern = EXACT_SHAPE, text, TEXT_FORMAT
    elif mode == "lenient":
        single = F.regexp_replace(text, f"[{SPACE}]+", " ")
        shape, tidy, pattern = LENIENT_SHAPE, F.regexp_replace(single, "- ", "-"), "yyyy-M-d H:m:s"
    else:
        raise ValueError(f"unknown mode {mode!r}")
    valid = text.rlike(shape) & ~text.startswith("0000")
    return F.when(valid, F.try_to_timestamp(tidy, F.lit(pattern)))
