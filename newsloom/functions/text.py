"""Text columns: cleaning, stripping and blank tests, all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode whitespace and word characters of the cleaning rules.
SPACE = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WORD = r"[\p{L}\p{N}_]"


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column


def strip_urls(column: Column | str) -> Column:
    """Remove `http` and everything up to the next whitespace."""
    return F.regexp_replace(_col(column), f"http[^{SPACE}]+", "")


def strip_mentions(column: Column | str) -> Column:
    """Remove `@name`."""
    return F.regexp_replace(_col(column), f"@{WORD}+", "")


def strip_hashtags(column: Column | str) -> Column:
    """Remove `#tag`."""
    return F.regexp_replace(_col(column), f"#{WORD}+", "")


def letters_only(column: Column | str) -> Column:
    """Keep a-z and whitespace; everything else goes without leaving a gap.

    Letters and blanks fail the first, short class and skip the long one.
    """
    return F.regexp_replace(_col(column), f"[[^a-z ]&&[^{SPACE}]]+", "")


def _single_blanks(column: Column) -> Column:
    return F.trim(F.regexp_replace(column, "  +", " "))


def collapse_spaces(column: Column | str) -> Column:
    """Turn every whitespace run into one blank and trim the ends."""
    return _single_blanks(F.regexp_replace(_col(column), f"[[^a-z ]&&[{SPACE}]]", " "))


def clean_text(column: Column | str) -> Column:
    """Lowercase, drop URLs, mentions and hashtags, keep letters, collapse blanks.

    Most articles hold no URL, mention or hashtag; a substring test is much
    cheaper than three passes of a regular expression. Once only letters and
    whitespace are left, whitespace is whatever is not a letter.
    """
    lowered = F.lower(_col(column))
    marked = lowered.contains("http") | lowered.contains("@") | lowered.contains("#")
    bare = F.when(marked, strip_hashtags(strip_mentions(strip_urls(lowered)))).otherwise(lowered)
    return _single_blanks(F.regexp_replace(letters_only(bare), "[^a-z ]", " "))


def strip(column: Column | str) -> Column:
    """Trim Unicode whitespace from both ends."""
    return F.regexp_replace(_col(column), rf"\A[{SPACE}]+|[{SPACE}]+\z", "")


def is_blank(column: Column | str) -> Column:
    """True for NULL and for text of whitespace alone."""
    column = _col(column)
    return column.isNull() | ~column.rlike(f"[^{SPACE}]")


def is_long_enough(column: Column | str, least: int = 10) -> Column:
    """True when the stripped text has at least `least` characters."""
    return F.coalesce(F.length(strip(column)) >= least, F.lit(False))


def has_ascii_content(column: Column | str) -> Column:
    """True unless the line holds ASCII whitespace alone."""
    return _col(column).rlike(r"[^\t-\r ]")


def excerpt(column: Column | str, size: int = 200) -> Column:
    """The first `size` characters and an ellipsis, which is always added."""
    return F.concat(F.substring(_col(column), 1, size), F.lit("..."))
