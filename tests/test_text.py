import pytest
from pyspark.sql import functions as F

from newsloom.functions import text as tx

CLEANED = [
    (None, None),
    ("", ""),
    ("   ", ""),
    ("123 !!", ""),
    ("Visit HTTPS://a.b/c?d=1 now", "visit now"),
    ("xhttpfoo bar", "x bar"),
    ("http alone", "http alone"),
    ("mail a@b.com", "mail acom"),
    ("@bob_1 hi #tag2 x", "hi x"),
    ("it&#39;s", "its"),
    ("Ouè l'été", "ou lt"),
    ("a b\t\nc\u001cd", "a b c d"),
    ("U.S. 2-1 win", "us win"),
    ("@http://x.y z", "z"),
    ("@a http@b #c #d", ""),
    ("one - two --three\r\n\r\nfour", "one two three four"),
    ("Kelvin", "kelvin"),
    ("hash# alone @ too", "hash alone too"),
    ("#été x", "x"),
]


def apply(spark, change, values):
    rows = spark.createDataFrame(list(enumerate(values)), "i int, text string")
    return [r.out for r in rows.select("i", change(F.col("text")).alias("out")).orderBy("i").collect()]


def test_clean_text(spark):
    assert apply(spark, tx.clean_text, [t for t, _ in CLEANED]) == [c for _, c in CLEANED]


def test_clean_is_idempotent_without_fresh_urls(spark):
    once = [c for _, c in CLEANED]
    calm = [c for c in once if c is None or "http" not in c]
    assert apply(spark, tx.clean_text, calm) == calm


def test_whitespace_and_letters_per_code_point(spark):
    """Every character below the surrogates, one at a time, between letters."""
    points = list(range(1, 0xD800))
    rows = spark.range(0xD800).filter("id > 0").repartition(4)
    char = F.expr("decode(unhex(lpad(hex(id), 8, '0')), 'UTF-32')")
    text = F.concat(F.lit("a"), char, F.lit("b"))
    got = rows.select(
        "id",
        tx.collapse_spaces(text).alias("collapsed"),
        tx.letters_only(text).alias("letters"),
        tx.strip(F.concat(char, F.lit("x"), char)).alias("stripped"),
        tx.is_blank(char).alias("blank"),
    ).collect()
    assert len(got) == len(points)
    for r in got:
        c = chr(r.id)
        assert r.collapsed == ("a b" if c.isspace() else f"a{c}b"), r.id
        assert r.letters == (f"a{c}b" if c.isspace() or "a" <= c <= "z" else "ab"), r.id
        assert r.stripped == ("x" if c.isspace() else f"{c}x{c}"), r.id
        assert r.blank == c.isspace(), r.id


@pytest.mark.parametrize(
    "text, blank, long_enough, ascii_content",
    [
        (None, True, False, None),
        ("", True, False, False),
        (" \t", True, False, False),
        (" ", True, False, True),
        ("  nine char ", False, False, True),
        ("ten  chars", False, True, True),
    ],
)
def test_guards(spark, text, blank, long_enough, ascii_content):
    assert apply(spark, tx.is_blank, [text]) == [blank]
    assert apply(spark, tx.is_long_enough, [text]) == [long_enough]
    assert apply(spark, tx.has_ascii_content, [text]) == [ascii_content]


def test_excerpt_always_ends_in_dots(spark):
    assert apply(spark, tx.excerpt, ["short", "x" * 300, None]) == ["short...", "x" * 200 + "...", None]


def test_strip_keeps_inner_newlines(spark):
    assert apply(spark, tx.strip, [" a\n b \n"]) == ["a\n b"]
