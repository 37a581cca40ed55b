import pytest
from pyspark.sql import functions as F

from newsloom.functions.timestamps import parse_timestamp, timestamp_text

FULL = "2024-01-02 03:04:05"
CASES = [
    (FULL, FULL, FULL),
    ("2024-1-2 3:4:5", None, FULL),
    ("2024-01-02  03:04:05", None, FULL),
    ("2024-01-02\t03:04:05", None, FULL),
    ("2024-01-02 03:04:05", None, FULL),
    ("2024-01- 2 03:04:05", None, FULL),
    ("2024-02-30 00:00:00", None, None),
    ("2024-01-02 24:00:00", None, None),
    ("2024-01-02 03:04:60", None, None),
    ("2024-01-02T03:04:05", None, None),
    ("2024-01-02", None, None),
    (" 2024-01-02 03:04:05", None, None),
    ("2024-01-02 03:04:05 ", None, None),
    ("2024-01-02 03:04:05\n", None, None),
    ("2024-01-02 03:04:05.5", None, None),
    ("", None, None),
    (None, None, None),
    ("0000-01-02 03:04:05", None, None),
    ("2024-02-29 23:59:59", "2024-02-29 23:59:59", "2024-02-29 23:59:59"),
    ("2023-02-29 23:59:59", None, None),
    ("0001-01-01 00:00:00", "0001-01-01 00:00:00", "0001-01-01 00:00:00"),
]


@pytest.mark.parametrize("mode, place", [("strict", 1), ("lenient", 2)])
def test_parse(spark, mode, place):
    rows = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, t string")
    parsed = timestamp_text(parse_timestamp("t", mode))
    got = [r.p for r in rows.select("i", parsed.alias("p")).orderBy("i").collect()]
    assert got == [c[place] for c in CASES]


def test_unknown_mode():
    with pytest.raises(ValueError):
        parse_timestamp(F.lit("x"), "loose")
