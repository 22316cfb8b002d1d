"""Cleaners against edge rows and a plain statement of their contract."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from changelake.functions import clean_code, clean_date, clean_number, clean_whitespace

NUMBERS = [
    (None, None),
    ("", None),
    ("1,234.50", 123450),
    ("1000.00", 100000),
    ("12 000", 12000),
    ("\t77\n", 77),
    ("-5", None),
    ("None", None),
    ("3000000000", 3000000000),
    ("99999999999999999999", None),
    ("12\t3", None),
    ("²", None),
]
DATES = [
    (None, None),
    ("", None),
    ("   ", None),
    ("2024-01-05", "05-01-2024"),
    ("05/01/2024", "05-01-2024"),
    ("5.1.2024", "05-01-2024"),
    (" 5 1 2024 ", "05-01-2024"),
    ("+5/01/2024", "05-01-2024"),
    ("29/02/2024", "29-02-2024"),
    ("29/02/2023", None),
    ("1/13/2024", None),
    ("01-01-24", None),
    ("0999-01-01", None),
    ("1//2/2024", None),
    ("2024-01-05T10:00:00", None),
    ("2024-01-05 10:00:00", None),
    ("a/b/2024", None),
    ("2024-001-0005", "05-01-2024"),
    ("2024-0-1", None),
    ("99999999999/1/2024", None),
]
SPACES = [
    (None, None),
    ("", None),
    ("   ", ""),
    (" a\t\n b ", "a b"),
    ("a 　b\x1c", "a b"),
    ("x" * 50 + " " * 5000 + "y", "x" * 50 + " y"),
]
CODES = [
    (None, None),
    ("", None),
    ("---", ""),
    ("007", "007"),
    ("nv-01/Ấp é×ß", "NV01ẤPÉ×SS"),
]


@pytest.mark.parametrize(
    "cleaner, rows",
    [
        (clean_number, NUMBERS),
        (clean_date, DATES),
        (clean_whitespace, SPACES),
        (clean_code, CODES),
    ],
)
def test_edge_rows(spark, cleaner, rows):
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(rows)], "i int, v string")
    got = {r.i: r.out for r in df.select("i", cleaner(F.col("v")).alias("out")).collect()}
    assert got == {i: want for i, (_, want) in enumerate(rows)}


FORMS = ("{y}-{m:02}-{d:02}", "{y}/{m}/{d}", " {y}.{m}.{d} ", "{d:02}/{m:02}/{y}", "{d}.{m}.{y}", "{d} {m} {y}\n", "+{d}-0{m}-{y}")
SPOILT = (
    "{d}/{m}", "{d}/{m}/{y}/1", "{d}//{m}/{y}", "{d}/{m}/{y}x", "x{y}-{m}-{d}", "{d}/{m}/y", "{d}/-{m}/{y}", "{d}_{m}_{y}",
    "{d}/{m}/0{d:02}", "{y}-{m}-{y}", "{d}/1{y}/{m}", "{y}{m:02}{d:02}", "{y}-{m}-{d}T00:00:00", "{d}/{m}/{y}0",
)


def test_written_dates_come_back_and_spoilt_ones_do_not(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(400):
        day = date(rng.randint(1000, 9999), rng.randint(1, 12), rng.randint(1, 28)) + timedelta(days=rng.randint(0, 3))
        parts = {"y": day.year, "m": day.month, "d": day.day}
        rows += [(form.format(**parts), f"{day.day:02}-{day.month:02}-{day.year}") for form in FORMS if day.year <= 9999]
        rows += [(form.format(**parts), None) for form in SPOILT]
    for year in (1900, 2023, 2100):
        rows += [(f"29/2/{year}", None), (f"{year}-2-29", None)]
    rows += [(f"31/{month}/2024", None) for month in (2, 4, 6, 9, 11)] + [("1/13/2024", None), ("0/1/2024", None), ("32/1/2024", None)]
    df = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(rows)], "i int, v string")
    got = {r.i: r.out for r in df.select("i", clean_date("v").alias("out")).collect()}
    assert {v: got[i] for i, (v, _) in enumerate(rows)} == dict(rows)
