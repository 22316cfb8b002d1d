"""Cleaners that take no regular expression where none is needed."""

import io
from contextlib import redirect_stdout

from changelake.functions import clean_code, clean_whitespace
from changelake.functions.cleaners import WHITESPACE

def plan(df):
    with redirect_stdout(io.StringIO()) as text:
        df.explain("formatted")
    return text.getvalue()


def test_white_space_is_cleaned_without_a_regular_expression(spark):
    rows = [(f"{c}a{c}{c}b {c} c{c}",) for c in WHITESPACE] + [("",), (" \t ",), (None,)]
    df = spark.createDataFrame(rows, "t string")
    out = df.select("t", clean_whitespace("t").alias("c"))
    assert "regexp" not in plan(out)
    want = {None: None, "": None, " \t ": ""}
    assert all(r.c == (want[r.t] if r.t in want else "a b c") for r in out.collect())


def test_codes_of_ascii_meet_no_regular_expression(spark):
    df = spark.createDataFrame([("a-b/1\x00.\x7f",), ("đ×\xbfé-ỹ\u1efa中z",), ("--",), ("",), (None,)], "t string")
    out = df.select("t", clean_code("t").alias("c"))
    assert "translate" in plan(out)
    assert [r.c for r in out.collect()] == ["AB1", "Đ×ÉỸZ", "", None, None]
