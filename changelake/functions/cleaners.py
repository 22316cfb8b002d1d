"""Text cleaners as Column expressions, so that silver plans run no Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028"
    "\u2029\u202f\u205f\u3000"
)
WHITESPACE_CLASS = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# The letters and digits a code may hold.
CODE_CHARACTERS = "0-9A-Za-z\u00c0-\u1ef9"


def _text(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def strip(value: Column | str) -> Column:
    """Text without leading and trailing white space."""
    return F.trim(_text(value), F.lit(WHITESPACE))


def clean_number(value: Column | str) -> Column:
    """Digits of an amount as bigint, `,` `.` and spaces removed; else null."""
    text = _text(value)
    for mark in ",. ":
        text = F.replace(text, F.lit(mark), F.lit(""))
    return _cast_found(F.regexp_extract(strip(text), r"\A([0-9]+)\z", 1), "bigint")


def _cast_found(text: Column, kind: str) -> Column:
    """Null for empty text, and a cast for other; a cast that fails is dear."""
    return F.nullif(text, F.lit("")).try_cast(kind)


# A year from 1000 to 9999, a month and a day; signs and zeros before them drop out.
_YEAR = r"\+?0*([1-9][0-9]{3})"
_MONTH = r"\+?0*(1[0-2]|[1-9])"
_DAY = r"\+?0*([12][0-9]|3[01]|[1-9])"
_YEAR_FIRST = rf"\A{_YEAR}[-/. ]{_MONTH}[-/. ]{_DAY}\z"
_YEAR_LAST = rf"\A{_DAY}[-/. ]{_MONTH}[-/. ]{_YEAR}\z"


def clean_date(value: Column | str) -> Column:
    """`y-m-d` or `d-m-y`, parted by `-` `/` `.` or space, as `dd-MM-yyyy`; else null."""
    text = strip(value)
    # Text of neither form costs two failing matches, which end at the first odd character.
    iso = F.when(text.rlike(_YEAR_FIRST), F.regexp_replace(text, _YEAR_FIRST, "$1-$2-$3")).when(
        text.rlike(_YEAR_LAST), F.regexp_replace(text, _YEAR_LAST, "$3-$2-$1")
    )
    return F.date_format(iso.try_cast("date"), "dd-MM-yyyy")


# Characters that count as white space and that no text holds once they are made spaces.
_OPEN, _CLOSE = "\x1c", "\x1d"


def clean_whitespace(value: Column | str) -> Column:
    """Text stripped, each run of white space made one space; empty text is null."""
    text = _text(value)
    # Characters are looked up and marks replaced; a regular expression costs some times as much.
    spaced = F.translate(text, WHITESPACE, " " * len(WHITESPACE))
    marked = F.replace(spaced, F.lit(" "), F.lit(_OPEN + _CLOSE))
    single = F.replace(F.replace(marked, F.lit(_CLOSE + _OPEN), F.lit("")), F.lit(_OPEN + _CLOSE), F.lit(" "))
    return F.when(text != "", F.trim(F.when(F.contains(spaced, F.lit("  ")), single).otherwise(spaced)))


_NO_CODE = f"[^{CODE_CHARACTERS}]"
_ASCII_NO_CODE = "".join(chr(i) for i in range(128) if not chr(i).isalnum())


def clean_code(value: Column | str) -> Column:
    """Letters and digits only, in upper case; empty text is null."""
    text = _text(value)
    # Only text with letters beyond ASCII may hold more to take out, and rarely does.
    kept = F.translate(text, _ASCII_NO_CODE, "")
    more = (F.octet_length(kept) != F.char_length(kept)) & kept.rlike(_NO_CODE)
    return F.when(text != "", F.upper(F.when(more, F.regexp_replace(kept, f"{_NO_CODE}+", "")).otherwise(kept)))
