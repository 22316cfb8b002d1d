"""Benchmark decontamination by templates.

Texts become sequences of template tokens: words in lower case, with typed placeholders
for numbers, names and units, whose values are the slots. Windows of template tokens are
hashed and joined with those of the benchmark, so a question also matches if its numbers
or names were exchanged. Matches of one document and item that lie on neighbouring diagonals
belong to one copy; it counts if each value of the item stands for one value of the document
throughout.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changelake.llm.bloom import bloom, maybe
from changelake.llm.columns import chunks, stored, text_hash
from changelake.llm.words import CHUNK, LOWER, SPACE, mix, ngrams, span_hashes, words

#: Template tokens of a window. Shorter items are one window each, down to the fewest tokens.
WINDOW = 8
FEWEST = 4
#: Tokens of an item that a copy covers at least; all but a fifth of a shorter item.
COVERED = 13
SHARE = 0.8
#: Diagonals that the parts of one copy may be apart, by tokens added or left out.
DRIFT = 3
#: Share of a window's tokens that are words, not placeholders, at least; others count with their values.
WORDS = 0.5

#: Units that may follow a number.
UNITS = (
    "mm cm m km in inch inches ft foot feet yd yard yards mi mile miles meter meters metre metres kilometer kilometers"
    " kilometre kilometres mg g kg gram grams kilogram kilograms oz ounce ounces lb lbs pound pounds ton tons tonne tonnes"
    " ml cl l liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours day days"
    " week weeks month months year years kmh mph hz khz mhz ghz v w kw a j kj cal kcal n pa kpa bar"
    " usd eur gbp dollar dollars cent cents euro euros percent degree degrees"
).split()

#: Numbers that are written out; the second list also follows one of the tens with a hyphen.
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()
ONES = "two three four five six seven eight nine".split()
WRITTEN = [
    *"ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen hundred thousand million billion".split(),
    *TENS, *ONES, *(f"{ten}-{one}" for ten in TENS for one in ["one", *ONES]),
]

#: Added to the hashes of windows that count with their values.
VALUES = np.uint64(0x6A09E667F3BCC909)
NUMBER, NAME, UNIT = (np.uint64(value) for value in (0x1D8E4E27C47D124F, 0x2545F4914F6CDD1D, 0x27BB2EE687B0B0FD))


def _table(letters: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(letters)] = True
    return out


_DIGIT, _UPPER, _LOWER = (_table(bytes(range(*span))) for span in ((0x30, 0x3A), (0x41, 0x5B), (0x61, 0x7B)))
_WORD = _DIGIT | _UPPER | _LOWER | (np.arange(256) >= 0x80)
_STOP = _table(b".!?\n")


@dataclass
class Template:
    """Tokens in text order: row, hash, and the hash of the value if it is a placeholder, else 0."""

    row: np.ndarray
    hash: np.ndarray
    slot: np.ndarray
    #: Number of each row's first token, and one number past the last row's tokens.
    first: np.ndarray
    #: Each row's tokens before runs were made one.
    single: np.ndarray


def _hashes(names: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(names).encode(), np.uint8)
    return np.sort(words(data, np.array([0, len(data)])).hash)


def _letters(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and length of the characters of scripts without spaces, and of their punctuation."""
    padded = np.append(data, np.zeros(1, np.uint8))
    lead, second = padded[:-1], padded[1:]
    three = (lead == 0xE0) & (second >= 0xB8) & (second <= 0xBB)  # Thai, Lao
    three |= (lead == 0xE1) & ((second >= 0x80) & (second <= 0x82) | (second >= 0x9E) & (second <= 0x9F))  # Burmese, Khmer
    three |= (lead == 0xE3) & ((second <= 0x83) | (second >= 0x90)) | (lead >= 0xE4) & (lead <= 0xE9)  # kana, ideographs
    three |= (lead == 0xEF) & ((second >= 0xA4) & (second <= 0xAB) | (second == 0xBC))  # compatible ideographs, wide signs
    four = (lead == 0xF0) & (second >= 0xA0) & (second <= 0xAF)
    start = np.flatnonzero(three | four)
    return start, np.where(four[start], 4, 3)


def _spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of each word; in scripts without spaces, of each character but punctuation."""
    found = words(data, offsets)
    letter, size = _letters(data)
    if not len(letter):
        return found.row, found.start, found.end
    start = np.unique(np.concatenate([found.start, letter, letter + size]))
    of = np.searchsorted(found.start, start, "right") - 1
    inside = start < found.end[of]
    start, of = start[inside], of[inside]
    end = np.minimum(np.append(start[1:], len(data)), found.end[of])
    padded = np.append(data, np.zeros(2, np.uint8))
    lead, second, third = (padded[start + n] for n in range(3))
    sign = (lead == 0xE3) & (second == 0x80) & (third != 0x85)
    sign |= (lead == 0xEF) & (second == 0xBC) & ((third < 0x90) | (third > 0x99) & (third < 0xA1) | (third > 0xBA))
    return found.row[of][~sign], start[~sign], end[~sign]


def template(data: np.ndarray, offsets: np.ndarray, opening: bool = False) -> Template:
    """Template tokens of the rows' texts.

    A token is a word without the ASCII punctuation around it. One with a digit is a
    number, and so is one that is written out. A capital followed by a small letter makes a name, but at the start of a
    sentence or line. A unit is one only after a number. In scripts without spaces each
    character is a token. Names with only white space between them are one, and so are
    numbers that are written out, or in groups of three digits. With `opening`, a text's first
    token may be a name too, as it is when it is quoted after a comma or colon.
    """
    row, start, end = _spans(data, offsets)
    # Capitals of the Latin-1 supplement are the second byte of two.
    capital = _UPPER[data]
    second = np.zeros(len(data), bool)
    second[1:] = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
    folded = LOWER[data] + np.where(second, 0x20, 0).astype(np.uint8)
    places = np.flatnonzero(_WORD[data])
    low, high = np.searchsorted(places, start), np.searchsorted(places, end)
    kept = low < high
    start, end, row = places[low[kept]], places[high[kept] - 1] + 1, row[kept]
    value = span_hashes(folded, start, end)

    def count(flags: np.ndarray) -> np.ndarray:
        return np.append(0, np.cumsum(flags))

    digits, stops = count(_DIGIT[data]), count(_STOP[data])
    figures = digits[end] > digits[start]
    written = np.isin(value, _hashes(WRITTEN))
    number = figures | written
    begins = np.ones(len(start), bool)
    begins[1:] = (row[1:] != row[:-1]) | (stops[start[1:]] > stops[end[:-1]])
    ends = begins.copy()
    if opening:
        begins[:1] = False
        begins[1:] &= row[1:] == row[:-1]
    padded = np.append(data, np.zeros(4, np.uint8))
    wide = np.append(second, False)[start + 1]
    after = padded[np.where(wide, start + 2, start + 1)]
    name = (capital[start] | wide) & (_LOWER[after] | (after >= 0x80)) & ~begins & ~number
    unit = np.zeros(len(start), bool)
    unit[1:] = number[:-1] & (row[1:] == row[:-1]) & np.isin(value[1:], _hashes(UNITS))
    name &= ~unit
    token = np.select([number, name, unit], [NUMBER, NAME, UNIT], value)
    slot = np.where(number | name | unit, value, np.uint64(0))
    filled = count(~SPACE[data])
    run = np.zeros(len(start), bool)
    three = figures & (end - start == 3) & (digits[end] - digits[start] == 3)
    run[1:] = (name[1:] & name[:-1]) | (written[1:] & written[:-1]) | (three[1:] & figures[:-1])
    run[1:] &= (filled[start[1:]] == filled[end[:-1]]) & ~ends[1:]
    rows = np.arange(len(offsets))
    single = np.diff(np.searchsorted(row, rows))
    if run.any():
        heads = np.flatnonzero(~run)
        sizes = np.diff(np.append(heads, len(run)))
        place = np.arange(len(run)) - np.repeat(heads, sizes)
        together = np.add.reduceat(slot * np.power(NAME, place.astype(np.uint64)), heads)
        row, token, slot = row[heads], token[heads], np.where(sizes > 1, mix(together), slot[heads])
    return Template(row, token, slot, np.searchsorted(row, rows), single)


def _windows(found: Template, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First token and hash of each window of `size` tokens of one row, with its values if it has too few words."""
    number = len(found.hash) - size + 1
    if number <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    start = np.flatnonzero(found.row[:number] == found.row[size - 1 :])
    words_ = np.append(0, np.cumsum(found.slot == 0))
    plain = words_[start + size] - words_[start] >= WORDS * size
    plain &= size >= FEWEST
    values = np.where(found.slot == 0, found.hash, found.slot)
    hashes = np.where(plain, ngrams(found.hash, size)[start], ngrams(values, size)[start] + VALUES)
    return start, hashes + np.uint64(size)


_WINDOW = "id long, text_hash long, hash long, place long, length long, slots array<long>, opening boolean"


def _window_rows(texts: DataFrame, sizes: list[int] | None, filter_: np.ndarray | None) -> DataFrame:
    """A row per window: its hash, its place, the length of its text, and the window's slots.

    With `sizes` None, texts have windows of `WINDOW` tokens, or one of all their tokens, and
    `opening` ones where their first token may be a name; else, all windows of these sizes
    that may be in the filter.
    """
    held = None if filter_ is None else texts.sparkSession.sparkContext.broadcast(filter_)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in chunks(batches, "text", CHUNK):
            found = template(data, offsets)
            yield from windows(batch, found, np.ones(batch.num_rows, bool), False)
            if sizes is None:
                other = template(data, offsets, opening=True)
                some = np.diff(found.first) > 0
                some[some] = found.hash[found.first[:-1][some]] != other.hash[other.first[:-1][some]]
                yield from windows(batch, other, some, True)

    def windows(batch: pa.RecordBatch, found: Template, wanted: np.ndarray, opening: bool) -> Iterator[pa.RecordBatch]:
        length = np.diff(found.first)
        for size in sizes or range(1, WINDOW + 1):
            start, hashes = _windows(found, size)
            if sizes is None:
                whole = wanted[found.row[start]]
                if size < WINDOW:
                    whole &= (length[found.row[start]] == size) & (found.single[found.row[start]] >= FEWEST)
                start, hashes = start[whole], hashes[whole]
            if held is not None:
                may = maybe(held.value, hashes)
                start, hashes = start[may], hashes[may]
            row = found.row[start]
            slots = found.slot[start[:, None] + np.arange(size)].ravel().view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(start) + 1) * size, pa.int32()), pa.array(slots))
            rows = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(rows),
                    batch.column(1).take(rows),
                    pa.array(hashes.view(np.int64)),
                    pa.array(start - found.first[row]),
                    pa.array(length[row]),
                    lists,
                    pa.array(np.full(len(start), opening)),
                ],
                ["id", "text_hash", "hash", "place", "length", "slots", "opening"],
            )

    return texts.select("id", "text_hash", "text").mapInArrow(run, _WINDOW)


def matches(texts: DataFrame, items: DataFrame) -> DataFrame:
    """`id`, `text_hash`, `item_id`, `covered`, `length`, `exact`: the copies of items in texts.

    `covered` tokens of the item's `length` lie on neighbouring diagonals; `exact` copies have the
    item's own values.
    """
    wanted = stored(_window_rows(items, None, None), "items")
    # Items with the same windows and slots need not be told apart before the end.
    classes = wanted.groupBy("id", "opening").agg(
        F.xxhash64(F.array_sort(F.collect_list(F.struct("place", "hash", "slots")))).alias("class"),
    )
    wanted = wanted.join(classes, ["id", "opening"]).select("class", "opening", "hash", "place", "length", "slots").distinct()
    wanted = stored(wanted, "items")
    sizes = sorted(row[0] for row in wanted.select(F.size("slots")).distinct().collect())
    found = _window_rows(texts, sizes, bloom(wanted.select("hash").distinct())) if sizes else _window_rows(texts.limit(0), [WINDOW], None)
    found = found.drop("opening")
    wanted = wanted.select("class", "opening", "hash", F.col("place").alias("item_place"), F.col("length").alias("item_length"), F.col("slots").alias("values"))
    joined = found.join(wanted, "hash").withColumn("diagonal", F.col("place") - F.col("item_place"))
    # The first word of a sentence is seldom a name, so it can't be exchanged.
    joined = joined.filter(~F.col("opening") | (F.col("item_place") > 0) | (F.col("values")[0] == F.col("slots")[0]))
    paired = F.filter(F.arrays_zip("values", "slots"), lambda pair: pair["values"] != 0)
    one = F.transform(paired, lambda pair: F.struct(pair["values"].alias("value"), pair["slots"].alias("slot")))
    spans = F.sequence("item_place", F.col("item_place") + F.size("slots") - 1)
    parts = joined.groupBy("id", "text_hash", "class", "item_length", "diagonal").agg(
        F.array_distinct(F.flatten(F.collect_list(spans))).alias("spans"),
        F.array_distinct(F.flatten(F.collect_list(one))).alias("bound"),
    )
    # Bands of each width, so that a stray match beside a copy doesn't hide it.
    bands = parts.withColumn("width", F.explode(F.sequence(F.lit(0), F.lit(DRIFT))))
    bands = bands.withColumn("band", F.explode(F.sequence(F.col("diagonal") - F.col("width"), F.col("diagonal"))))
    copies = bands.groupBy("id", "text_hash", "class", "item_length", "width", "band").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("covered"),
        F.array_distinct(F.flatten(F.collect_list("bound"))).alias("bound"),
    )
    values = F.array_distinct(F.transform("bound", lambda pair: pair["value"]))
    copies = copies.filter(F.size("bound") == F.size(values))
    copies = copies.withColumn("exact", F.forall("bound", lambda pair: pair["value"] == pair["slot"]))
    enough = F.least(F.lit(COVERED), F.ceil(F.col("item_length") * SHARE))
    copies = copies.filter(F.col("covered") >= enough)
    best = copies.groupBy("id", "text_hash", "class").agg(
        F.max("covered").alias("covered"), F.max("item_length").alias("length"), F.max("exact").alias("exact")
    )
    named = classes.select("class", F.col("id").alias("item_id")).distinct()
    return best.join(named, "class").drop("class")


def keyed(df: DataFrame, id: str, text: str) -> DataFrame:
    """id, hash of the text, and text; the hash tells rows of the same id apart."""
    return df.select(F.col(id).cast("long").alias("id"), text_hash(text).alias("text_hash"), F.col(text).alias("text"))


def decontaminate(
    df: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """One row per row of `df`: id, `contaminated`, `items` (ids, ascending), `covered`, `exact`, `text_hash`.

    A document is contaminated if it covers 13 template tokens of an item on neighbouring diagonals,
    or four fifths of an item shorter than that, with consistent slots. Where
    placeholders prevail, their values have to be the same. Items of fewer than four tokens, or null, match nothing, nor do null or empty texts. Ids may be null
    or repeated; items with a null id are left out. Other columns are not read.
    """
    texts = keyed(df, id, text)
    items = keyed(benchmark, item_id, item_text).filter(F.col("id").isNotNull())
    found = matches(texts, items).groupBy("id", "text_hash").agg(
        F.array_sort(F.collect_set("item_id")).alias("items"), F.max("covered").alias("covered"), F.max("exact").alias("exact")
    )
    rows = texts.select("id", "text_hash")
    same = rows["id"].eqNullSafe(found["id"]) & (rows["text_hash"] == found["text_hash"])
    rows = rows.join(found, same, "left").select(
        rows["id"].cast(df.schema[id].dataType).alias(id),
        found["items"].isNotNull().alias("contaminated"),
        F.coalesce(found["items"], F.array().cast("array<long>")).alias("items"),
        F.coalesce(found["covered"], F.lit(0)).alias("covered"),
        F.coalesce(found["exact"], F.lit(False)).alias("exact"),
        rows["text_hash"],
    )
    return rows
