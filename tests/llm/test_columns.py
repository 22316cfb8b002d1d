import random
import re

import numpy as np
import pyarrow as pa
import pytest

from changelake.llm import columns
from changelake.llm.bloom import bloom, maybe
from changelake.llm.columns import bytes_of, chosen, chunks
from changelake.llm.words import LOWER, NO_LETTER, ngrams, words

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def test_words_are_those_of_the_pattern_and_equal_words_share_a_hash():
    draw = random.Random(1)
    texts = ["", " ", "a", "one  two\n", "\x0bé\x0c日本\xa0x\r", None, *("".join(draw.choice("ab \t\nAé") for _ in range(draw.randrange(40))) for _ in range(300))]
    data, offsets = bytes_of(pa.array(texts, pa.string()))
    found = words(data, offsets)
    raw = [(row, word) for row, text in enumerate(texts) for word in WORD.findall((text or "").encode())]
    assert [(int(r), data[s:e].tobytes()) for r, s, e in zip(found.row, found.start, found.end)] == raw
    assert found.first.tolist() == [sum(r < row for r, _ in raw) for row in range(len(texts) + 1)]
    by_word = {}
    for (_, word), value in zip(raw, found.hash.tolist()):
        assert by_word.setdefault(word, value) == value
    assert len(set(by_word.values())) == len(by_word)
    folded = words(data, offsets, LOWER)
    assert len(set(folded.hash.tolist())) == len({word.lower() for _, word in raw})


def test_letters_only():
    data = np.frombuffer("it's 5 café's".encode(), np.uint8)
    found = words(data, np.array([0, len(data)]), separators=NO_LETTER)
    assert [data[s:e].tobytes().decode() for s, e in zip(found.start, found.end)] == ["it", "s", "café", "s"]


def test_ngrams_tell_order_apart():
    a, b, c = np.array([1, 2, 3], np.uint64)
    grams = [int(ngrams(np.array(each, np.uint64), 3)[0]) for each in ((a, b, c), (c, b, a), (a, a, b), (a, b, b))]
    assert len(set(grams)) == 4 and len(ngrams(np.array([a, b], np.uint64), 3)) == 0


def test_chunks_hold_whole_rows():
    texts = ["ab", None, "c" * 50, "", "de", "f" * 9]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts, pa.string())], ["id", "text"]).slice(1)
    parts = list(chunks([batch], "text", 10))
    assert [part.column("id").to_pylist() for part, _, _ in parts] == [[1], [2], [3, 4], [5]]
    for part, data, offsets in parts:
        assert [data[a:b].tobytes().decode() for a, b in zip(offsets, offsets[1:])] == [text or "" for text in part.column("text").to_pylist()]


def test_filters_keep_all_their_values(spark):
    draw = random.Random(2)
    values = [draw.getrandbits(64) - 2**63 for _ in range(3000)]
    words_ = bloom(spark.createDataFrame([(value,) for value in values], "h long"))
    assert maybe(words_, np.array(values, np.int64).view(np.uint64)).all()
    others = np.random.default_rng(3).integers(0, 2**64, 20_000, dtype=np.uint64)
    assert maybe(words_, others).mean() < 0.05
    assert not maybe(bloom(spark.createDataFrame([], "h long")), others).any()


@pytest.mark.parametrize("named", [0, 10_000])
def test_chosen_rows_by_either_join(spark, monkeypatch, named):
    monkeypatch.setattr(columns, "NAMED", named)
    rows = [(1, "a", 7), (1, "a", 8), (1, "b", 9), (None, "a", 1), (None, None, 2), (2, "c", 3), (3, "d", 4), (3, "d", 5)]
    df = spark.createDataFrame(rows, "doc_id long, text string, id int")
    keep = [True, False, True, False, True, False, True, True]
    decided = df.withColumn("text_hash", columns.text_hash()).collect()
    marks = spark.createDataFrame([(r.doc_id, r.text_hash, k) for r, k in zip(decided, keep)], "id long, text_hash long, kept boolean")
    found = chosen(df, marks)
    assert found.columns == df.columns
    assert sorted((row[:2] for row in map(tuple, found.collect())), key=str) == sorted([(1, "a"), (1, "b"), (None, None), (3, "d"), (3, "d")], key=str)
