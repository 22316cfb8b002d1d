import random

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from changelake.llm import token_counts
from changelake.llm.token_counts import count_tokens, load

PATH = public_tokenizers.path("word_bpe_49k.json")
PARTS = ["a", "in", "THE", " ", "\n\t", "\x85", "\x1c", "\x1f", "'s", "'RE", "é", "é", "Σ", "İ", "1", "...", "日", "😀", "<|endoftext|>", "<|", "​"]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    return lambda text: len(tokenizer.encode(text, add_special_tokens=False).ids)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=40).map("".join), st.integers(1, 9))
def test_counts_are_the_librarys_wherever_chunks_are_cut(library, text, size):
    counter = load(PATH)
    assert counter.count(text) == counter.count(text, size) == library(text)


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(max_codepoint=0x2FFF, exclude_categories=["Cs", "Cn"]), max_size=60))
def test_counts_are_the_librarys_for_any_assigned_characters(library, text):
    assert load(PATH).count(text, 11) == library(text)


def test_chunk_maps_compose_associatively():
    counter = load(PATH)
    maps = [counter.chunk(text) for text in ("", "ab", "c d", " ", "e  f", "gh ", "'s")]
    for one in maps:
        for two in maps:
            for three in maps:
                left = counter.joined(counter.joined(one, two), three)
                assert left == counter.joined(one, counter.joined(two, three))


def test_small_memos_and_machines_are_built_anew(library, monkeypatch):
    monkeypatch.setattr(token_counts, "MEMO", 2)
    monkeypatch.setattr(token_counts, "STATES", 5)
    counter = token_counts.TokenCounter(__import__("json").load(open(PATH, encoding="utf-8")))
    text = "transducers annotate transitions with emitted token counts and states"
    assert counter.count(text) == library(text)


def test_rows(spark, library):
    draw = random.Random(1)
    long = "".join(draw.choice("etaoin") for _ in range(120_000))
    texts = [None, "", " ", "Some words.", "Some words.", long, "word " * 3000]
    df = spark.createDataFrame([(n, text, 1) for n, text in enumerate(texts)], "doc_id long, text string, n_tokens int")
    found = {row.doc_id: row for row in count_tokens(df, PATH, limit=2048).collect()}
    for number, text in enumerate(texts):
        row = found[number]
        assert (row.n_bytes, row.n_tokens) == (len((text or "").encode()), library(text or ""))
        assert row.over_limit == (row.n_tokens > 2048)
    assert count_tokens(df.limit(0), PATH).columns == ["doc_id", "n_bytes", "n_tokens"]
