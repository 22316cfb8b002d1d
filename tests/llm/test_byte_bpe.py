import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from changelake.llm import byte_bpe

PATHS = [public_tokenizers.path(name) for name in ("byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken")]


@pytest.fixture(scope="module", params=PATHS)
def both(request):
    bpe = byte_bpe.load(request.param, public_tokenizers.PATTERN)
    ranks = {token: rank for rank, token in enumerate(bpe.tokens)}
    return bpe, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def same(both, text):
    ids = both[0].encode(text)
    assert ids == both[1].encode_ordinary(text)
    assert both[0].decode(ids) == text.encode()


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=80))
def test_ids_are_the_librarys_for_any_text(both, text):
    same(both, text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["a", "e", "in", "the", "THE", "  ", "\n", "'s", "é", "日本", "😀", "1", "22", "...", "<|endoftext|>"])).map("".join))
def test_ids_are_the_librarys_for_likely_merges(both, text):
    same(both, text)


def test_long_pieces_without_white_space(both):
    draw = random.Random(3)
    for letters in ("a", "ab", "aeinorst", "日本語é"):
        same(both, "".join(draw.choice(letters) for _ in range(30_000)))


def test_full_memo_starts_anew(both, monkeypatch):
    monkeypatch.setattr(byte_bpe, "MEMO", 3)
    same(both, "some words go in and out of a memo of three words, some words")


def test_rows_keep_their_order_nulls_and_repeats(spark):
    texts = ["a b", None, "", "a b", "x" * 100_000, *[f"word {n}" for n in range(150)]]
    df = spark.createDataFrame([(n if n != 3 else None, text, "x") for n, text in enumerate(texts)], "doc_id int, text string, ids string")
    found = {row.doc_id: row for row in byte_bpe.encode(df, PATHS[0], public_tokenizers.PATTERN).collect()}
    bpe = byte_bpe.load(PATHS[0], public_tokenizers.PATTERN)
    assert len(found) == len(texts)
    for number, text in enumerate(texts):
        row = found[number if number != 3 else None]
        assert np.frombuffer(row.ids, "<u4").tolist() == bpe.encode(text or "")
        assert row.decoded == (text or "").encode()
    assert byte_bpe.encode(df.limit(0), PATHS[0], public_tokenizers.PATTERN).collect() == []
