import random
import re

import numpy as np
import pytest

from changelake.llm import substring_dedup
from changelake.llm.substring_dedup import remove_repeats, subtree_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(rows, size=13):
    split = [(id, WORD.findall(text or "")) for id, text in rows]
    least = {}
    for id, words in split:
        for start in range(len(words) - size + 1):
            key = tuple(words[start : start + size])
            if id is not None:
                least[key] = min(id, least.get(key, id))
    out = []
    for id, words in split:
        gone = set()
        for start in range(len(words) - size + 1):
            if id is not None and least[tuple(words[start : start + size])] < id:
                gone.update(range(start, start + size))
        out.append((id, len(words), len(gone), " ".join(word for n, word in enumerate(words) if n not in gone).encode()))
    return sorted(out, key=str)


def corpus(draw):
    vocabulary = [f"w{n}" for n in range(60)] + ["é", "ñandú", "日本"]
    passages = [[draw.choice(vocabulary) for _ in range(draw.choice([12, 13, 14, 30, 70]))] for _ in range(12)]
    line = "this line of ten words is on every single page".split()
    texts = []
    for _ in range(120):
        words = []
        for _ in range(draw.randrange(4)):
            words += [draw.choice(vocabulary) for _ in range(draw.randrange(25))] + draw.choice([*passages, line])
        texts.append("".join(word + draw.choice([" ", "  ", "\n", " \t"]) for word in words))
    texts += ["a " * 40, "a " * 30, " ".join(passages[3]) + "\xa0", None, "", " ", *texts[:20], *["hot " + " ".join(passages[4] * 3)] * 30]
    return texts


@pytest.mark.parametrize("common", [0, 3, 20, 1000])
def test_removals_equal_brute_force_with_short_and_long_prefixes(spark, monkeypatch, common):
    monkeypatch.setattr(substring_dedup, "GROUP", 50)
    draw = random.Random(common)
    texts = corpus(draw)
    ids = draw.sample(range(1000), len(texts))
    rows = list(zip(ids, texts))
    df = spark.createDataFrame([(*row, 1, "x") for row in rows], "doc_id long, text string, window int, prefix string")
    found = remove_repeats(df.repartition(4), common=common).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, bytes(r.kept)) for r in found), key=str) == brute_force(rows)


def test_null_and_repeated_ids_and_empty_tables(spark):
    text = " ".join(f"w{n}" for n in range(20))
    rows = [(None, text), (4, text), (4, text), (4, "x " + text), (9, text + " tail"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(((r.doc_id, r.n_words, r.n_removed, bytes(r.kept)) for r in remove_repeats(df).collect()), key=str) == brute_force(rows)
    assert remove_repeats(df.limit(0)).collect() == []


def test_very_long_texts(spark):
    words = [f"w{n}" for n in range(250_000)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[1000:240_000], "x"])), (3, "y" * 3_000_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: (r.n_words, r.n_removed) for r in remove_repeats(df).collect()}
    assert found == {1: (250_000, 0), 2: (239_001, 239_000), 3: (1, 0)}


def test_deep_nodes_hold_equal_suffixes_of_one_group():
    suffixes = np.array([[1, 2], [1, 2], [1, 3], [1, 2]], np.uint64)
    groups = [np.array([0, 0, 0, 1])]
    assert subtree_repeats(suffixes, groups, np.array([5, 4, 1, 2])).tolist() == [4, 4, 1, 2]
