import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from changelake.llm import language_id
from changelake.llm.language_id import ORDER, accepted, identify, kneser_ney, learn, sequences

SYLLABLES = {"aa": "ka lo mi ne tu", "bb": "sch ung ein ver ach", "cc": "é où que ès ça"}


def text_of(draw, language, words):
    parts = SYLLABLES[language].split()
    return " ".join("".join(draw.choice(parts) for _ in range(draw.randrange(1, 4))) for _ in range(words))


@pytest.fixture(scope="module")
def labelled(spark):
    draw = random.Random(5)
    rows = [(n, text_of(draw, name, draw.randrange(5, 60)), name, 1) for n in range(600) for name in [list(SYLLABLES)[n % 3]]]
    rows += [(1000, None, "aa", 1), (None, "ka", "aa", 1), (1001, "ka lo", None, 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")


@pytest.fixture(scope="module")
def model(labelled):
    return learn(labelled, "doc_id", "text", "lang")


def plain_kneser_ney(texts, order, alphabet):
    """Textbook recursion over dictionaries."""
    counts = [None] * (order + 1)
    counts[order] = Counter()
    for text in texts:
        padded = [0] * order + text + [0]
        for end in range(order, len(padded)):
            counts[order][tuple(padded[end - order + 1 : end + 1])] += 1
    for size in range(order - 1, 0, -1):
        counts[size] = Counter(gram[1:] for gram in counts[size + 1])
    discounts, totals, kinds = {}, defaultdict(Counter), defaultdict(Counter)
    for size in range(1, order + 1):
        once, twice = (sum(c == k for c in counts[size].values()) for k in (1, 2))
        discounts[size] = once / (once + 2 * twice) if once and twice else 0.5
        for gram, count in counts[size].items():
            totals[size][gram[:-1]] += count
            kinds[size][gram[:-1]] += 1

    def probability(gram):
        size = len(gram)
        lower = probability(gram[1:]) if size > 1 else 1 / (alphabet + 1)
        total = totals[size][gram[:-1]]
        if not total:
            return lower
        weight = discounts[size] * kinds[size][gram[:-1]] / total
        return max(counts[size][gram] - discounts[size], 0) / total + weight * lower

    return probability


def test_log_probabilities_equal_the_textbook_recursion():
    draw = random.Random(2)
    texts = {name: [text_of(draw, name, 12) for _ in range(15)] for name in ("aa", "bb")}
    counted = {}
    for name, own in texts.items():
        codes, places, _ = sequences(own)
        grams, counts = np.unique(codes[places[:, None] + np.arange(1 - ORDER, 1)], axis=0, return_counts=True)
        counted[name] = grams, counts.astype(float)
    model = kneser_ney(counted)
    alphabet = len({letter for own in texts.values() for text in own for letter in text})
    for test in ("kalomi tune", "schein xyz", "ö", ""):
        codes, places, _ = sequences([test])
        logs = model._logs(codes, places)
        for column, name in enumerate(model.languages):
            own = [[0 if c == " " else ord(c) for c in text] for text in texts[name]]
            probability = plain_kneser_ney(own, ORDER, alphabet)
            for place, log in zip(places, logs[:, column]):
                gram = tuple(codes[place - ORDER + 1 : place + 1].tolist())
                assert math.isclose(math.log(probability(gram)), log, rel_tol=1e-4)


def test_probabilities_of_a_context_sum_to_one():
    codes, places, _ = sequences(["kalo mine tu kalo lomi"])
    grams, counts = np.unique(codes[places[:, None] + np.arange(1 - ORDER, 1)], axis=0, return_counts=True)
    model = kneser_ney({"aa": (grams, counts.astype(float))})
    letters = sorted({0, *map(ord, "kalominetu")})
    for context in ([0] * 4, list(map(ord, "kalo")), list(map(ord, "xalo"))):
        codes = np.array([context + [letter] for letter in letters], np.uint32).ravel()
        logs = model._logs(codes, np.arange(4, len(codes), 5))
        unseen = 1 - np.exp(logs[:, 0].astype(float)).sum()
        assert 0 < unseen < 0.2  # what is left is for a letter not seen


def test_languages_are_told_apart(spark, model):
    draw = random.Random(9)
    rows = [(n, text_of(draw, name, 20).upper()) for n in range(90) for name in [list(SYLLABLES)[n % 3]]]
    found = {row.doc_id: row for row in identify(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert all(found[n].lang_pred == list(SYLLABLES)[n % 3] and 0.5 < found[n].score <= 1 and not found[n].rejected for n in range(90))


def test_edge_texts(spark, model):
    draw = random.Random(4)
    rows = [(1, None), (2, ""), (3, "12 %% \n"), (4, "k"), (None, "ka lo"), (None, "ka lo"), (5, text_of(draw, "bb", 40_000)), (6, "wxyz qpvf " * 9)]
    df = spark.createDataFrame([(*row, "z") for row in rows], "doc_id long, text string, lang_pred string").repartition(2)
    found = identify(df, model).collect()
    by_id = {row.doc_id: row for row in found}
    assert len(found) == len(rows)
    assert [(by_id[n].lang_pred, by_id[n].score, by_id[n].rejected) for n in (1, 2, 3)] == [("und", 0.0, True)] * 3
    assert not by_id[4].rejected and by_id[5].lang_pred == "bb" and by_id[6].rejected
    assert {row.lang_pred for row in found if row.doc_id is None} == {"aa"}
    kept = accepted(df, model)
    assert kept.columns == df.columns
    assert Counter(row.doc_id for row in kept.collect()) == Counter([4, None, None, 5])


def test_nothing_learned(spark, labelled):
    model = learn(labelled.limit(0), "doc_id", "text", "lang")
    rows = spark.createDataFrame([(1, "ka"), (2, None)], "doc_id long, text string")
    found = sorted(identify(rows, model).collect(), key=lambda row: row.doc_id)
    assert [(row.lang_pred, row.score, row.rejected) for row in found] == [("und", 0.0, False), ("und", 0.0, True)]
    assert identify(rows.limit(0), model).collect() == []


def test_too_many_languages_are_refused(labelled, monkeypatch):
    monkeypatch.setattr(language_id, "MOST_LANGUAGES", 2)
    with pytest.raises(ValueError, match="languages"):
        learn(labelled, "doc_id", "text", "lang")
