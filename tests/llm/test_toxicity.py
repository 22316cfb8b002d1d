import random

import numpy as np

from changelake.llm import toxicity
from changelake.llm.toxicity import Machine, fit, learn, score


def test_pairs_equal_the_sum_over_all_products():
    draw = np.random.default_rng(1)
    weights, vectors = draw.normal(size=6), draw.normal(size=(6, 3))
    rows = [[0, 2, 5], [], [1], [0, 1, 2, 3, 4, 5]]
    row = np.repeat(np.arange(4), [len(each) for each in rows])
    input_ = np.array([value for each in rows for value in each])
    found = Machine(np.zeros(0), 0.3, weights, vectors).scores(row, input_, 4)
    for number, each in enumerate(rows):
        pairs = sum(vectors[a] @ vectors[b] for n, a in enumerate(each) for b in each[:n])
        assert np.isclose(found[number], 1 / (1 + np.exp(-(0.3 + weights[each].sum() + pairs))))


def test_an_interaction_that_weights_alone_miss_is_learned():
    draw = np.random.default_rng(2)
    present = draw.random((4000, 6)) < 0.4
    labels = (present[:, 0] ^ present[:, 1]).astype(float)
    row, input_ = np.nonzero(present)
    machine = fit(np.zeros(0), row, input_, labels, 6)
    assert ((machine.scores(row, input_, 4000) >= 0.5) == labels).mean() > 0.97


def corpus(spark, draw):
    insults, neutral = ["grobian", "lump", "fool"], [f"w{n}" for n in map(chr, range(97, 123))]
    rows, labels = [], []
    for number in range(900):
        words = [draw.choice(neutral) for _ in range(draw.randrange(5, 60))]
        toxic = number % 6 == 0
        if toxic:
            words.insert(draw.randrange(len(words)), draw.choice(insults).upper() + "!!")
        rows.append((number, " ".join(words), 0.5))
        labels.append((number, int(toxic), "extra"))
    return (
        spark.createDataFrame(rows, "doc_id long, text string, score double"),
        spark.createDataFrame(labels + [(None, 1, "x"), (5000, 1, "x"), (3, None, "x")], "doc_id long, toxic int, text string"),
    )


def test_held_out_texts(spark):
    df, labels = corpus(spark, random.Random(3))
    machine = learn(df, labels.filter("doc_id % 5 <> 0 or doc_id is null"), "doc_id", "text", "toxic")
    found = {row.doc_id: row.score for row in score(df, machine).collect()}
    held = [n for n in range(900) if n % 5 == 0]
    assert all((found[n] >= 0.5) == (n % 6 == 0) for n in held)


def test_edge_texts_and_labels(spark):
    df, labels = corpus(spark, random.Random(4))
    machine = learn(df, labels, "doc_id", "text", "toxic")
    rows = [(1, None), (2, ""), (3, "\n \t"), (None, "fool"), (None, "fool"), (4, "a fool… " + "wa " * 200_000), (5, "“FOOL”")]
    found = score(spark.createDataFrame([(*row, 1) for row in rows], "doc_id long, text string, id int"), machine).collect()
    by_id = {row.doc_id: row.score for row in found}
    assert len(found) == 7 and by_id[1] == by_id[2] == by_id[3] < 0.5
    assert by_id[None] > 0.5 and by_id[4] > 0.5 and by_id[5] > 0.5
    assert score(df.limit(0), machine).collect() == []
    for none in (labels.limit(0), labels.filter("toxic = 0")):
        scores = {row.score for row in score(df, learn(df, none, "doc_id", "text", "toxic")).collect()}
        assert len(scores) == 1


def test_the_sample_is_bounded(spark, monkeypatch):
    df, labels = corpus(spark, random.Random(5))
    seen = []
    monkeypatch.setattr(toxicity, "fit", lambda inputs, row, input_, labels, number: seen.append(len(labels)))
    learn(df, labels, "doc_id", "text", "toxic", sample=100)
    assert seen == [100]
