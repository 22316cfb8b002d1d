import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from changelake.llm import recurrent
from changelake.llm.queries import op11_recurrent_lm
from changelake.llm.recurrent import END, Adam, Lanes, Network, Vocabulary, learn_texts, score_texts
from changelake.llm.words import LOWER, words

NOUNS = [f"w{n}" for n in range(60)]


def tokens_of(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [word for word in re.split(r"[\x20\x09-\x0D]+", folded) if word] + [None]


def hash_of(token):
    if token is None:
        return END
    data = np.frombuffer(token.encode(), np.uint8)
    return int(words(data, np.array([0, len(data)]), LOWER).hash.view(np.int64)[0])


def vocabulary(sizes, once=3, total=None):
    counts = np.array(sizes)
    return Vocabulary(int(counts.sum()) + 5 if total is None else total, len(sizes) + 4, once, np.arange(-1, len(sizes) - 1), counts)


def sigmoid(x):
    return 1 / (1 + math.exp(-x))


def slow_score(network, text):
    """ln P of one text's symbols by the cell's formulas, token by token, with whole softmaxes."""
    p, n, state, out, last = network.parts, network.units, np.zeros(network.units), 0.0, 0
    for target in text.tolist():
        row, passed = p["table"][:, last].astype(float), p["gates"].astype(float) @ state
        new = np.zeros(n)
        for i in range(n):
            update, reset = sigmoid(row[i] + passed[i]), sigmoid(row[n + i] + passed[n + i])
            candidate = math.tanh(row[2 * n + i] + reset * passed[2 * n + i])
            new[i] = (1 - update) * candidate + update * state[i]
        state, last = new, target
        scores = np.exp(p["class_out"].astype(float) @ state + p["class_bias"][:, 0])
        number = network.class_of[target]
        out += math.log(scores[number] / scores.sum())
        if target < network.own:
            inner = np.exp(p["word_out"][number].astype(float) @ state + p["word_bias"][number][:, 0])
            out += math.log(inner[target % recurrent.CLASS] / inner.sum())
    return out


def drawn(known, seed=3, units=5, kind=np.float32):
    network, draw = Network(known, units, kind), np.random.default_rng(seed)
    for name, part in network.parts.items():
        network.parts[name] = (part + draw.normal(0, 0.4, part.shape)).astype(kind)
    return network


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(recurrent, "WORDS", 10)
    monkeypatch.setattr(recurrent, "CLASS", 4)


def test_scores_carry_the_state_over_windows_of_whole_texts(small, monkeypatch):
    monkeypatch.setattr(recurrent, "LANES", 4)
    known = vocabulary([9] * 5 + [4] * 60)
    network, draw = drawn(known), np.random.default_rng(1)
    texts = [draw.integers(0, known.symbols, n).astype("<u2") for n in (1, 90, 3, 16, 17, 33, 200, 1, 2)]
    assert score_texts(network, texts) == pytest.approx([slow_score(network, text) for text in texts], rel=1e-4)


def test_probabilities_add_up_to_one(small):
    """Over own words, words of each band, words outside the head and the unknown one."""
    known = vocabulary([9] * 5 + [4] * 60)
    network = drawn(known)
    state = np.random.default_rng(2).normal(0, 1, (5, 1)).astype(np.float32)
    by_symbol = np.exp([network.log_probabilities(state, np.array([symbol]))[0] for symbol in range(known.symbols)])
    rest = by_symbol[-1] * (known.unknown + (1 - known.unknown) * sum([2, 1, 1, 1]) / known.rest)
    head = sum(by_symbol[symbol] * math.exp(share) for symbol, share in zip(known.symbol, known.share))
    assert head + rest == pytest.approx(1, abs=1e-5) and len(known.edges) == 2


def test_an_unlearned_model_gives_frequencies():
    known = vocabulary([900, 500, 200, 50, 3], total=1653)
    found = Network(known).log_probabilities(np.zeros((recurrent.UNITS, 5), np.float32), np.arange(5))
    assert np.exp(found) == pytest.approx(known.counts / known.total, abs=2e-3)


def test_gradients_equal_differences(small):
    known = vocabulary([9] * 5 + [4] * 60)
    network, draw = drawn(known, kind=np.float64), np.random.default_rng(4)
    inputs, targets = draw.integers(0, known.symbols, (2, 6, 3))
    keep, valid = (draw.random((6, 3)) > 0.2).astype(float), draw.random((6, 3)) > 0.2
    state = draw.normal(0, 1, (5, 3))

    def loss():
        out, _ = network.states(inputs, keep, state)
        return -0.5 * network.log_probabilities(out.reshape(5, -1)[:, valid.ravel()], targets.ravel()[valid.ravel()]).sum()

    grads, last = network.gradients(inputs, keep, state, targets, valid, 0.5)
    assert (last == network.states(inputs, keep, state)[0][:, -1]).all()
    for name, part in network.parts.items():
        flat = part.reshape(-1)
        for place in draw.choice(flat.size, min(flat.size, 60), replace=False).tolist():
            if flat[place] < -1e6:
                continue
            held = flat[place]
            flat[place] = held + 1e-5
            above = loss()
            flat[place] = held - 1e-5
            below = loss()
            flat[place] = held
            assert grads[name].reshape(-1)[place] == pytest.approx((above - below) / 2e-5, abs=1e-6), name


def test_lanes_hold_each_text_once_and_are_about_equal():
    draw = np.random.default_rng(5)
    texts = [draw.integers(1, 9, n).astype("<u2") for n in draw.integers(1, 60, 300)] + [np.ones(500, "<u2")]
    lanes = Lanes.of(texts, 16)
    assert lanes.sizes.max() - lanes.sizes.min() < 60 and (np.diff(lanes.sizes) <= 0).all()
    for number, text in enumerate(texts):
        assert (lanes.symbols[lanes.text == number] == text).all()
    seen = np.zeros(len(lanes.symbols), int)
    for inputs, keep, targets, valid, places in lanes.windows():
        np.add.at(seen, places[valid], 1)
        assert (inputs[keep == 0] == 0).all() and (targets[valid] == lanes.symbols[places[valid]]).all()
        goes_on = valid & (keep > 0)
        assert (inputs[goes_on] == lanes.symbols[places[goes_on] - 1]).all()
    assert (seen == 1).all()


def test_learns_what_depends_on_the_state():
    """After the first word, which tells two kinds of texts apart, words of the own kind follow."""
    known = vocabulary([400] + [200] * 20)
    draw = np.random.default_rng(6)
    texts = []
    for _ in range(600):
        kind = draw.integers(2)
        texts.append(np.concatenate([[1 + kind], draw.choice(np.arange(3 + kind, 21, 2), 12), [0]]).astype("<u2"))
    network = Network(known)
    before = score_texts(network, texts[500:]).sum()
    adam = Adam(network, 0.01)
    for _ in range(12):
        learn_texts(network, texts[:500], adam)
    assert score_texts(network, texts[500:]).sum() - before > 0.4 * 100 * 12


def corpus(rows=400):
    draw = np.random.default_rng(7)
    texts = [" ".join([["EN", "de"][n % 2], *draw.choice(NOUNS[n % 2 :: 2], int(draw.integers(0, 40))), f"only{n}"]) for n in range(rows)]
    return [(n, text) for n, text in enumerate(texts)] + [(None, None), (None, ""), (5, " \n"), (5, "x\x0by\xa0z"), (7, "W1 " * 3000)]


@pytest.mark.parametrize("head", [recurrent.HEAD, 20])
def test_query_against_a_plain_count(spark, tmp_path, monkeypatch, head):
    """All columns but the score are exact; the score is the slow one's, on the model that was learned."""
    monkeypatch.setattr(recurrent, "HEAD", head)
    monkeypatch.setattr(recurrent, "WORDS", 16)
    rows, models = corpus(), []
    learn = recurrent.learn
    monkeypatch.setattr(recurrent, "learn", lambda encoded, known: models.append((known, learn(encoded, known))) or models[0][1])
    df = spark.createDataFrame([(*row, 1, 2, "x") for row in rows], "doc_id long, text string, row int, id int, learned string")
    df.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    found = op11_recurrent_lm(spark, str(tmp_path)).collect()
    (known, network), = models
    held_out = [id is not None and zlib.crc32(str(id).encode()) % 10 == 0 for id, _ in rows]
    counts = Counter(token for (_, text), held in zip(rows, held_out) if not held for token in tokens_of(text))
    total = counts.total()
    rank = {int(token): n for n, token in enumerate(known.tokens)}
    rest = sum(c for token, c in counts.items() if hash_of(token) not in rank)
    assert len(known.tokens) <= head and all(counts[token] == 1 or head == 20 for token in counts if hash_of(token) not in rank)
    want = []
    for (id, text), held in zip(rows, held_out):
        tokens = tokens_of(text)
        base = sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (len(counts) + 1))) for t in tokens)
        ranks = [rank.get(hash_of(t)) for t in tokens]
        ln = slow_score(network, np.array([known.symbols - 1 if r is None else known.symbol[r] for r in ranks]))
        for token, r in zip(tokens, ranks):
            if r is not None:
                band = [n for n, symbol in enumerate(known.symbol) if symbol == known.symbol[r]]
                ln += 0 if r < known.own else math.log(counts[token] / known.counts[band].sum())
            else:
                ln += math.log((1 - known.unknown) * counts[token] / rest) if counts[token] else math.log(known.unknown)
        want.append((id, held, len(tokens), sum(t in counts for t in tokens), total, base, ln / math.log(10)))
    key = lambda row: (str(row[0]), row[2], round(row[5], 6))
    for got, expected in zip(sorted(map(tuple, found), key=key), sorted(want, key=key), strict=True):
        assert got[:5] == expected[:5] and got[5] == pytest.approx(expected[5]) and got[6] == pytest.approx(expected[6], rel=1e-3)
    kept = [row for row in found if row.held_out]
    assert sum(row.score for row in kept) > sum(row.base_score for row in kept)


def test_no_row_to_learn_from_and_no_row(spark):
    df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    found = {row.doc_id: row for row in recurrent.log_likelihoods(df, F.lit(None).cast("boolean")).collect()}
    assert [(row.n_tokens, row.n_known, row.train_tokens, row.base_score) for row in (found[1], found[2])] == [(3, 0, 0, 0.0), (1, 0, 0, 0.0)]
    assert all(math.isfinite(row.score) and row.score < 0 for row in found.values())
    assert recurrent.log_likelihoods(df.limit(0), F.lit(True)).collect() == []


def test_averages_are_weighted_by_tokens(spark, monkeypatch):
    """One part's parameters are those it learned; of two parts with other tokens they lie between."""
    monkeypatch.setattr(recurrent, "ROUNDS", ((64, 0.01),))
    df = spark.createDataFrame(corpus(60), "id long, text string").withColumn("learned", F.lit(True))
    known, _ = recurrent.vocabulary(recurrent.stored(recurrent.token_counts(df), "counts"))
    encoded = recurrent.encode(df, known).select("row", "learned", "symbols").cache()
    parts = [[np.frombuffer(row.symbols, "<u2") for row in rows] for rows in encoded.rdd.glom().collect() if rows]
    assert len(parts) > 1
    total, tokens = 0, 0
    for texts in parts:
        network = Network(known)
        number = learn_texts(network, texts, Adam(network, 0.01))
        total, tokens = total + network.flat.astype(float) * number, tokens + number
    assert recurrent.learn(encoded, known).flat == pytest.approx(total / tokens, rel=1e-3, abs=1e-4)
