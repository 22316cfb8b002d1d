import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from changelake.llm import periods
from changelake.llm.periods import PRIMES, Run, find, restore, transform, zero_distances
from changelake.llm.queries import op12_periodic_runs


def words_of(text):
    return [word for word in re.split(r"[\x20\x09-\x0D]+", text or "") if word]


def brute(words):
    """Runs from the definition: for each period the maximal stretches, the smallest period of each."""
    found = {}
    for q in range(1, len(words) // 3 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(24, 3 * q):
                found.setdefault((start, i + q - start), q)
    return sorted((start, length, q) for (start, length), q in found.items())


def collapsed(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(word for i, word in enumerate(words) if i not in gone)


def made(draw):
    """Words with runs of many periods, some next to or within one another, some broken by one word."""
    out = []
    while len(out) < draw.choice([0, 5, 23, 24, 25, 80, 300, 900]):
        part = [draw.choice("abcde") for _ in range(draw.choice([1, 1, 2, 3, 5, 7, 8, 9, 15, 16, 17, 31, 40, 64]))]
        kind = draw.random()
        if kind < 0.6:
            out += (part * 30)[: draw.randrange(1, 6 * len(part) + 30)]
        elif kind < 0.8:
            out += [draw.choice("abcdefghijkl") for _ in range(draw.randrange(30))]
        else:
            whole = part * draw.randrange(1, 4) + [draw.choice("xyz")]
            out += (whole * 9)[: draw.randrange(1, 4 * len(whole) + 3)]
    return out


TEXTS = [made(random.Random(n)) for n in range(150)] + [["w"] * 5000, list("ab") * 700 + ["c"] + list("ab") * 700, [str(n) for n in range(3000)], [str(n % 1000) for n in range(3001)]]


def test_transform_gives_exact_products():
    draw = np.random.default_rng(1)
    for prime, root in PRIMES:
        rows = draw.integers(0, prime, (3, 64)).astype(np.uint64)
        assert (restore(transform(rows, prime, root), prime, root) == rows).all()
        other = draw.integers(0, prime, (3, 64)).astype(np.uint64)
        product = restore(transform(rows, prime, root) * transform(other, prime, root) % np.uint64(prime), prime, root)
        for a, b, c in zip(rows.tolist(), other.tolist(), product.tolist()):
            assert c == [sum(a[i] * b[(k - i) % 64] for i in range(64)) % prime for k in range(64)]


def test_zero_distances_are_those_without_a_mismatch():
    draw = np.random.default_rng(2)
    following = draw.integers(1, 3, (200, 16)).astype(np.uint64)
    blocks = np.array([row[d : d + 8] if n % 2 else draw.integers(1, 3, 8) for n, (row, d) in enumerate(zip(following, draw.integers(0, 9, 200)))], np.uint64)
    want = [[(row[d : d + 8] == block).all() for d in range(9)] for row, block in zip(following, blocks)]
    assert zero_distances(blocks, following, 3).tolist() == want


def test_sums_that_are_a_multiple_of_the_first_prime_are_not_zero():
    """Differences whose squares add up to the first prime: the second one tells."""
    prime = PRIMES[0][0]
    root = next(a for a in range(int(prime**0.5), 0, -1) if round((prime - a * a) ** 0.5) ** 2 == prime - a * a)
    parts = [root, round((prime - root * root) ** 0.5), 0, 0, 0, 0, 0, 0]
    blocks = np.array([[1 + part for part in parts]], np.uint64)
    following = np.ones((1, 16), np.uint64)
    assert sum(part * part for part in parts) == prime
    assert not zero_distances(blocks, following, int(blocks.max()) + 1).any()


@pytest.mark.parametrize("cells", [64, periods.CELLS])
def test_runs_equal_brute_force(monkeypatch, cells):
    monkeypatch.setattr(periods, "CELLS", cells)
    ids = np.unique([word for text in TEXTS for word in text], return_inverse=True)[1].astype(np.uint64) + np.uint64(1)
    first = np.concatenate([[0], np.cumsum([len(text) for text in TEXTS])])
    found = find(ids, first)
    for number, text in enumerate(TEXTS):
        assert [tuple(run) for run in found.get(number, [])] == brute(text), number
    assert sum(len(runs) for runs in found.values()) > 80 and find(ids[:0], np.array([0, 0])) == {}


def test_words_of_a_run_stay_once():
    assert periods.dropped([Run(1, 4, 1), Run(4, 5, 2)], 10).tolist() == [False, False, True, True, True, False, True, True, True, False]


def test_operator_equals_brute_force(spark):
    rows = [(n, draw) for n, draw in enumerate(" ".join(text) for text in TEXTS)]
    rows += [(None, None), (None, ""), (3, " \t\n"), (3, "a\x0bb\xa0c " * 30), (9, "é " * 24), (9, "é " * 23)]
    df = spark.createDataFrame([(*row, "x", 1, 2) for row in rows], "doc_id long, text string, runs string, n_words int, id long").repartition(4)
    result = periods.find_runs(df).collect()
    want = []
    for id, text in rows:
        words = words_of(text)
        runs = brute(words)
        want.append((id, len(words), runs, collapsed(words, runs)))
    assert sorted(((r.doc_id, r.n_words, [tuple(run) for run in r.runs], r.collapsed) for r in result), key=str) == sorted(want, key=str)
    assert periods.find_runs(df.limit(0)).columns == ["doc_id", "n_words", "runs", "collapsed"] and periods.find_runs(df.limit(0)).count() == 0


def test_query_equals_brute_force(spark, tmp_path):
    draw = random.Random(5)
    rows = [(n, " ".join(made(draw)) if n % 3 else " ".join(str(draw.randrange(50)) for _ in range(n))) for n in range(200)] + [(None, "a b"), (7, None), (20, "")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    want, planted = [], 0
    for id, text in rows:
        words = words_of(text)
        n, h = len(words), None if id is None else zlib.crc32(str(id).encode())
        if h is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
            planted += 1
        runs = brute(words)
        best = max(runs, key=lambda run: (Fraction(run[1], run[2]), -run[0], -run[2]), default=(None, None, None))
        milli = None if best[0] is None else 1000 * best[1] // best[2]
        lines = "".join(f"{start},{length},{q}\n" for start, length, q in runs)
        want.append((id, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(words, runs).encode()).hexdigest()))
    assert planted > 10
    assert sorted(map(tuple, op12_periodic_runs(spark, str(tmp_path)).collect()), key=str) == sorted(want, key=str)
