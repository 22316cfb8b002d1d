import random
import re

import numpy as np
import pytest

from changelake.llm import jaccard_join
from changelake.llm.components import components
from changelake.llm.jaccard_join import _filtered, _groups, block_links, jaccard_components


def shingles(text, size=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute_force(rows):
    sets = [shingles(text) for _, text in rows]
    label = list(range(len(rows)))
    for one in range(len(rows)):
        for two in range(one):
            a, b = sets[one], sets[two]
            if a and b and 100 * len(a & b) >= 85 * len(a | b) and label[one] != label[two]:
                old, new = label[one], label[two]
                label = [new if each == old else each for each in label]
    first = {}
    for (id, _), each in zip(rows, label):
        if id is not None:
            first[each] = min(id, first.get(each, id))
    return sorted(((id, len(sets[n]), first.get(label[n])) for n, (id, _) in enumerate(rows)), key=str)


def near_copies(draw, number, base, edits):
    out = []
    for _ in range(number):
        words = list(base)
        for _ in range(draw.randrange(edits)):
            words[draw.randrange(len(words))] = f"e{draw.randrange(10**6)}"
        out.append(" ".join(words))
    return out


def corpus(draw):
    line = "every page carries this very same line of twelve words at its end"
    texts = []
    for group in range(6):
        base = [f"w{draw.randrange(400)}" for _ in range(draw.choice([30, 80, 150]))]
        texts += near_copies(draw, 25, base, 5)
    texts += [" ".join(f"x{draw.randrange(300)}" for _ in range(draw.randrange(60))) + " " + line for _ in range(60)]
    texts += ["", None, " \n", "one", "One", "one two", "one two three", "one  two\tthree", "a b c d", "a b c d a b c d", "A B C D"]
    return texts + texts[:40]


@pytest.mark.parametrize("block", [1 << 18, 1500, 200])
def test_components_equal_brute_force_at_every_block_size(spark, block):
    draw = random.Random(block)
    rows = list(enumerate(corpus(draw)))
    df = spark.createDataFrame([(*row, "s", 3) for row in rows], "doc_id long, text string, set string, n int").repartition(5)
    found = sorted(map(tuple, jaccard_components(df, block=block).drop("kept", "text_hash").collect()), key=str)
    assert found == brute_force(rows)


def test_null_and_repeated_ids_and_empty_tables(spark):
    rows = [(None, "a b c d e"), (7, "a b c d e"), (7, "a b c d e"), (None, "q r s t u"), (3, None), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, jaccard_components(df).drop("kept", "text_hash").collect()), key=str) == brute_force(rows)
    assert jaccard_components(df.limit(0)).collect() == []


def test_very_long_texts(spark):
    words = [f"w{n}" for n in range(300_000)]
    rows = [(1, " ".join(words)), (2, " ".join(["x", *words])), (3, " ".join(words[:200_000])), (4, "y" * 3_000_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((r.doc_id, r.component_id) for r in jaccard_components(df).collect()) == [(1, 1), (2, 1), (3, 3), (4, 4)]


def test_links_between_two_blocks_cross_them():
    sets = [np.arange(20, dtype=np.uint64), np.arange(20, dtype=np.uint64) + np.uint64(1), np.arange(20, dtype=np.uint64)]
    assert block_links([1, 2, 1], sets, 85) == [(0, 1), (2, 1)]
    assert len(block_links([0, 0, 0], sets, 85)) == 2


def test_components_of_a_long_chain_and_a_star(spark):
    edges = [(n, n + 1) for n in range(200)] + [(1000, n) for n in range(1001, 1100)] + [(5000, 5000)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "u long, v long")).collect()))
    assert found == {n: 0 for n in range(201)} | {n: 1000 for n in range(1000, 1100)}


def test_sets_of_growing_size_are_not_one_group(spark):
    """A shingle that sets of all sizes share makes groups of sets that may link, and of few others."""
    sizes = [round(10 * 1.1**n) for n in range(40)]
    rows = [(5, n.to_bytes(16, "big"), size) for n, size in enumerate(sizes)] + [(6, b"x" * 16, 1000), (6, b"y" * 16, 20)]
    found = {}
    for key, size, group in _groups(spark.createDataFrame(rows, "token long, set binary, n long"), 85).collect():
        found.setdefault(bytes(group), set()).add((int.from_bytes(key, "big"), size))
    assert max(map(len, found.values())) <= 5 and all(max(s for _, s in each) < 1.5 * min(s for _, s in each) for each in found.values())
    for one in range(40):
        for two in range(one):
            if 100 * sizes[two] >= 85 * sizes[one]:
                assert any({(one, sizes[one]), (two, sizes[two])} <= each for each in found.values())


def test_only_wanted_sets_are_shuffled_again(spark):
    rows = [(np.uint64(n * 0x9E3779B97F4A7C15 % 2**64).tobytes() * 2, b"12345678") for n in range(2000)]
    full = spark.createDataFrame(rows, "set binary, shingles binary").repartition(3)
    kept = {bytes(row.set) for row in _filtered(full, spark.createDataFrame(rows[:50], full.schema)).collect()}
    assert {key for key, _ in rows[:50]} <= kept and len(kept) < 200
    assert _filtered(full.limit(0), full.limit(0)).collect() == []


def test_no_task_runs_links_and_components_at_once(spark, monkeypatch):
    """Edges are read, not made in the task that contracts them, which would hold two Python workers."""
    plans = []

    def seen(edges):
        plans.append(edges._jdf.queryExecution().toString())
        return components(edges)

    monkeypatch.setattr(jaccard_join, "components", seen)
    rows = list(enumerate(corpus(random.Random(3))))
    found = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), block=200)
    assert sorted(map(tuple, found.drop("kept", "text_hash").collect()), key=str) == brute_force(rows)
    assert plans and not any("InArrow" in plan for plan in plans)
