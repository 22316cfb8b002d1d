import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from changelake.llm import merkle
from changelake.llm.queries import op13_merkle_manifest

COLUMNS = ["doc_id", "source", "text"]


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i : i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def path(tree, place):
    steps = []
    for nodes in tree[:-1]:
        first = place - place % 3
        run = nodes[first : first + 3]
        steps.append(("".join(run[: place % 3]), "".join(run[place % 3 + 1 :])))
        place //= 3
    return steps


def expected(rows, change=lambda id, text: text):
    """Root, and for each row (id, source, leaf, altered leaf, subroot, path), from the definition."""
    groups = {}
    for id, source, text in rows:
        entry = (id is not None, id or 0, sha(field(id), field(source), field(text)), sha(field(id), field(source), field(change(id, text))))
        groups.setdefault(source, []).append(entry)
    order = sorted(groups, key=lambda name: (name is not None, (name or "").encode()))
    trees = {name: levels([leaf for _, _, leaf, _ in sorted(groups[name])]) for name in order}
    top = levels([trees[name][-1][0] for name in order])
    out = []
    for at, name in enumerate(order):
        for place, (known, id, leaf, altered) in enumerate(sorted(groups[name])):
            out.append((id if known else None, name, leaf, altered, trees[name][-1][0], path(trees[name], place) + path(top, at)))
    return top[-1][0] if order else None, out


def found(spark, rows, **options):
    df = spark.createDataFrame([(*row, 1, "x", "y") for row in rows], "doc_id long, source string, text string, pos int, tree string, digest string")
    return merkle.manifest(df.repartition(3), COLUMNS, **options)


def key(row):
    return str(row)


def as_rows(result):
    return sorted(((r.doc_id, r.source, r.leaf, r.altered_leaf, r.subroot, [(s.left, s.right) for s in r.path]) for r in result), key=key)


ROWS = [(n, f"s{n % 3}" if n % 4 else "hot", f"text {n}\n") for n in range(230)] + [(1000 + n, "hot", "x\ny" * n) for n in range(20)]


@pytest.mark.parametrize("tier", [1, 2, 6])
def test_equals_the_definition(spark, monkeypatch, tier):
    monkeypatch.setattr(merkle, "TIER", tier)
    root, want = expected(ROWS)
    result = found(spark, ROWS).collect()
    assert as_rows(result) == sorted(want, key=key) and {r.root for r in result} == {root}


def test_nulls_ties_and_repeated_rows(spark):
    rows = [(None, None, None), (None, None, ""), (1, None, "a"), (1, None, "a"), (1, "", "b"), (2, "é", "c"), (2, "z", "c"), (3, "Z", "\n"), (None, "z", "d"), (3, "-", "q"), (3, "=", "q")]
    root, want = expected(rows)
    result = found(spark, rows).collect()
    assert as_rows(result) == sorted(want, key=key) and {r.root for r in result} == {root}


def test_one_row_and_no_row(spark):
    root, want = expected([(7, "s", "t")])
    (only,) = found(spark, [(7, "s", "t")]).collect()
    assert only.root == only.subroot == only.leaf == root == want[0][2] and only.path == []
    empty = found(spark, [])
    assert empty.collect() == [] and empty.columns == ["doc_id", "source", "leaf", "altered_leaf", "subroot", "root", "path"]


def test_a_changed_leaf_folds_to_another_root(spark):
    changed = F.when(F.col("doc_id") % 2 == 0, F.upper("text")).otherwise(F.col("text"))
    result = found(spark, ROWS, altered={"text": changed}).withColumn("folded", merkle.fold(F.col("path"), F.col("altered_leaf"))).collect()
    assert all((r.folded == r.root) == (r.leaf == r.altered_leaf) for r in result)
    assert sum(r.folded != r.root for r in result) > 50


def test_no_key_gathers_a_group(spark):
    """Windows and aggregates over nodes are dealt by the ancestor, not by the group alone."""
    plan = found(spark, ROWS)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(tree#" in plan and "top#" in plan


def test_query_equals_the_definition(spark, tmp_path):
    draw = random.Random(3)
    rows = [(draw.randrange(60), draw.choice(["a", "b", None, "hot", "hot", "hot"]), draw.choice(["en", None]), n, draw.choice(["a\nb", "c", None, "", "\n"])) for n in range(120)]
    schema = "doc_id long, source string, lang string, n_chars long, text string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")

    def leaf(id, source, lang, n, text):
        return sha(*map(field, (id, source, lang, n, text)))

    groups = {}
    for row in rows:
        text = row[4]
        if text is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
            text = text.replace("\n", "")
        groups.setdefault(row[1], []).append((row[0], leaf(*row), leaf(*row[:4], text)))
    order = sorted(groups, key=lambda name: (name is not None, name or ""))
    trees = {name: levels([entry[1] for entry in sorted(groups[name])]) for name in order}
    top, want = levels([trees[name][-1][0] for name in order]), []
    for at, name in enumerate(order):
        for place, (id, own, altered) in enumerate(sorted(groups[name])):
            steps, node = path(trees[name], place) + path(top, at), altered
            for left, right in steps:
                node = sha(left, node, right)
            root = top[-1][0]
            want.append((id, own, trees[name][-1][0], root, sha(*[left + right for left, right in steps]), node, node == root))
    assert sorted(map(tuple, op13_merkle_manifest(spark, str(tmp_path)).collect()), key=key) == sorted(want, key=key)
