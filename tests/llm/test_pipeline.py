import random
import re

import corpus_pipeline
import numpy as np
import pytest

from changelake.llm.columns import stored

WORD = re.compile(r"[^\x20\x09-\x0D]+")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    draw = random.Random(21)
    syllables = {"en": "ka lo mi ne tu ra", "de": "sch ung ein ver ach ber"}

    def prose(name, words):
        parts = syllables[name].split()
        return " ".join("".join(draw.choice(parts) for _ in range(draw.randrange(1, 5))) for _ in range(words))

    items = [prose("en", 25) for _ in range(4)]
    texts = [(prose(name, draw.randrange(30, 90)), name) for _ in range(70) for name in ("en", "de")]
    copies = [(text.replace(" ", "  ", 1), name) for text, name in texts[:20]] + [texts[5]] * 15
    near = []
    for text, name in texts[20:50]:
        words = text.split()
        words[draw.randrange(len(words))] = prose(name, 1)
        near.append((" ".join(words), name))
    leaks = [(f"{prose('en', 40)}. {item} {prose('en', 30)}", "en") for item in items]
    junk = [("12 34 %%", "en"), (None, None), ("", "en"), ("wxzq yqpw xwzf " * 10, None)]
    rows = [(n, text, name, "s", len(text or "")) for n, (text, name) in enumerate(texts + copies + near + leaks + junk)]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows, items


def near_classes(rows):
    sets = {}
    for id, text, *_ in rows:
        words = WORD.findall(text.lower())
        sets[id] = {tuple(words[k : k + 4]) for k in range(len(words) - 3)} or {tuple(words)}
    label = {id: id for id in sets}
    for a in sets:
        for b in sets:
            if b < a and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]) and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = {id: low if each == high else each for id, each in label.items()}
    return label


def test_stages_equal_brute_force(spark, folder):
    path, rows, items = folder
    docs, kept = spark.read.parquet(f"{path}/documents.parquet"), {row[0]: row for row in rows}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stored(stage(spark, docs, path), "stage")
        found = {row.doc_id: row for row in docs.collect()}
        if number == 0:
            kept = {id: row for id, row in kept.items() if row[0] < len(rows) - 4}
        elif number == 1:
            first = {}
            for id, row in sorted(kept.items()):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", row[1]), id)
            kept = {id: kept[id] for id in first.values()}
        elif number == 2:
            kept = {id: kept[id] for id, label in near_classes(kept.values()).items() if id == label}
        elif number == 3:
            kept = {id: row for id, row in kept.items() if not any(item in row[1] for item in items)}
        assert set(found) == set(kept), name
        assert docs.count() == len(kept)
        if number < 4:
            assert docs.columns == [part.split()[0] for part in COLUMNS.split(", ")]
            assert all(tuple(found[id]) == kept[id] for id in kept)
        else:
            assert all(row.n_tokens == len(np.frombuffer(row.ids, "<u4")) > 0 for row in found.values())


def test_run_writes_every_stage(spark, folder):
    found = corpus_pipeline.run(spark, folder[0])
    assert found.columns == ["doc_id", "n_tokens", "ids"] and 100 < found.count() < len(folder[1])


def test_empty_table_and_rows_without_ids(spark, tmp_path, folder):
    spark.createDataFrame([], COLUMNS).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/none/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []
    rows = [(None, *row[1:]) if row[0] % 2 else row for row in folder[1]] + [folder[1][0]] * 3
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{tmp_path}/some/documents.parquet")
    spark.createDataFrame(list(enumerate(folder[2])), "item_id long, text string").write.parquet(f"{tmp_path}/some/benchmark.parquet")
    whole, some = (corpus_pipeline.run(spark, path).count() for path in (folder[0], f"{tmp_path}/some"))
    assert whole == some
