"""Snapshot diff: edge rows, algebra and plan."""

import random

import pytest
from pyspark.sql import functions as F

from changelake.operators.diff import (
    briefed,
    last_wins,
    snapshot_deletes,
    snapshot_diff,
    snapshot_diff_narrow,
    snapshot_inserts,
    snapshot_updates,
)
from changelake.session import scratch_dir

SCHEMA = "id int, a string, b double"
PREV = [(1, "x", 1.0), (2, None, 2.0), (3, "z", None), (4, "k", 4.0), (5, "gone", 5.0), (6, None, None)]
CUR = [(1, "x", 1.0), (2, "y", 2.0), (3, None, None), (4, "k", 4.5), (6, None, None), (7, "new", 7.0)]


def summary(changes):
    return {
        r._row_id: (r.operation, r.before and tuple(r.before), r.after and tuple(r.after))
        for r in changes.collect()
    }


WANT = {
    "2": ("UPDATE", PREV[1], CUR[1]),
    "3": ("UPDATE", PREV[2], CUR[2]),
    "4": ("UPDATE", PREV[3], CUR[3]),
    "5": ("DELETE", PREV[4], None),
    "7": ("INSERT", None, CUR[5]),
}


def narrow(prev, cur, key):
    return snapshot_diff_narrow(prev, cur, key, scratch_dir(prev.sparkSession, "changed"))


@pytest.mark.parametrize("diff", [snapshot_diff, narrow])
def test_edge_rows(spark, diff):
    prev, cur = spark.createDataFrame(PREV, SCHEMA), spark.createDataFrame(CUR, SCHEMA)
    assert summary(diff(prev, cur, "id")) == WANT
    assert summary(diff(prev, prev, "id")) == {}
    empty = prev.limit(0)
    assert {v[0] for v in summary(diff(empty, cur, "id")).values()} == {"INSERT"}
    assert {v[0] for v in summary(diff(prev, empty, "id")).values()} == {"DELETE"}


def test_parts(spark):
    prev, cur = spark.createDataFrame(PREV, SCHEMA), spark.createDataFrame(CUR, SCHEMA)
    assert [r.id for r in snapshot_inserts(prev, cur, "id").collect()] == [7]
    assert [r.id for r in snapshot_deletes(prev, cur, "id").collect()] == [5]
    assert sorted(r.id for r in snapshot_updates(prev, cur, "id").collect()) == [2, 3, 4]


def test_new_column_is_no_update(spark):
    prev = spark.createDataFrame(PREV, SCHEMA)
    cur = prev.withColumn("c", F.lit(1)).drop("b")
    assert snapshot_diff(prev, cur, "id").count() == 0
    assert narrow(prev, cur, "id").count() == 0


def test_keyless_and_blank_keys(spark):
    rows = [(" ", 1), (None, 2), ("k", 3), ("k", 4)]
    df = spark.createDataFrame(rows, "k string, v int")
    changes = summary(snapshot_diff(df.limit(0), df, "k"))
    assert len(changes) == 3 and changes["k"][2] == ("k", 4)
    keyless = snapshot_diff(df.unionByName(df), df.filter("v > 1"))
    assert [(r.operation, r.before.v) for r in keyless.collect()] == [("DELETE", 1)]


def test_last_wins_takes_the_greatest(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(5), rng.randrange(50), rng.choice([None, "p", "q"])) for _ in range(400)]
    df = spark.createDataFrame(rows, "k int, o int, v string").repartition(4)
    got = {r.k: (r.o, r.v) for r in last_wins(df, ["k"], ["o"]).collect()}
    want = {}
    for k, o, v in rows:
        want[k] = max(want.get(k, (-1, "")), (o, v or ""))
    assert {k: (o, v or "") for k, (o, v) in got.items()} == want


def test_applying_the_diff_gives_the_new_snapshot(spark):
    rng = random.Random(2)
    def snapshot():
        return [(i, rng.choice(["a", "b", None]), float(rng.randrange(3))) for i in range(300) if rng.random() < 0.8]
    prev, cur = snapshot(), snapshot()
    changes = summary(snapshot_diff(spark.createDataFrame(prev, SCHEMA), spark.createDataFrame(cur, SCHEMA), "id"))
    rows = {str(r[0]): r for r in prev}
    for key, (operation, before, after) in changes.items():
        assert rows.get(key) == before
        rows[key] = after
        if operation == "DELETE":
            del rows[key]
    assert sorted(rows.values()) == sorted(cur)


def test_one_shuffle_per_side(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        prev, cur = spark.createDataFrame(PREV, SCHEMA), spark.createDataFrame(CUR, SCHEMA)
        plan = snapshot_diff(prev, cur, "id")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange hashpartitioning") == 2


def test_first_pass_of_the_narrow_diff_shuffles_hashes_only(spark):
    wide = spark.createDataFrame([(1, "a", 2.0, "long text")], "id int, a string, b double, note string")
    brief = briefed(wide, "id", wide.columns, ["b"])
    plan = brief._jdf.queryExecution().executedPlan().toString()
    below = plan.split("Exchange", 1)[1].split("Project", 1)[0]
    assert "_hash1" in below and "note" not in below and " a#" not in below
    assert brief.columns == ["_row_id", "b", "_hash1", "_hash2", "_same1", "_same2"]


def test_both_passes_choose_the_same_of_repeated_ids(spark):
    prev = spark.createDataFrame([(1, "x", 1.0), (1, "y", 1.0), (2, "z", 1.0)], SCHEMA)
    cur = spark.createDataFrame([(1, "y", 1.0), (1, "x", 1.0), (2, "z", 2.0), (2, "w", 3.0)], SCHEMA)
    found = {r._row_id: r for r in narrow(prev, cur, "id").collect()}
    assert set(found) == {"2"} and found["2"].before.a == "z"
    ordered = snapshot_diff_narrow(prev, cur, "id", scratch_dir(spark, "changed"), ["b"]).collect()
    assert [(r._row_id, r.after.a) for r in ordered] == [("2", "w")]
