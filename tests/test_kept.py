"""Polls on stored snapshots."""

import pytest
from pyspark.sql import functions as F

from changelake.operators.diff import snapshot_diff
from changelake.operators.envelope import parse_envelope
from changelake.plans.kept import Kept, Snapshots, differing, snapshot_diff_kept
from changelake.plans.poll import Polled

EVENTS = "operation string, table string, column string, old_column string, new_column string"


def at():
    return F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")


def messages(poll):
    rows = [] if poll.messages is None else parse_envelope(poll.messages.withColumn("seq", F.lit(1))).collect()
    return {(r.table, r.row_id, r.operation, r.data["v"] if r.operation != "DELETE" else None) for r in rows}


def run(area, tables, events=(), commit=True):
    poll = area.poll(tables, area.spark.createDataFrame(list(events), EVENTS), "d", "mssql", at())
    found = messages(poll)
    if commit:
        poll.commit()
    return found, poll.failed


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def kept(spark, folder, df, **options):
    return Kept(spark, str(folder), df.schema, options.get("key", "id"), options.get("unique", False), tuple(options.get("order", ())), 8).write(df)


def test_a_source_that_changes_with_each_read_loses_nothing(spark, tmp_path):
    """What is compared next time is what was sent this time."""
    reads = []

    def read():
        reads.append(len(reads))
        # Each execution of the plan gives other values: the stored ones alone may count.
        now = F.udf(lambda id: f"{len(reads)}-{__import__('uuid').uuid4()}").asNondeterministic()
        return spark.range(5).select("id", now("id").alias("v"))

    area, state = Snapshots(spark, str(tmp_path), 4), {}
    for _ in range(3):
        found, failed = run(area, {"t": Polled(read, "id")})
        assert failed == {} and len(found) == 5
        state |= {id: v for _, id, _, v in found}
        stored = {str(row.id): row.v for row in area.last()["t"].rows().collect()}
        assert stored == state
    assert len(reads) == 3


def test_changes_between_polls_and_polls_without_a_commit(spark, tmp_path):
    frames = [
        spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "id int, v string"),
        spark.createDataFrame([(1, "A"), (3, "c"), (None, "n")], "id int, v string"),
    ]
    area, now = Snapshots(spark, str(tmp_path), 4), [0]
    tables = {"t": Polled(lambda: frames[now[0]], "id"), "off": Polled(lambda: frames[0], "id", enabled=False)}
    first, _ = run(area, tables)
    assert {(op, v) for _, _, op, v in first} == {("INITIAL_LOAD", "a"), ("INITIAL_LOAD", "b"), ("INITIAL_LOAD", "n")}
    now[0] = 1
    want = {("t", "1", "UPDATE", "A"), ("t", "2", "DELETE", None), ("t", "3", "INSERT", "c")}
    assert run(area, tables, commit=False)[0] == want
    assert run(area, tables)[0] == want
    assert run(area, tables)[0] == set()
    assert list(area.last()) == ["t"] and area.manifest().count() == 3
    # Of the snapshots, only the last one is left.
    assert [path.name for path in (tmp_path / "snapshots/t").iterdir()] == ["poll=3"]


def test_tables_fail_apart_when_they_run(spark, tmp_path):
    good = spark.createDataFrame([(1, "a")], "id int, v string")
    bad = [False]

    def broken():
        fails = F.when(F.col("id") > 0, F.raise_error(F.lit("lost"))).otherwise(F.lit("x"))
        return good.withColumn("v", fails.cast("string")) if bad[0] else good

    area = Snapshots(spark, str(tmp_path), 4)
    tables = {"b": Polled(broken, "id"), "t": Polled(lambda: good, "id"), "gone": Polled(lambda: spark.read.parquet("/no/such/folder"), "id")}
    found, failed = run(area, tables)
    assert {row[0] for row in found} == {"b", "t"} and failed == {"gone": "PATH_NOT_FOUND"}
    bad[0] = True
    tables["t"] = Polled(lambda: good.withColumn("v", F.lit("new")), "id")
    found, failed = run(area, tables)
    assert found == {("t", "1", "UPDATE", "new")} and set(failed) == {"b", "gone"}
    assert rows(area.last()["b"].rows()) == [(1, "a")]
    assert {(r.poll, r.name, r.status == "WHOLE") for r in area.manifest().collect()} == {
        (1, "b", True), (1, "t", True), (1, "gone", False), (2, "b", False), (2, "t", True), (2, "gone", False),
    }


def test_renamed_and_added_columns_are_compared_on_the_stored_rows(spark, tmp_path):
    area, frames = Snapshots(spark, str(tmp_path), 4), [spark.createDataFrame([(1, "a"), (2, "b")], "id int, w string")]
    tables = {"t": Polled(lambda: frames[0].withColumn("v", F.col(frames[0].columns[1])), "id")}
    run(area, tables)
    frames[0] = spark.createDataFrame([(1, "a"), (2, "B")], "id int, u string").withColumn("more", F.lit(1))
    tables = {"t": Polled(lambda: frames[0].withColumn("v", F.lower("u")), "id")}
    assert run(area, tables, [("RENAME_COLUMN", "t", None, "w", "u")])[0] == {("t", "2", "UPDATE", "b")}


@pytest.mark.parametrize("unique", [False, True])
def test_diff_is_that_of_the_snapshots(spark, tmp_path, unique):
    prev = spark.range(300).select("id", (F.col("id") % 7).alias("v"), F.when(F.col("id") % 5 > 0, "x").alias("w"))
    cur = prev.filter("id % 11 <> 3").withColumn("v", F.when(F.col("id") % 10 == 0, -1).otherwise(F.col("v"))).unionByName(
        spark.range(900, 920).select("id", F.lit(0).cast("long").alias("v"), F.lit(None).cast("string").alias("w"))
    )
    if not unique:
        prev, cur = prev.union(prev), cur.union(cur.limit(50))
    old, new = kept(spark, tmp_path / "old", prev, unique=unique), kept(spark, tmp_path / "new", cur, unique=unique)
    assert rows(snapshot_diff_kept(old, new, f"{tmp_path}/changed")) == rows(snapshot_diff(prev, cur, "id"))


def test_digests_are_joined_without_a_shuffle_also_in_another_session(spark, tmp_path):
    df = spark.range(100).select("id", F.lit("x").alias("v"))
    old, new = kept(spark, tmp_path / "old", df), kept(spark, tmp_path / "new", df.filter("id > 3"))
    spark.sql(f"DROP TABLE {old._name}")
    old = Kept.of(spark, old.detail)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = differing(old, new)._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and plan.count("Bucketed: true") == 2
        assert rows(differing(old, new)) == [(str(n), "DELETE") for n in range(4)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
