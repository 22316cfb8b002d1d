"""Polls of several tables."""

from pyspark.sql import functions as F

from changelake.operators.envelope import identify, parse_envelope
from changelake.operators.fold import fold_state
from changelake.plans.poll import Polled, poll_tables


def at():
    return F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")

EVENTS = "operation string, table string, column string, old_column string, new_column string"


def polled(spark, tables, events=()):
    out, kept, failed = poll_tables(tables, spark.createDataFrame(list(events), EVENTS), "d", "mssql", at())
    rows = [] if out is None else parse_envelope(out.withColumn("seq", F.lit(1))).collect()
    return {(r.table, r.row_id, r.operation) for r in rows}, kept, failed


def test_tables_fail_and_rest_apart(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    after = spark.createDataFrame([(1, "A"), (3, "c")], "id int, v string")
    tables = {
        "t": Polled(lambda: after, "id", last=before),
        "new": Polled(lambda: after, "id"),
        "off": Polled(lambda: after, "id", last=before, enabled=False),
        "gone": Polled(lambda: spark.read.parquet("/no/such/folder"), "id", last=before),
        "never": Polled(lambda: spark.read.parquet("/no/such/folder"), "id"),
    }
    found, kept, failed = polled(spark, tables)
    assert found == {
        ("t", "1", "UPDATE"), ("t", "2", "DELETE"), ("t", "3", "INSERT"), ("new", "1", "INITIAL_LOAD"), ("new", "3", "INITIAL_LOAD"),
    }
    assert failed == {"gone": "PATH_NOT_FOUND", "never": "PATH_NOT_FOUND"}
    assert kept["t"] is after and kept["gone"] is before and kept["off"] is before and "never" not in kept
    assert polled(spark, {})[0] == set()


def test_a_value_changed_in_a_renamed_column_is_an_update(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    after = spark.createDataFrame([(1, "a"), (2, "B")], "number int, w string")
    events = [("RENAME_COLUMN", "t", None, "v", "w"), ("RENAME_COLUMN", "t", None, "id", "number"), ("DROP_COLUMN", "u", "v", None, None)]
    found, _, _ = polled(spark, {"t": Polled(lambda: after, "number", last=before)}, events)
    assert found == {("t", "2", "UPDATE")}


def test_microseconds_arrive(spark):
    before = spark.createDataFrame([("2024-01-01 00:00:00.000001",), ("2024-01-01 00:00:00.000002",)], "t string")
    before = before.select(F.col("t").cast("timestamp_ntz").alias("t"))
    out, _, _ = poll_tables({"t": Polled(lambda: before)}, spark.createDataFrame([], EVENTS), "d", "mssql", at())
    events = identify(parse_envelope(out.withColumn("seq", F.lit(1))), "none")
    state = fold_state(events, ["table_key", "row_key"], "seq", ["data"])
    assert {r.t for r in state.select(F.col("data")["t"].alias("t")).collect()} == {"2024-01-01T00:00:00.000001", "2024-01-01T00:00:00.000002"}
