"""Drift detection and the application of schema events."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from changelake.operators import evolve
from changelake.operators.drift import added_table_columns, ddl_diff, schema_versions
from changelake.operators.evolve import apply_schema_events, empty_table, evolve_log, literal_default

CATALOG = "table_full string, column string, ordinal int, data_type string, column_default string"
OLD = [
    ("s.a", "id", 1, "int", None), ("s.a", "x", 2, "text", None), ("s.a", "y", 3, "text", None),
    ("s.a", "z", 4, "int", "0"), ("s.b", "id", 1, "int", None), ("s.c", "q", 1, "int", None),
]
NEW = [
    ("s.a", "id", 1, "int", None), ("s.a", "x2", 2, "text", None), ("s.a", "z2", 4, "int", "1"),
    ("s.b2", "id", 1, "int", None), ("s.c", "q", 1, "int", None), ("s.c", "r", 2, "date", None),
    ("s.n", "k", 1, "text", None),
]


def events_of(df):
    return {
        (r.operation, r.table or r.old_table, r.column or r.old_column or r.new_table, r.new_column)
        for r in df.collect()
    }


@pytest.mark.parametrize("match_default", [True, False])
def test_catalog_pair(spark, match_default):
    old, new = spark.createDataFrame(OLD, CATALOG), spark.createDataFrame(NEW, CATALOG)
    want = {
        ("RENAME_TABLE", "s.b", "s.b2", None),
        ("ADD_TABLE", "s.n", None, None),
        ("RENAME_COLUMN", "s.a", "x", "x2"),
        ("DROP_COLUMN", "s.a", "y", None),
        ("ADD_COLUMN", "s.c", "r", None),
    }
    if match_default:
        want |= {("DROP_COLUMN", "s.a", "z", None), ("ADD_COLUMN", "s.a", "z2", None)}
    else:
        want |= {("RENAME_COLUMN", "s.a", "z", "z2")}
    events = ddl_diff(old, new, match_default)
    assert events_of(events) == want
    assert [r.column for r in added_table_columns(old, new).collect()] == ["k"]
    earlier = spark.createDataFrame([("s.a", 2), ("s.b", 5), ("s.gone", 3)], "table string, version int")
    dropped = events.unionByName(
        spark.createDataFrame([("DROP_TABLE", "s.gone")], "operation string, table string"), allowMissingColumns=True
    )
    versions = {r.table: r.version for r in schema_versions(dropped, earlier).collect()}
    assert versions == {"s.a": 2 + (4 if match_default else 3), "s.b2": 5, "s.c": 1, "s.n": 1}


def test_same_catalog_has_no_events(spark):
    old = spark.createDataFrame(OLD, CATALOG)
    assert ddl_diff(old, old).count() == 0


def test_alike_tables_pair_one_to_one(spark):
    old = spark.createDataFrame([(f"s.o{i}", "c", 1, "int", None) for i in range(30)], CATALOG)
    new = spark.createDataFrame([(f"s.n{i}", "c", 1, "int", None) for i in range(20)], CATALOG)
    counts = Counter(r.operation for r in ddl_diff(old, new).collect())
    assert counts == {"RENAME_TABLE": 20, "DROP_TABLE": 10}
    pairs = ddl_diff(old, new).filter("operation = 'RENAME_TABLE'")
    assert pairs.select("new_table").distinct().count() == 20


def test_apply_to_one_table(spark):
    df = spark.createDataFrame([(1, "a", 2.5)], "id int, name string, price double")
    out = apply_schema_events(
        df,
        [
            {"operation": "ADD_COLUMN", "column": "n", "data_type": "integer", "default": "7"},
            {"operation": "ADD_COLUMN", "column": "t", "data_type": "text", "default": "'it''s'::text"},
            {"operation": "ADD_COLUMN", "column": "u", "data_type": "date", "default": "now()"},
            {"operation": "ADD_COLUMN", "column": "name", "data_type": "text", "default": "'kept'"},
            {"operation": "RENAME_COLUMN", "old_column": "price", "new_column": "amount"},
            {"operation": "RENAME_COLUMN", "old_column": "absent", "new_column": "other"},
            {"operation": "DROP_COLUMN", "column": "name"},
        ],
    )
    assert out.first().asDict() == {
        "id": 1, "name_deleted": "a", "amount": 2.5, "n": 7, "t": "it's", "u": None
    }
    assert dict(out.dtypes)["n"] == "int" and dict(out.dtypes)["u"] == "date"
    made = empty_table(spark, [{"column": "k", "data_type": "text"}, {"column": "b", "data_type": "bit"}])
    assert made.dtypes == [("k", "string"), ("b", "boolean")] and made.count() == 0


@pytest.mark.parametrize(
    "text, value",
    [(None, None), ("0", "0"), ("-1.5", "-1.5"), ("'x'", "x"), ("now()", None), ("true", "true"), ("", None)],
)
def test_literal_default(text, value):
    assert literal_default(text) == value


EVENTS = (
    "seq bigint, database string, operation string, `table` string, old_table string, new_table string,"
    " column string, old_column string, new_column string, `default` string"
)


def event(seq, operation, table=None, old_table=None, new_table=None, column=None, old_column=None,
          new_column=None, default=None):
    return (seq, "d", operation, table, old_table, new_table, column, old_column, new_column, default)


def replayed(log, events):
    """Rows kept per table and rewritten at each schema event."""
    tables = {}
    steps = sorted([(r[1], 0, r) for r in log] + [(e[0], 1, e) for e in events], key=lambda s: s[:2])
    for _, kind, item in steps:
        if kind == 0:
            tables.setdefault(item[0], []).append((item[1], dict(item[2])))
            continue
        _, db, op, table, old_t, new_t, col, old_c, new_c, default = item
        if op in ("RENAME_TABLE", "DROP_TABLE"):
            source = f"{db}.{old_t or table}"
            target = f"{db}.{new_t or table + '_deleted'}"
            tables.setdefault(target, []).extend(tables.pop(source, []))
            continue
        for _, row in tables.get(f"{db}.{table}", []):
            if op == "ADD_COLUMN":
                if default is not None:
                    row.setdefault(col, default)
                continue
            a, b = (old_c, new_c) if op == "RENAME_COLUMN" else (col, f"{col}_deleted")
            row.pop(b, None)
            if a in row:
                row[b] = row.pop(a)
    return {(t, s): row for t, rows in tables.items() for s, row in rows}


LOG = "table_key string, seq bigint, data map<string,string>"


def evolved(spark, log, events):
    out = evolve_log(spark.createDataFrame(log, LOG), spark.createDataFrame(events, EVENTS))
    return {(r.table_key, r.seq): r.data for r in out.collect()}


def test_evolve_log(spark):
    log = [(f"d.{t}", s, {"x": f"{s}", "y": "1"}) for s in range(0, 100, 5) for t in ("a", "b")]
    events = [
        event(11, "RENAME_COLUMN", "a", old_column="x", new_column="p"),
        event(22, "RENAME_TABLE", old_table="a", new_table="c"),
        event(31, "RENAME_COLUMN", "c", old_column="p", new_column="q"),
        event(33, "ADD_COLUMN", "c", column="z", default="9"),
        event(41, "DROP_COLUMN", "b", column="y"),
        event(52, "DROP_TABLE", "b"),
        event(63, "RENAME_COLUMN", "a", old_column="x", new_column="w"),
    ]
    assert evolved(spark, log, events) == replayed(log, events)
    assert evolved(spark, log, []) == replayed(log, [])


@pytest.mark.parametrize("seed", range(8))
def test_evolve_random_log(spark, seed):
    rng = random.Random(seed)
    names, tables = ["x", "y", "z"], ["a", "b"]
    log = [
        (f"d.{rng.choice(tables)}", s, {c: f"{c}{s}" for c in rng.sample(names, 2)}) for s in range(0, 200, 2)
    ]
    events = []
    for s in sorted(rng.sample(range(1, 200, 2), 12)):
        table, (old, new) = rng.choice(tables), rng.sample(names, 2)
        events.append(
            rng.choice(
                [
                    event(s, "RENAME_COLUMN", table, old_column=old, new_column=new),
                    event(s, "DROP_COLUMN", table, column=old),
                    event(s, "ADD_COLUMN", table, column=old, default="5"),
                    event(s, "RENAME_TABLE", old_table=table, new_table=f"r{s}"),
                ]
            )
        )
    assert evolved(spark, log, events) == replayed(log, events)


def spread(spark, hot):
    """A log with most rows in one table, and events on it up to the middle."""
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 10 < hot, "d.a").otherwise(F.concat(F.lit("d.t"), F.col("id") % 7)).alias("table_key"),
        F.col("id").alias("seq"),
        F.create_map(F.lit("x"), F.col("id").cast("string")).alias("data"),
    )
    events = [event(5_000, "RENAME_COLUMN", "a", old_column="x", new_column="p"), event(10_000, "RENAME_TABLE", old_table="a", new_table="c")]
    return rows, spark.createDataFrame(events, EVENTS)


def joins(df, kind):
    return df._jdf.queryExecution().executedPlan().toString().count(kind)


def test_log_is_joined_once(spark, tmp_path):
    rows, events = spread(spark, 9)
    rows.write.parquet(f"{tmp_path}/log")
    out = evolve_log(spark.read.parquet(f"{tmp_path}/log"), events)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert joins(out, "BroadcastHashJoin") == 1 and joins(out, "SortMergeJoin") == 0 and joins(out, "Window") == 0
    # The rows after the last event come from a scan of their own, which no join reads.
    first, later = text.split("Union")[1].split("FileScan parquet [table_key")[1:3]
    assert "LessThanOrEqual(seq,10000)" in first and "GreaterThan(seq,10000)" in later
    counts = {r.table_key: r["count"] for r in out.groupBy("table_key").count().collect()}
    assert counts["d.a"] == 9_000 and counts["d.c"] == 9_000 and sum(counts.values()) == 20_000
    assert out.filter("table_key = 'd.c' AND seq < 5000 AND data['p'] IS NULL").isEmpty()


def test_many_rules_spread_a_hot_table(spark, monkeypatch):
    monkeypatch.setattr(evolve, "MOST_SENT", 0)
    rows, events = spread(spark, 9)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = evolve_log(rows, events)
        assert joins(out, "SortMergeJoin") == 1
        parts = out.filter("seq <= 10000").groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in parts) < 0.5 * 10_001
        want = {(r.table_key, r.seq): r.data for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    monkeypatch.undo()
    assert want == {(r.table_key, r.seq): r.data for r in evolve_log(rows, events).collect()}


@pytest.mark.parametrize("seed", range(3))
def test_random_logs_with_many_rules(spark, monkeypatch, seed):
    monkeypatch.setattr(evolve, "MOST_SENT", 0)
    test_evolve_random_log(spark, seed)


def test_rows_without_a_place_stay(spark):
    log = [("d.a", None, {"x": "1"}), (None, 1, {"x": "2"}), ("d.a", 1, None), ("d.a", 1, {"x": "3"})]
    events = spark.createDataFrame([event(5, "RENAME_COLUMN", "a", old_column="x", new_column="p")], EVENTS)
    outs = [evolve_log(spark.createDataFrame(log, LOG), events, stored=stored).collect() for stored in (True, False)]
    rows, computed = ({(r.table_key, r.seq, None if r.data is None else tuple(r.data.items())) for r in out} for out in outs)
    assert computed == rows == {("d.a", None, (("x", "1"),)), (None, 1, (("x", "2"),)), ("d.a", 1, None), ("d.a", 1, (("p", "3"),))}
