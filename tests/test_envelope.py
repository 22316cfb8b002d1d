"""Envelopes: parsing, routing, quarantine and identity."""

import json

from pyspark.sql import functions as F

from changelake.operators.envelope import (
    build_envelope,
    flatten,
    identify,
    parse_envelope,
    row_topic,
    schema_topic,
    split_valid,
)


def envelope(**fields):
    base = {"operation": "insert", "table": "public.Orders", "database": " shop ", "source": "postgresql"}
    return json.dumps({**base, "timestamp": "2024-01-01T00:00:00", "data": {"id": 1}} | fields)


CASES = [
    (envelope(), None),
    (envelope(data='{"id": 2, "tags": ["a", {"b": 1}], "x": null}'), None),
    (envelope(operation="TRUNCATE"), "unknown operation"),
    (envelope(operation=None), "unknown operation"),
    (envelope(table=" "), "no table"),
    (envelope(table=None), "no table"),
    (envelope(database=""), "no database"),
    (envelope(data="not json"), "no data"),
    ("{broken", "malformed"),
    (envelope(data='{"x": 1, "x": 2}'), "repeated name"),
    ('{"operation": "DELETE", "table": "t", "database": "d", "data": {"x": 1, "y": 0, "x": 1}}', "repeated name"),
    (envelope(operation="ADD_COLUMN", data=None, column="c"), None),
    (envelope(operation="ADD_COLUMN", data=None), "no column"),
    (envelope(operation="RENAME_COLUMN", data=None, old_column="c"), "no column"),
    (envelope(operation="RENAME_TABLE", data=None, table=None, old_table="s.A", new_table="s.B"), None),
    (envelope(operation="RENAME_TABLE", data=None, table=None, old_table="s.A"), "no table"),
    (envelope(operation="DROP_TABLE", data=None, table=""), "no table"),
]


def parsed(spark):
    raw = spark.createDataFrame([(i, v) for i, (v, _) in enumerate(CASES)], "seq bigint, value string")
    return parse_envelope(raw)


def test_faults(spark):
    got = {r.seq: r.fault for r in parsed(spark).collect()}
    assert got == {i: fault for i, (_, fault) in enumerate(CASES)}


def test_split_keeps_every_event(spark):
    good, bad = split_valid(parsed(spark))
    assert good.count() + bad.count() == len(CASES)
    assert {r.value for r in bad.collect()} == {v for v, fault in CASES if fault}


def test_names_and_data(spark):
    row = parsed(spark).filter("seq = 1").first()
    assert (row.operation, row.database, row.table, row.table_key) == ("INSERT", "shop", "orders", "shop.orders")
    assert row.data == {"id": "2", "tags": '["a",{"b":1}]', "x": None}
    renamed = parsed(spark).filter("operation = 'RENAME_TABLE' AND fault IS NULL").first()
    assert (renamed.old_table, renamed.new_table) == ("a", "b")


def test_identity(spark):
    good, _ = split_valid(parsed(spark))
    rows = identify(good.filter("route = 'change'"), "id")
    assert {r.record_id for r in rows.collect()} == {"shop_orders_1", "shop_orders_2"}
    by_table = identify(good.filter("seq = 0"), {"shop.orders": "id", "shop.other": "x"})
    assert by_table.first().row_key == "1"
    hashed = identify(good.filter("route = 'change'"), "absent").collect()
    assert all(len(r.row_key) == 32 for r in hashed) and len({r.row_key for r in hashed}) == 2
    flat = flatten(rows, ["id", "tags"]).columns
    assert flat[:5] == ["_source_database", "_source_table", "_source_type", "_operation", "_record_id"]
    timed = flatten(rows, ["id"], processed_at=F.lit("2024-01-02 03:04:05.000006").cast("timestamp_ntz"))
    assert {r._processed_at for r in timed.collect()} == {"2024-01-02T03:04:05.000006"}


def test_build_and_parse_agree(spark):
    df = spark.createDataFrame([(1, "é", None)], "id int, name string, gone string")
    wire = build_envelope(
        df.withColumn("seq", F.lit(1)), ["id", "name", "gone"], F.lit("UPDATE"), F.lit("t"), F.lit("d"),
        F.lit("mssql"), F.lit("2024-02-03 04:05:06").cast("timestamp_ntz"),
    ).select("seq", "value")
    row = parse_envelope(wire).first()
    assert row.fault is None and row.timestamp == "2024-02-03T04:05:06"
    assert row.data == {"id": "1", "name": "é", "gone": None}


def test_a_carried_id_is_the_identity(spark):
    texts = [envelope(row_id="r1"), envelope(operation="DELETE", row_id="r1", data={"id": "01"}), envelope(data={"v": 1})]
    events = parse_envelope(spark.createDataFrame(list(enumerate(texts)), "seq bigint, value string"))
    keys = [r.row_key for r in identify(events, "id").orderBy("seq").collect()]
    assert keys[:2] == ["r1", "r1"] and len(keys[2]) == 32


def test_topics(spark):
    df = spark.createDataFrame([("PostgreSQL",), ("mssql",), (None,), ("oracle",)], "source string")
    got = [r[0] for r in df.select(schema_topic(F.col("source"), F.lit("d"))).collect()]
    assert got == ["d-ddl-topic", "d-ddl-topic", "d-ddl-topic", "unknown-ddl-topic"]
    assert df.select(row_topic(F.lit("d"), F.lit("t"))).first()[0] == "d-t-topic"
