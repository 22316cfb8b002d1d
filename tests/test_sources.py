"""Readers that need no server."""

from pyspark.sql import functions as F

from changelake.sources import readers
from changelake.sources.writers import write_topic_folders


def test_catalogs(spark):
    tables = spark.createDataFrame(
        [("public", "a", "BASE TABLE"), ("public", "v", "VIEW"), ("PG_CATALOG", "p", "BASE TABLE"),
         ("INFORMATION_SCHEMA", "i", "BASE TABLE"), ("sys", "s", "BASE TABLE")],
        "table_schema string, table_name string, table_type string",
    )
    columns = spark.createDataFrame(
        [("public", "a", "x", 1, "int", "0"), ("public", "v", "y", 1, "int", None), ("sys", "s", "z", 1, "int", None)],
        "table_schema string, table_name string, column_name string, ordinal_position int,"
        " data_type string, column_default string",
    )
    assert [r.table_full for r in readers.base_tables(tables).collect()] == ["public.a"]
    assert readers.catalog_from_columns(columns, tables).collect() == [("public.a", "x", 1, "int", "0")]
    own = readers.catalog_of(spark, {"s.t": spark.sql("SELECT 1 a, 'x' b")})
    assert [tuple(r)[:4] for r in own.collect()] == [("s.t", "a", 1, "int"), ("s.t", "b", 2, "string")]


def test_sources_fail_apart(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/good")
    found, failed = readers.read_sources(spark, {"g": f"{tmp_path}/good", "m": f"{tmp_path}/missing"})
    assert found["g"].count() == 3 and failed == {"m": "PATH_NOT_FOUND"}
    assert readers.read_or_empty(spark, f"{tmp_path}/missing", "id bigint").count() == 0


def test_kafka_options():
    options = readers.kafka_options("host:9092", maxOffsetsPerTrigger="5")
    assert options["subscribePattern"] == ".*" and options["startingOffsets"] == "earliest"
    assert options["maxOffsetsPerTrigger"] == "5"


def test_sequence_across_topics(spark):
    offsets = [7, 8, 2**20 - 1, 2**20, 2**20 + 1, 2**62]
    rows = [("2024-01-01 00:00:00.001", offset) for offset in offsets] + [("2024-01-01 00:00:00.002", 3), ("9999-12-31 00:00:00", 2**63 - 1)]
    df = spark.createDataFrame(rows, "t string, o bigint")
    got = [r[0] for r in df.select(readers.topic_sequence(F.col("t").cast("timestamp"), F.col("o"))).collect()]
    assert got == sorted(got) and len(set(got)) == len(rows)
    assert [int(value) - int(got[0]) for value in got[:6]] == [offset - 7 for offset in offsets]


def test_topic_folders(spark, tmp_path):
    messages = spark.createDataFrame([("a", "1", "{}"), ("b", "2", "{}")], "topic string, key string, value string")
    write_topic_folders(messages, f"{tmp_path}/topics")
    assert spark.read.json(f"{tmp_path}/topics/topic=a").count() == 1
