"""Inputs dealt to all cores: batches that are ranges of a table, topics and feeds of streams."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from changelake.plans import feeds, queries
from changelake.streaming.state import fold_partly


@pytest.fixture
def folder(spark, tmp_path):
    """Events in nine files, each from all days."""
    days = F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 2500).cast("timestamp_ntz")
    spark.range(900).repartition(9, "id").select(
        F.col("id").alias("event_id"),
        days.alias("ts"),
        (F.col("id") % 7).alias("user_id"),
        F.element_at(F.array(*map(F.lit, ("signup", "view", "click", "error"))), (F.col("id") * 5 % 4 + 1).cast("int")).alias("event_type"),
        (F.col("id") / 4).alias("value"),
        F.lit('{"k": 3}').alias("props"),
    ).write.parquet(f"{tmp_path}/events.parquet")
    return tmp_path


def test_the_rows_of_a_batch_are_parsed_by_all_cores(spark, folder):
    feed = feeds.change_feed(spark, str(folder)).coalesce(1)
    events = queries._messages(feed, "batch_id")
    assert events.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    assert events.count() == 900


def test_a_topic_is_written_by_all_cores(spark):
    written = Path(queries._topic(spark, spark.range(1000).select(F.col("id").alias("seq"), F.lit("{}").alias("value"))))
    assert len(list(written.glob("part-*"))) >= spark.sparkContext.defaultParallelism


def test_micro_batches_do_not_grow_with_the_files_of_the_feed(spark, folder, monkeypatch):
    monkeypatch.setattr(queries, "scratch_dir", lambda _, purpose: f"{folder}/{purpose}")
    found = queries.stream_state_tws(spark, str(folder)).collect()
    assert len(list((folder / "state").glob("batch_id=*"))) <= 4
    assert sorted(row.user_id for row in found) == list(range(7))


def test_a_key_costs_a_row_per_task_not_per_batch(spark, folder):
    feed = feeds.change_feed(spark, str(folder)).coalesce(2)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, 10)
    try:
        folded = fold_partly(feed, ["user_id"], "seq", ["value", "event_type"])
        assert folded.groupBy("user_id").count().agg(F.max("count")).first()[0] <= 2
    finally:
        spark.conf.set(name, before)
