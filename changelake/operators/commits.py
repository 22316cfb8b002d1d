"""What each batch did to each table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changelake.operators.scan import prefix_scan

GROUP = ("table_key", "batch_id")


def batch_summary(events: DataFrame, op: str = "operation") -> DataFrame:
    """Events received per table and batch; an initial load counts as inserts."""
    operation = F.col(op)
    loads = F.count_if(operation == "INITIAL_LOAD")
    total = F.count("*")
    return events.groupBy(*GROUP).agg(
        F.when(loads == total, "batch").otherwise("stream").alias("commit_type"),
        F.when(loads == total, "batch")
        .when(F.min(operation) == F.max(operation), F.lower(F.min(operation)))
        .otherwise("mixed")
        .alias("operation"),
        total.alias("total"),
        F.count_if(operation.isin("INSERT", "INITIAL_LOAD")).alias("inserts"),
        F.count_if(operation == "UPDATE").alias("updates"),
        F.count_if(operation == "DELETE").alias("deletes"),
    )


def effective_counts(log: DataFrame, op: str = "operation") -> DataFrame:
    """New rows, and deletes that met a row, per table and batch of a change log."""
    before, after = F.col("before"), F.col("after")
    return log.groupBy(*GROUP).agg(
        F.count_if(before.isNull() & after.isNotNull()).alias("new_rows"),
        F.count_if((F.col(op) == "DELETE") & before.isNotNull()).alias("effective_deletes"),
    )


def new_rows(events: DataFrame, key: Sequence[str], op: str = "operation") -> DataFrame:
    """Rows that came into being per table and batch, without a change log."""
    born = events.filter(F.col(op) != "DELETE").groupBy("table_key", *key).agg(
        F.min("batch_id").alias("batch_id")
    )
    return born.groupBy(*GROUP).agg(F.count("*").alias("new_rows"))


def running_totals(summary: DataFrame, births: DataFrame) -> DataFrame:
    """Summary with `total_records`, the rows of the table after each batch."""
    rows = summary.join(births, list(GROUP), "left").withColumn(
        "new_rows", F.coalesce("new_rows", F.lit(0))
    )
    scanned = prefix_scan(rows, ["table_key"], "batch_id", {"new_rows": "sum"}, levels=1)
    return scanned.withColumn("total_records", F.col("new_rows_after")).drop(
        "new_rows_before", "new_rows_after"
    )


def carried_totals(counts: DataFrame, heads: DataFrame) -> DataFrame:
    """Counts per table and batch with `total_records` and `schema_id` after each batch.

    `total_records` are the table's rows, `schema_id` counts its schema events. `counts` has
    `new_rows` and `schema_events`, null for none; `heads` has one row per table, both values
    after the last batch before these (`heads_after`). So only the batches at hand are scanned.
    """
    before = heads.select("table_key", F.col("total_records").alias("_records"), F.col("schema_id").alias("_schema"))
    scan = Window.partitionBy("table_key").orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)

    def running(start: str, column: str) -> Column:
        return F.coalesce(start, F.lit(0)) + F.coalesce(F.sum(column).over(scan), F.lit(0))

    totals = counts.join(before, "table_key", "left").withColumns(
        {"total_records": running("_records", "new_rows"), "schema_id": running("_schema", "schema_events")}
    )
    return totals.drop("_records", "_schema")


def heads_after(totals: DataFrame, heads: DataFrame) -> DataFrame:
    """One row per table with its `total_records` and `schema_id` after `totals`; others keep theirs."""
    names = ("total_records", "schema_id")
    last = totals.groupBy("table_key").agg(F.max_by(F.struct(*names), "batch_id").alias("last"))
    both = heads.join(last, "table_key", "full_outer")
    return both.select("table_key", *[F.coalesce(f"last.{name}", name).alias(name) for name in names])


def schema_changes(events: DataFrame) -> DataFrame:
    """Batches that brought data columns a table did not have before."""
    columns = events.select(*GROUP, F.explode(F.map_keys("data")).alias("column"))
    first = columns.groupBy("table_key", "column").agg(F.min("batch_id").alias("batch_id"))
    return first.groupBy(*GROUP).agg(F.count("*").alias("new_columns"))


def commit_latest(commits: DataFrame) -> DataFrame:
    """The last commit of each table."""
    rest = [c for c in commits.columns if c not in GROUP]
    last = commits.groupBy("table_key").agg(F.max(F.struct("batch_id", *rest)).alias("_last"))
    return last.select("table_key", "_last.*")
