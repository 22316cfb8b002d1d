"""One poll of a source: what changed since the last one, as messages.

The caller keeps the snapshots and decides when to poll.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from changelake.functions.keys import JSON_OPTIONS
from changelake.operators.diff import ROW_ID, identified, snapshot_diff
from changelake.operators.drift import EVENT_FIELDS, added_table_columns, ddl_diff
from changelake.operators.envelope import ROW_ID_FIELD, row_topic, schema_topic
from changelake.operators.evolve import apply_schema_events

_TIME = "yyyy-MM-dd'T'HH:mm:ss"


def _message(operation: Column, data: Column, table: str, database: str, source: str, at: Column) -> Column:
    envelope = F.struct(
        operation.alias("operation"),
        F.lit(table).alias("table"),
        F.lit(database).alias("database"),
        F.lit(source).alias("source"),
        F.date_format(at, _TIME).alias("timestamp"),
        F.col(ROW_ID).alias(ROW_ID_FIELD),
        data.alias("data"),
    )
    return F.to_json(envelope)


def load_messages(
    snapshot: DataFrame,
    key: str | None,
    table: str,
    database: str,
    source: str,
    at: Column,
    order: Sequence[str] = (),
    unique: bool = False,
) -> DataFrame:
    """`topic, key, value` of each row of a first snapshot."""
    data = F.to_json(F.struct(*snapshot.columns), JSON_OPTIONS)
    value = _message(F.lit("INITIAL_LOAD"), data, table, database, source, at)
    topic = row_topic(F.lit(database), F.lit(table))
    return identified(snapshot, key, order, unique).select(
        topic.alias("topic"), F.col(ROW_ID).alias("key"), value.alias("value")
    )


def row_messages(
    prev: DataFrame,
    cur: DataFrame,
    key: str | None,
    table: str,
    database: str,
    source: str,
    at: Column,
    order: Sequence[str] = (),
    unique: bool = False,
) -> DataFrame:
    """`topic, key, value` of each row that changed; a delete carries the key alone.

    `unique` says that the source declares the key, so that no id repeats.
    """
    return change_messages(snapshot_diff(prev, cur, key, order, unique), key, table, database, source, at)


def change_messages(changes: DataFrame, key: str | None, table: str, database: str, source: str, at: Column) -> DataFrame:
    """`topic, key, value` of changes (`_row_id`, `operation`, `after`)."""
    gone = F.to_json(F.struct(F.col(ROW_ID).alias(key or ROW_ID)))
    data = F.when(F.col("operation") == "DELETE", gone).otherwise(
        F.to_json("after", JSON_OPTIONS)
    )
    value = _message(F.col("operation"), data, table, database, source, at)
    topic = row_topic(F.lit(database), F.lit(table))
    return changes.select(topic.alias("topic"), F.col(ROW_ID).alias("key"), value.alias("value"))


def schema_messages(
    old: DataFrame, new: DataFrame, database: str, source: str, at: Column, match_default: bool = True
) -> DataFrame:
    """`topic, key, value` of each schema event; the key is the table it is about.

    An added table's message carries its columns, name to type.
    """
    fields = [F.col(f) for f in EVENT_FIELDS]
    columns = added_table_columns(old, new).groupBy("table_full").agg(
        F.map_from_entries(F.collect_list(F.struct("column", "data_type"))).alias("columns")
    )
    events = ddl_diff(old, new, match_default)
    events = events.join(columns, (F.col("operation") == "ADD_TABLE") & (F.col("table") == F.col("table_full")), "left")
    envelope = F.struct(
        F.lit(database).alias("database"),
        F.lit(source).alias("source"),
        F.date_format(at, _TIME).alias("timestamp"),
        *fields,
        "columns",
    )
    return events.select(
        schema_topic(F.lit(source), F.lit(database)).alias("topic"),
        F.coalesce("table", "old_table").alias("key"),
        F.to_json(envelope).alias("value"),
    )


@dataclass(frozen=True)
class Polled:
    """A table to poll: how to read it now, and what the last poll read, if there was one.

    One that is not `enabled` is left alone until it is again.
    """

    read: Callable[[], DataFrame]
    key: str | None = None
    unique: bool = False
    order: Sequence[str] = ()
    last: DataFrame | None = None
    enabled: bool = True


def column_events(schema_events: DataFrame, tables: Mapping[str, Polled]) -> dict[str, list[dict]]:
    """Column events of the polled tables between two polls."""
    wanted = schema_events.filter(F.col("operation").endswith("_COLUMN") & F.col("table").isin(*tables))
    events: dict[str, list[dict]] = {}
    for row in wanted.orderBy("table", "operation", "column", "old_column").collect():
        events.setdefault(row.table, []).append(row.asDict())
    return events


def poll_tables(
    tables: Mapping[str, Polled],
    schema_events: DataFrame,
    database: str,
    source: str,
    at: Column,
) -> tuple[DataFrame | None, dict[str, DataFrame], dict[str, str]]:
    """Messages of all tables, the snapshots to keep for the next poll, and why tables failed.

    `schema_events` of this poll are applied to a table's last snapshot first, so a renamed
    column is compared under its new name, and a key column too. A table that cannot be
    analysed fails alone; its last snapshot stays for the next poll. A table without a last
    snapshot is loaded whole.

    Snapshots are plans here: the messages read the source, and so does what the caller keeps. That
    is right for sources that don't change meanwhile, such as files; of others,
    `changelake.plans.kept` stores what it reads once, and survives failing tasks of a table.
    """
    events = column_events(schema_events, tables)
    messages, kept, failed = [], {}, {}
    for name, table in tables.items():
        if not table.enabled:
            if table.last is not None:
                kept[name] = table.last
            continue
        try:
            now = table.read()
        except AnalysisException as error:
            failed[name] = error.getCondition() or "UNREADABLE"
            if table.last is not None:
                kept[name] = table.last
            continue
        kept[name] = now
        common = (table.key, name, database, source, at, table.order, table.unique)
        if table.last is None:
            messages.append(load_messages(now, *common))
        else:
            messages.append(row_messages(apply_schema_events(table.last, events.get(name, ())), now, *common))
    return (reduce(DataFrame.unionByName, messages) if messages else None), kept, failed
