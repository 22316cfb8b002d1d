"""Change events on the wire: JSON envelopes built, parsed, checked and routed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.functions.cleaners import strip
from changelake.functions.keys import JSON_OPTIONS, normalize_database, normalize_table_name, record_id
from changelake.session import small_methods

# The operations of the two kinds of event.
ROW_OPERATIONS = ("INSERT", "UPDATE", "DELETE")
SCHEMA_OPERATIONS = (
    "ADD_TABLE",
    "DROP_TABLE",
    "RENAME_TABLE",
    "ADD_COLUMN",
    "DROP_COLUMN",
    "RENAME_COLUMN",
)
SCHEMA_FIELDS = (
    "old_table",
    "new_table",
    "column",
    "old_column",
    "new_column",
    "data_type",
    "default",
)
_MALFORMED = "_malformed"
ROW_ID_FIELD = "row_id"
_FIELDS = ("operation", "table", "database", "source", "timestamp", ROW_ID_FIELD, "data", "columns")
WIRE_SCHEMA = ", ".join(f"`{f}` string" for f in (*_FIELDS, *SCHEMA_FIELDS, _MALFORMED))


def build_envelope(
    changes: DataFrame,
    data: Sequence[str],
    operation: Column,
    table: Column,
    database: Column,
    source: Column,
    timestamp: Column,
) -> DataFrame:
    """Add `value`, the JSON envelope; what JSON cannot hold is written as text."""
    envelope = F.struct(
        operation.alias("operation"),
        table.alias("table"),
        database.alias("database"),
        source.alias("source"),
        F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.struct(*[F.col(c) for c in data]).alias("data"),
    )
    return changes.withColumn("value", F.to_json(envelope, JSON_OPTIONS))


def route(operation: Column) -> Column:
    return (
        F.when(operation.isin(*SCHEMA_OPERATIONS), "schema")
        .when(operation == "INITIAL_LOAD", "initial_load")
        .when(operation.isin(*ROW_OPERATIONS), "change")
        .otherwise("other")
    )


def _blank(column: Column) -> Column:
    return F.coalesce(strip(column), F.lit("")) == ""


def _fault() -> Column:
    """Why an event cannot be applied; null for a good one."""
    operation = F.col("operation")
    no_table = _blank(F.col("table")) & (operation != "RENAME_TABLE")
    half_rename = (operation == "RENAME_TABLE") & (
        _blank(F.col("old_table")) | _blank(F.col("new_table"))
    )
    no_column = operation.isin("ADD_COLUMN", "DROP_COLUMN") & _blank(F.col("column"))
    half_column = (operation == "RENAME_COLUMN") & (
        _blank(F.col("old_column")) | _blank(F.col("new_column"))
    )
    return (
        F.when(F.col(_MALFORMED).isNotNull(), "malformed")
        .when(F.col("route") == "other", "unknown operation")
        .when(_blank(F.col("database")), "no database")
        .when(no_table | half_rename, "no table")
        .when(no_column | half_column, "no column")
        .when((F.col("route") != "schema") & F.col("data").isNull(), "no data")
        .when(F.size(F.array_distinct(F.map_keys("data"))) < F.size(F.map_keys("data")), "repeated name")
    )


def _schema_field(name: str) -> Column:
    field = F.col(f"_e.{name}")
    return (normalize_table_name(field) if name.endswith("_table") else field).alias(name)


def parse_envelope(raw: DataFrame, value: str = "value") -> DataFrame:
    """Typed events from JSON text, with `route`, `table_key` and `fault`.

    `data` may be a JSON object or the text of one; either becomes a map. The
    other columns of `raw`, such as the sequence number, are kept.
    """
    small_methods(raw.sparkSession)
    parsed = F.from_json(
        F.coalesce(value, F.lit("")),
        WIRE_SCHEMA,
        {"columnNameOfCorruptRecord": _MALFORMED, "mode": "PERMISSIVE"},
    )
    # Generators, unlike plain columns, are not copied into each later use and filter,
    # so each text is parsed once.
    fields = raw.select("*", F.inline(F.array(F.struct(parsed.alias("_e")))))
    data = F.from_json("_e.data", "map<string,string>")
    events = fields.select("*", F.inline(F.array(F.struct(data.alias("data"))))).select(
        *raw.columns,
        F.upper(strip("_e.operation")).alias("operation"),
        normalize_database(F.col("_e.database")).alias("database"),
        normalize_table_name(F.col("_e.table")).alias("table"),
        F.col("_e.source").alias("source"),
        F.col("_e.timestamp").alias("timestamp"),
        F.col(f"_e.{ROW_ID_FIELD}").alias(ROW_ID_FIELD),
        "data",
        F.col("_e.columns").alias("columns"),
        *[_schema_field(f) for f in SCHEMA_FIELDS],
        F.when(F.col("_e").isNull(), value).otherwise(F.col(f"_e.{_MALFORMED}")).alias(_MALFORMED),
    )
    events = events.withColumn("route", route(F.coalesce("operation", F.lit(""))))
    events = events.withColumn("fault", _fault()).drop(_MALFORMED)
    return events.withColumn("table_key", F.concat_ws(".", "database", "table"))


def split_valid(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good events, and the quarantine with the fault of each."""
    return events.filter("fault IS NULL").drop("fault"), events.filter("fault IS NOT NULL")


def event_identity(data: Column, table_key: Column, key: str | Mapping[str, str]) -> Column:
    """Key value of an event, or the MD5 of its whole data.

    `key` names the key column, for all tables or by `table_key`.
    """
    if isinstance(key, str):
        value = data[key]
    else:
        # One literal however many tables there are.
        pairs = [F.lit(text) for pair in key.items() for text in pair]
        value = data[F.create_map(*pairs)[table_key]] if pairs else F.lit(None).cast("string")
    ordered = F.to_json(F.array_sort(F.map_entries(data)))
    return F.coalesce(F.when(strip(value) != "", value), F.md5(ordered))


def identify(events: DataFrame, key: str | Mapping[str, str]) -> DataFrame:
    """Add `row_key`, and `record_id` as text for readers.

    A message of a poll carries the id of its row, which stays the same however the key
    is written or renamed, and whether the message has the whole row or not. Only a
    message of another producer is identified by its data. `record_id` joins database,
    table and `row_key` by `_`, which names may hold too: rows are told apart by
    `table_key` and `row_key`.
    """
    identity = event_identity(F.col("data"), F.col("table_key"), key)
    if ROW_ID_FIELD in events.columns:
        identity = F.coalesce(ROW_ID_FIELD, identity)
    return events.withColumn("row_key", identity).withColumn(
        "record_id", record_id(F.col("database"), F.col("table"), F.col("row_key"))
    )


def flatten(
    events: DataFrame, columns: Sequence[str], keep: Sequence[str] = (), processed_at: Column | None = None
) -> DataFrame:
    """Bronze rows: the five event columns and the named data columns, as text.

    `processed_at`, such as `current_timestamp()`, adds the time of processing as ISO text.
    """
    time = [] if processed_at is None else [F.date_format(processed_at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("_processed_at")]
    return events.select(
        *keep,
        F.col("database").alias("_source_database"),
        F.col("table").alias("_source_table"),
        F.col("source").alias("_source_type"),
        F.col("operation").alias("_operation"),
        F.col("record_id").alias("_record_id"),
        *time,
        *[F.col("data")[c].alias(c) for c in columns],
    )


def row_topic(database: Column, table: Column) -> Column:
    return F.concat(database, F.lit("-"), table, F.lit("-topic"))


def schema_topic(source: Column, database: Column) -> Column:
    known = F.lower(F.coalesce(source, F.lit("postgresql"))).isin("postgresql", "mssql")
    return F.when(known, F.concat(database, F.lit("-ddl-topic"))).otherwise("unknown-ddl-topic")
