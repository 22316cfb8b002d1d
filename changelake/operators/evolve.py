"""Schema events applied to tables, and to a log of rows of many tables."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changelake.session import scratch_dir

SUFFIX = "_deleted"

# Type names of the source databases and the types they become.
SOURCE_TYPES = {
    "smallint": "smallint",
    "int": "int",
    "integer": "int",
    "bigint": "bigint",
    "real": "float",
    "float": "double",
    "double precision": "double",
    "boolean": "boolean",
    "bit": "boolean",
    "date": "date",
    "timestamp without time zone": "timestamp_ntz",
    "datetime": "timestamp_ntz",
    "datetime2": "timestamp_ntz",
}
_LITERAL = re.compile(r"(?:'(?P<text>(?:[^']|'')*)'(?:::[\w \[\]]+)?|(?P<bare>[+-]?\d+(?:\.\d+)?|true|false))", re.I)


def literal_default(default: str | None) -> str | None:
    """Value of a default that is a plain literal; other expressions give null."""
    found = _LITERAL.fullmatch(default.strip()) if default else None
    if not found:
        return None
    text = found["text"]
    return found["bare"] if text is None else text.replace("''", "'")


def apply_schema_events(df: DataFrame, events: Iterable[Mapping[str, str | None]]) -> DataFrame:
    """One table after its column events, in order; only the plan changes.

    A dropped column stays under a `_deleted` name. A rename or a drop takes
    the place of a column that already has the new name.
    """
    for event in events:
        operation = event["operation"]
        if operation == "ADD_COLUMN":
            if event["column"] not in df.columns:
                kind = SOURCE_TYPES.get((event.get("data_type") or "").lower(), "string")
                value = F.lit(literal_default(event.get("default"))).cast("string").try_cast(kind)
                df = df.withColumn(event["column"], value)
        elif operation in ("RENAME_COLUMN", "DROP_COLUMN"):
            old = event["old_column"] if operation == "RENAME_COLUMN" else event["column"]
            new = event["new_column"] if operation == "RENAME_COLUMN" else f"{old}{SUFFIX}"
            if old in df.columns and old != new:
                df = df.drop(new).withColumnRenamed(old, new)
    return df


def empty_table(spark, columns: Iterable[Mapping[str, str]]) -> DataFrame:
    """The table that `ADD_TABLE` registers: its columns, and no rows."""
    fields = [
        f"`{c['column']}` {SOURCE_TYPES.get(c['data_type'].lower(), 'string')}" for c in columns
    ]
    return spark.createDataFrame([], ", ".join(fields))


_OLDEST = -(2**63)
_QUOTED = r"(?i)^'((?:[^']|'')*)'(?:::[\w \[\]]+)?$"
_BARE = r"(?i)^([+-]?\d+(?:\.\d+)?|true|false)$"


def _literal(default: Column) -> Column:
    """`literal_default` of a column."""
    text = F.trim(default)
    quoted = F.regexp_replace(F.regexp_extract(text, _QUOTED, 1), "''", "'")
    return F.when(text.rlike(_QUOTED), quoted).when(text.rlike(_BARE), text)


def _kept(df: DataFrame, purpose: str) -> DataFrame:
    folder = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _followed(steps: DataFrame, arrivals: DataFrame) -> DataFrame:
    """`arrivals` with `final`: what the name they arrive at is called after all later steps.

    A step says that at `seq` what is called `name` in its `scope` becomes `to`; null is the
    end. An arrival is an `id` with `scope`, `to` and `seq`; those of steps have their ids.
    The step after an arrival is found by a window over the events of one name; chains of
    steps are then followed by doubling, so the rounds grow with the logarithm of the
    longest chain. Rounds are stored, for each refers to the last one twice.
    """
    there = arrivals.filter("`to` IS NOT NULL")
    marks = steps.select("scope", "name", "seq", F.lit(1).alias("kind"), F.col("id").alias("step"))
    none = F.lit(None).cast("string")
    marks = marks.unionByName(
        there.select("scope", F.col("to").alias("name"), "seq", F.lit(0).alias("kind"), none.alias("step"), "id"),
        allowMissingColumns=True,
    )
    later = Window.partitionBy("scope", "name").orderBy(F.desc("seq"), "kind").rowsBetween(Window.unboundedPreceding, -1)
    found = marks.withColumn("next", F.last("step", ignorenulls=True).over(later)).filter("kind = 0").select("id", "next")
    chain = arrivals.join(found, "id", "left").select("id", F.col("to").alias("final"), "next")
    while True:
        chain = _kept(chain, "chains")
        if chain.filter("next IS NOT NULL").isEmpty():
            return chain.select("id", "final")
        onward = chain.select(F.col("id").alias("next"), F.col("final").alias("end"), F.col("next").alias("after"))
        joined = chain.join(onward, "next", "left")
        chain = joined.select("id", F.when(F.col("next").isNull(), F.col("final")).otherwise(F.col("end")).alias("final"), F.col("after").alias("next"))


def _rules(steps: DataFrame, final: DataFrame, *by: str) -> DataFrame:
    step = F.struct(F.col("seq").alias("until"), F.col("final").alias("name"))
    return steps.join(final, "id").groupBy(*by).agg(F.sort_array(F.collect_list(step)).alias("steps"))


def table_rules(events: DataFrame) -> DataFrame:
    """`table_key, tables`: what each table name of the past became, by the event that changed it."""
    events = events.filter(F.col("operation").isin("RENAME_TABLE", "DROP_TABLE"))
    old = F.when(F.col("operation") == "RENAME_TABLE", F.col("old_table")).otherwise(F.col("table"))
    new = F.when(F.col("operation") == "RENAME_TABLE", F.col("new_table")).otherwise(F.concat("table", F.lit(SUFFIX)))
    steps = events.select(
        F.col("database").alias("scope"),
        F.concat_ws(".", "database", old).alias("name"),
        F.concat_ws(".", "database", new).alias("to"),
        "seq",
    ).filter("name <> `to`")
    steps = _kept(steps.withColumn("id", F.concat_ws(" ", "seq", "name")), "steps")
    return _rules(steps, _followed(steps, steps), "name").select(F.col("name").alias("table_key"), F.col("steps").alias("tables"))


def _column_rules(events: DataFrame) -> DataFrame:
    """`table_key, names, defaults` from column events under the present names of their tables."""
    operation = F.col("operation")
    moves = events.filter(operation.isin("RENAME_COLUMN", "DROP_COLUMN"))
    old = F.when(operation == "RENAME_COLUMN", F.col("old_column")).otherwise(F.col("column"))
    new = F.when(operation == "RENAME_COLUMN", F.col("new_column")).otherwise(F.concat("column", F.lit(SUFFIX)))
    moves = moves.select(F.col("table_key").alias("scope"), old.alias("name"), new.alias("to"), "seq").filter("name <> `to`")
    # What already has the new name ends there.
    ends = moves.select("scope", F.col("to").alias("name"), F.lit(None).cast("string").alias("to"), "seq")
    steps = moves.unionByName(ends).withColumn("id", F.concat_ws(" ", "seq", F.col("to").isNull().cast("string"), "scope", "name"))
    added = events.filter(operation == "ADD_COLUMN").select(
        F.col("table_key").alias("scope"), F.col("column").alias("to"), "seq", _literal(F.col("default")).alias("value")
    ).filter("value IS NOT NULL").withColumn("id", F.concat_ws(" ", "seq", F.lit("add"), "scope", "to"))
    steps, added = _kept(steps, "steps"), _kept(added, "added")
    final = _followed(steps, steps.unionByName(added.drop("value"), allowMissingColumns=True))
    names = _rules(steps, final, "scope", "name").groupBy(F.col("scope").alias("table_key")).agg(
        F.map_from_entries(F.collect_list(F.struct("name", "steps"))).alias("names")
    )
    earlier = Window.partitionBy("scope", "final").orderBy("seq")
    since = F.coalesce(F.lag("seq").over(earlier), F.lit(_OLDEST).cast(events.schema["seq"].dataType))
    defaults = added.join(final, "id").filter("final IS NOT NULL").select(
        F.col("scope").alias("table_key"),
        F.struct(since.alias("since"), F.col("seq").alias("until"), F.col("final").alias("name"), "value").alias("default"),
    )
    defaults = defaults.groupBy("table_key").agg(F.sort_array(F.collect_list("default")).alias("defaults"))
    kind = events.schema["seq"].dataType.simpleString()
    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast(f"array<array<struct<until: {kind}, name: string>>>"))
    none = F.array().cast(f"array<struct<since: {kind}, until: {kind}, name: string, value: string>>")
    return names.join(defaults, "table_key", "full_outer").select(
        "table_key", F.coalesce("names", empty).alias("names"), F.coalesce("defaults", none).alias("defaults")
    )


def _first_after(steps: Column, seq: Column) -> Column:
    return F.get(F.filter(steps, lambda s: s["until"] > seq), F.lit(0))


def _resolve_tables(df: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows and events under the present name of their table."""
    name = _first_after(F.col("tables"), F.col("seq"))["name"]
    return (
        df.join(rules, "table_key", "left")
        .withColumn("table_key", F.coalesce(name, "table_key"))
        .drop("tables")
    )


def _epochs(tables: DataFrame, rules: DataFrame, kind: str) -> DataFrame:
    """Rules of each table name of the past, by the span of `seq` in which it meant one present table.

    `_since <= seq < _until`; a null end is open. Spans of a name don't overlap.
    """
    oldest = F.lit(_OLDEST).cast(kind)
    steps = tables.select("table_key", "tables", F.posexplode("tables").alias("at", "step"))
    since = F.when(F.col("at") == 0, oldest).otherwise(F.get("tables", F.col("at") - 1)["until"])
    past = steps.select("table_key", since.alias("_since"), F.col("step.until").alias("_until"), F.col("step.name").alias("_final"))
    named = tables.select("table_key", F.element_at("tables", -1)["until"].alias("_since")).unionByName(
        rules.join(tables, "table_key", "left_anti").select("table_key", oldest.alias("_since"))
    )
    spans = past.unionByName(named.select("table_key", "_since", F.lit(None).cast(kind).alias("_until"), F.col("table_key").alias("_final")))
    found = rules.select(F.col("table_key").alias("_final"), F.col("names").alias("_names"), F.col("defaults").alias("_defaults"))
    return spans.join(found, "_final", "left").filter("_final <> table_key OR _names IS NOT NULL")


#: Steps and defaults of rules that are sent to all tasks, at some hundred bytes each.
MOST_SENT = 100_000
#: Parts of each table where rules are more than that.
SALTS = 64


def _ruled(log: DataFrame, epochs: DataFrame) -> DataFrame:
    """Rows with the rules of their span, in one join.

    Rules of `MOST_SENT` steps at most are broadcast. More of them meet the log by table and
    one of `SALTS` parts of it, in each of which they are repeated, so that a table with most
    of the log is no single key.
    """
    held = F.aggregate(F.map_values("_names"), F.lit(1), lambda total, steps: total + F.size(steps))
    steps = epochs.agg(F.sum(F.coalesce(held, F.lit(1)) + F.coalesce(F.size("_defaults"), F.lit(0)))).first()[0] or 0
    span = (F.col("seq") >= F.col("_since")) & (F.col("_until").isNull() | (F.col("seq") < F.col("_until")))
    epochs = epochs.withColumnRenamed("table_key", "_name")
    if steps <= MOST_SENT:
        return log.join(F.broadcast(epochs), (F.col("table_key") == F.col("_name")) & span, "left")
    parted = epochs.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = log.withColumn("_salt", F.pmod(F.xxhash64("seq"), F.lit(SALTS)).cast("int"))
    return salted.join(parted, (F.col("table_key") == F.col("_name")) & (F.col("_salt") == F.col("_part")) & span, "left")


def evolve_log(
    log: DataFrame, events: DataFrame, tables: DataFrame | None = None, stored: bool = True
) -> DataFrame:
    """Rows of a log (`table_key, seq, data`) in the present schema of their table.

    A row takes part in the schema events after its own `seq`; no two schema events of a
    table share one. Chains of renames are followed once, on the events alone, and become one
    row of rules for each span of `seq` in which a table name meant one table. Rows after the
    last of all events are only passed on; the others are looked up by name and span in one
    join, which shuffles the log only where the rules are too many to send (`_ruled`). The log
    is read in these two parts, and files are skipped by their `seq`; without `stored`, for a
    log that is computed, all rows take part in the join, so that it is computed once. Rows without a `seq` stay as they are. `tables` are the `table_rules`, if they are known.
    """
    last = events.agg(F.max("seq")).first()[0]
    if last is None:
        return log
    events = events.withColumn("table_key", F.concat_ws(".", "database", "table"))
    tables = table_rules(events) if tables is None else tables
    columns = _resolve_tables(
        events.filter(F.col("operation").isin("ADD_COLUMN", "RENAME_COLUMN", "DROP_COLUMN")), tables
    )
    kind = events.schema["seq"].dataType
    epochs = _kept(_epochs(tables, _column_rules(columns), kind.simpleString()), "epochs")
    seq, data = F.col("seq"), F.col("data")

    def renamed(name: Column) -> Column:
        step = _first_after(F.col("_names")[name], seq)
        return F.when(step.isNull(), name).otherwise(step["name"])

    entries = F.transform(
        F.map_entries(data), lambda e: F.struct(renamed(e["key"]).alias("key"), e["value"].alias("value"))
    )
    present = F.map_from_entries(F.filter(entries, lambda e: e["key"].isNotNull()))
    missing = F.filter(
        F.col("_defaults"), lambda d: seq.between(d["since"], d["until"] - 1) & ~F.map_contains_key(present, d["name"])
    )
    added = F.map_from_entries(
        F.transform(missing, lambda d: F.struct(d["name"].alias("key"), d["value"].alias("value")))
    )
    whole = F.when(F.size(missing) > 0, F.map_concat(present, added)).otherwise(present)
    bound = F.lit(last).cast(kind)
    early = _ruled(log.filter(seq <= bound) if stored else log, epochs)
    changed = {
        "table_key": F.coalesce("_final", "table_key"),
        "data": F.when(F.col("_names").isNull(), data).otherwise(whole),
    }
    early = early.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in log.columns])
    return early.unionByName(log.filter((seq > bound) | seq.isNull())) if stored else early
