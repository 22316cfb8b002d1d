"""Every operator as a query over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.functions import (
    clean_code,
    clean_date,
    clean_number,
    clean_whitespace,
    normalize_database,
    normalize_table_name,
    record_id,
    row_id,
    stringify,
)
from changelake.functions.keys import JSON_OPTIONS
from changelake.operators import commits, conform, diff, drift, envelope, evolve, fold
from changelake.plans import feeds, kept, poll, silver
from changelake.session import scratch_dir
from changelake.sources import readers
from changelake.sources.bronze import Bronze
from changelake.streaming.apply import latest_state, start_apply_stream, start_state_stream
from changelake.streaming.state import aggregate_state, processor_state, start_processor_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings"
    " pages benchmark labels conversations"
).split()
USER = ["user_id"]
IMAGE = ["value", "event_type"]


def query(run: Query) -> Query:
    QUERIES[run.__name__.rstrip("_")] = run
    return run


# Sources


@query
def catalog_tables(spark, sf_dir):
    return readers.base_tables(feeds.information_schema(spark, sf_dir)[0])


@query
def catalog_columns(spark, sf_dir):
    tables, columns = feeds.information_schema(spark, sf_dir)
    return readers.catalog_from_columns(columns, tables)


@query
def snapshot_scan(spark, sf_dir):
    found, _ = readers.read_sources(spark, {"orders": f"{sf_dir}/orders.parquet"})
    return found["orders"]


@query
def silver_sources(spark, sf_dir):
    names = ("customer", "supplier", "missing")
    found, failed = readers.read_sources(spark, {n: f"{sf_dir}/{n}.parquet" for n in names})
    counts = [
        df.agg(F.count("*").alias("n_rows")).select(F.lit(n).alias("source"), F.lit("ok").alias("status"), "n_rows")
        for n, df in found.items()
    ]
    absent = spark.createDataFrame(list(failed.items()), "source string, status string")
    out = absent.withColumn("n_rows", F.lit(None).cast("bigint"))
    for df in counts:
        out = out.unionByName(df)
    return out


@query
def row_counts(spark, sf_dir):
    out = None
    for name in TABLES:
        n = feeds.table(spark, sf_dir, name).agg(F.count("*").alias("n_rows"))
        n = n.select(F.lit(name).alias("table_name"), "n_rows")
        out = n if out is None else out.unionByName(n)
    return out


@query
def preview_top3(spark, sf_dir):
    return feeds.table(spark, sf_dir, "customer").orderBy(F.desc("c_acctbal"), "c_custkey").limit(3)


# Identity and text


@query
def row_id_(spark, sf_dir):
    blank = F.when(F.col("quality") == 1, F.col("doc_id"))
    labels = feeds.table(spark, sf_dir, "labels").withColumn("key", blank)
    return labels.select("doc_id", row_id(["doc_id", "quality", "toxic"], "key").alias("row_id"))


@query
def row_id_keyless(spark, sf_dir):
    lines = feeds.table(spark, sf_dir, "lineitem")
    ids = lines.select("l_orderkey", "l_linenumber", row_id(lines.columns).alias("row_id"))
    return ids.groupBy("l_orderkey", "l_linenumber").agg(F.count_distinct("row_id").alias("n_ids"))


def _named(spark, sf_dir):
    rows = feeds.envelope_rows(spark, sf_dir)
    return rows.select(
        "seq",
        "user_id",
        normalize_database(F.col("database")).alias("database"),
        normalize_table_name(F.col("table")).alias("table"),
    )


@query
def normalize_table_name_(spark, sf_dir):
    return _named(spark, sf_dir).select("seq", "database", "table")


@query
def record_id_(spark, sf_dir):
    identity = F.col("user_id").cast("string")
    return _named(spark, sf_dir).select(
        "seq", record_id(F.col("database"), F.col("table"), identity).alias("record_id")
    )


@query
def stringify_row(spark, sf_dir):
    events = feeds.table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        F.col("ts").cast("date").alias("day"),
        F.when(F.col("event_type") != "view", F.col("props")).alias("props"),
        F.struct("user_id", "event_type").alias("nested"),
        F.array("event_id", "user_id").alias("list"),
    )
    return stringify(events)


@query
def clean_number_(spark, sf_dir):
    text = F.when(F.col("l_returnflag") == "A", F.format_number("l_extendedprice", 2))
    text = text.when(F.col("l_returnflag") == "N", F.concat(F.lit(" "), F.floor("l_extendedprice").cast("string")))
    text = text.otherwise(F.concat(F.lit("-"), F.col("l_quantity").cast("int").cast("string")))
    lines = feeds.table(spark, sf_dir, "lineitem").withColumn("amount", text)
    return lines.select("l_orderkey", "l_linenumber", "amount", clean_number("amount").alias("cleaned"))


@query
def clean_date_(spark, sf_dir):
    orders = feeds.table(spark, sf_dir, "orders")
    orders = orders.withColumn("written", feeds.dirty_date(orders))
    return orders.select("o_orderkey", "written", clean_date("written").alias("cleaned"))


@query
def clean_whitespace_(spark, sf_dir):
    documents = feeds.table(spark, sf_dir, "documents")
    return documents.select("doc_id", clean_whitespace("text").alias("cleaned"))


@query
def clean_code_(spark, sf_dir):
    documents = feeds.table(spark, sf_dir, "documents")
    return documents.select("doc_id", clean_code("text").alias("cleaned"))


# Snapshots


def _images(changes: DataFrame, columns: list[str]) -> DataFrame:
    return changes.select(
        F.col("_row_id").alias("row_id"),
        "operation",
        *[F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in ("before", "after") for c in columns],
    )


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query
def snapshot_diff(spark, sf_dir):
    prev, cur = feeds.order_snapshots(spark, sf_dir)
    return _images(diff.snapshot_diff(prev, cur, "o_orderkey"), ORDER_COLUMNS)


@query
def snapshot_diff_narrow(spark, sf_dir):
    prev, cur = feeds.order_snapshots(spark, sf_dir)
    return _images(diff.snapshot_diff_narrow(prev, cur, "o_orderkey", scratch_dir(spark, "changed")), ORDER_COLUMNS)


@query
def snapshot_diff_wide(spark, sf_dir):
    prev, cur = feeds.wide_snapshots(spark, sf_dir)
    return _images(diff.snapshot_diff(prev, cur, "line"), cur.columns)


@query
def snapshot_diff_wide_narrow(spark, sf_dir):
    prev, cur = feeds.wide_snapshots(spark, sf_dir)
    return _images(diff.snapshot_diff_narrow(prev, cur, "line", scratch_dir(spark, "changed")), cur.columns)


@query
def snapshot_diff_kept(spark, sf_dir):
    old = feeds.first_poll(spark, sf_dir)
    _, cur = feeds.wide_snapshots(spark, sf_dir)
    new = replace(old, folder=scratch_dir(spark, "kept"), schema=cur.schema).write(cur)
    return _images(kept.snapshot_diff_kept(old, new, scratch_dir(spark, "changed")), cur.columns)


@query
def snapshot_diff_keyless(spark, sf_dir):
    prev, cur = feeds.line_snapshots(spark, sf_dir)
    out = diff.snapshot_diff(prev, cur)
    row = F.coalesce("after", "before")
    return out.select("operation", *[row[c].alias(c) for c in prev.columns])


@query
def snapshot_inserts(spark, sf_dir):
    prev, cur = feeds.order_snapshots(spark, sf_dir)
    return diff.snapshot_inserts(prev, cur, "o_orderkey").drop("_row_id")


@query
def snapshot_deletes(spark, sf_dir):
    prev, cur = feeds.order_snapshots(spark, sf_dir)
    return diff.snapshot_deletes(prev, cur, "o_orderkey").drop("_row_id")


@query
def snapshot_updates(spark, sf_dir):
    prev, cur = feeds.order_snapshots(spark, sf_dir)
    return diff.snapshot_updates(prev, cur, "o_orderkey").drop("_row_id")


@query
def snapshot_last_wins(spark, sf_dir):
    lines = feeds.table(spark, sf_dir, "lineitem")
    order = ["l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate"]
    return diff.last_wins(lines, ["l_orderkey", "l_linenumber"], order)


# Envelopes


@query
def envelope_build(spark, sf_dir):
    built = feeds.built_feed(spark, sf_dir).select("seq", "value")
    wire = "operation string, table string, database string, source string, timestamp string"
    parsed = F.from_json("value", f"{wire}, data map<string,string>")
    names = [part.split(" ")[0] for part in wire.split(", ")]
    return built.select("seq", F.inline(F.array(parsed))).select(
        "seq", *names, *[F.col("data")[c].alias(c) for c in feeds.DATA]
    )


def _parsed(spark, sf_dir) -> DataFrame:
    raw = feeds.raw_feed(spark, sf_dir)
    return envelope.identify(envelope.parse_envelope(raw), "user_id")


@query
def envelope_flatten(spark, sf_dir):
    good, _ = envelope.split_valid(_parsed(spark, sf_dir))
    return envelope.flatten(good.filter("route = 'change'"), feeds.DATA, ["seq"])


@query
def initial_load_flatten(spark, sf_dir):
    good, _ = envelope.split_valid(_parsed(spark, sf_dir))
    return envelope.flatten(good.filter("route = 'initial_load'"), feeds.DATA, ["seq"])


@query
def route_operations(spark, sf_dir):
    return _parsed(spark, sf_dir).select("seq", "operation", "route")


@query
def quarantine_rows(spark, sf_dir):
    _, bad = envelope.split_valid(_parsed(spark, sf_dir))
    return bad.select("seq", "fault")


@query
def route_topics(spark, sf_dir):
    good, _ = envelope.split_valid(_parsed(spark, sf_dir))
    return good.select("seq", envelope.row_topic(F.col("database"), F.col("table")).alias("topic"))


@query
def route_ddl_topics(spark, sf_dir):
    rows = feeds.envelope_rows(spark, sf_dir)
    database = normalize_database(F.col("database"))
    return rows.select("seq", envelope.schema_topic(F.col("source"), database).alias("topic"))


@query
def events_per_table(spark, sf_dir):
    good, _ = envelope.split_valid(_parsed(spark, sf_dir))
    return good.groupBy("table_key").agg(F.count("*").alias("n"))


# Polls


def _polled_at() -> Column:
    return F.lit("2024-02-01 08:30:00").cast("timestamp_ntz")


def _unwrapped(messages: DataFrame, row: DataFrame | None, *fields: str) -> DataFrame:
    """Fields of the messages, and the columns of `row` that their data hold, typed."""
    wire = F.from_json("value", ", ".join(f"`{f}` string" for f in (*fields, "data")))
    rows = messages.select("topic", "key", F.inline(F.array(wire)))
    if row is None:
        return rows.drop("data")
    typed = F.from_json("data", row.schema, JSON_OPTIONS)
    return rows.select("topic", "key", *fields, F.inline(F.array(typed)))


@query
def poll_row_messages(spark, sf_dir):
    prev, cur = feeds.order_snapshots(spark, sf_dir)
    out = poll.row_messages(prev, cur, "o_orderkey", "orders", "shop", "postgresql", _polled_at(), unique=True)
    return _unwrapped(out, cur.withColumn("o_orderkey", F.col("o_orderkey").cast("string")), "operation", "timestamp", "row_id")


@query
def poll_load_messages(spark, sf_dir):
    customers = feeds.table(spark, sf_dir, "customer")
    out = poll.load_messages(customers, "c_custkey", "customer", "shop", "mssql", _polled_at(), unique=True)
    return _unwrapped(out, customers, "operation", "source")


@query
def poll_schema_messages(spark, sf_dir):
    old, new = feeds.catalogs(spark, sf_dir)
    out = poll.schema_messages(old, new, "shop", "mssql", _polled_at(), match_default=False)
    return _unwrapped(out, None, "operation", "table", "old_table", "new_table", "column", "old_column", "new_column", "data_type", "default")


@query
def poll_tables(spark, sf_dir):
    tables, events = feeds.polled_tables(spark, sf_dir)
    out, _, failed = poll.poll_tables(tables, events, "shop", "mssql", _polled_at())
    wire = F.from_json("value", "operation string, data string")
    rows = out.select("topic", "key", F.inline(F.array(wire)))
    rows = rows.withColumn("data", F.from_json("data", "map<string,string>"))
    amount = F.coalesce(F.col("data")["balance"], F.col("data")["s_acctbal"], F.col("data")["p_retailprice"])
    rows = rows.select("topic", "key", "operation", amount.cast("double").alias("amount"), F.size("data").alias("n_columns"))
    for name, reason in failed.items():
        none = spark.range(1).select(F.lit(name).alias("topic"), F.lit(reason).alias("operation"))
        rows = rows.unionByName(none, allowMissingColumns=True)
    return rows


@query
def poll_stored(spark, sf_dir):
    """Each field of each message of a second poll on stored snapshots, and the tables that failed."""
    tables, events = feeds.polled_tables(spark, sf_dir)
    area = kept.Snapshots(spark, scratch_dir(spark, "snapshots"), int(spark.conf.get("spark.sql.shuffle.partitions")))
    before = {name: replace(table, read=lambda last=table.last: last) for name, table in tables.items() if table.last is not None}
    before["missing"] = tables["missing"]
    area.poll(before, events.limit(0), "shop", "mssql", _polled_at()).commit()
    found = area.poll(tables, events, "shop", "mssql", _polled_at())
    found.commit()
    wire = F.from_json("value", "operation string, data string")
    rows = found.messages.select("topic", "key", F.inline(F.array(wire)))
    fields = F.explode(F.from_json("data", "map<string,string>")).alias("column", "value")
    rows = rows.select("topic", "key", "operation", fields)
    number = F.col("value").try_cast("double")
    rows = rows.select("topic", "key", "operation", "column", F.when(number.isNull(), F.col("value")).alias("text"), number.alias("number"))
    failed = spark.createDataFrame(list(found.failed.items()), "topic string, operation string")
    return rows.unionByName(failed, allowMissingColumns=True)


def _polled_state(prev: DataFrame, cur: DataFrame, key: str | None, order: tuple[str, ...] = ()) -> DataFrame:
    """Rows that are live after a first load and one poll have gone through the messages."""
    source = (key, "t", "shop", "postgresql", _polled_at(), order)
    load = poll.load_messages(prev, *source).withColumn("seq", F.lit(1))
    changes = poll.row_messages(prev, cur, *source).withColumn("seq", F.lit(2))
    events = envelope.parse_envelope(load.unionByName(changes).select("seq", "value"))
    good, _ = envelope.split_valid(envelope.identify(events, key or "none"))
    state = fold.fold_state(good, ["table_key", "row_key"], "seq", ["data"]).filter("NOT deleted")
    return state.select(*[F.col("data")[f.name].cast(f.dataType).alias(f.name) for f in cur.schema.fields])


@query
def poll_to_state_keyless(spark, sf_dir):
    return _polled_state(*feeds.line_snapshots(spark, sf_dir), None)


@query
def poll_to_state_timestamp_key(spark, sf_dir):
    return _polled_state(*feeds.event_snapshots(spark, sf_dir), "ts", ("event_id",))


@query
def poll_to_state_null_key(spark, sf_dir):
    return _polled_state(*feeds.part_keyed_orders(spark, sf_dir), "okey")


# Change application


@query
def cdc_apply_state(spark, sf_dir):
    return fold.fold_state(feeds.change_feed(spark, sf_dir), USER, "seq", IMAGE)


@query
def initial_load_then_changes(spark, sf_dir):
    return fold.fold_state(feeds.load_feed(spark, sf_dir), USER, "seq", IMAGE)


@query
def bronze_compact(spark, sf_dir):
    feed = feeds.change_feed(spark, sf_dir)
    day = F.lit("2024-01-16").cast("timestamp_ntz")
    base = fold.compact(None, feed.filter(F.col("ts") < day), USER, "seq", IMAGE)
    folder = scratch_dir(spark, "base")
    base.write.parquet(folder)
    return fold.fold_state(
        feed.filter(F.col("ts") >= day), USER, "seq", IMAGE, base=spark.read.parquet(folder)
    )


def _log(spark, sf_dir) -> DataFrame:
    feed = feeds.change_feed(spark, sf_dir)
    return fold.change_log(feed, ["table_key", *USER], "seq", IMAGE, keep=["batch_id"])


@query
def cdc_change_log(spark, sf_dir):
    sides = [(side, c) for side in ("before", "after") for c in (*IMAGE, "deleted")]
    return _log(spark, sf_dir).select(
        "table_key",
        "user_id",
        "seq",
        "operation",
        *[F.col(f"{side}.{c}").alias(f"{side}_{c}") for side, c in sides],
    )


@query
def cdc_batch_summary(spark, sf_dir):
    return commits.batch_summary(feeds.load_feed(spark, sf_dir))


@query
def cdc_effective_counts(spark, sf_dir):
    return commits.effective_counts(_log(spark, sf_dir))


def _files(spark: SparkSession) -> int:
    """Parts to deal an input out to: an even number, and work for all cores."""
    return 2 * max(2, spark.sparkContext.defaultParallelism)


def _messages(feed: DataFrame, *keep: str) -> DataFrame:
    """Parsed and identified events of a feed that has gone through messages."""
    name = F.split("table_key", r"\.")
    value = F.to_json(
        F.struct(
            "operation",
            name[1].alias("table"),
            name[0].alias("database"),
            F.lit("mssql").alias("source"),
            F.struct("user_id", "value", "event_type").alias("data"),
        )
    )
    # Batches are ranges of the feed, so few splits of its files hold a batch; its rows are dealt to all tasks.
    dealt = feed.repartition(_files(feed.sparkSession), "seq")
    return envelope.identify(envelope.parse_envelope(dealt.select("seq", *keep, value.alias("value"))), "user_id")


def _commits(spark, sf_dir) -> DataFrame:
    """Commits of a bronze area that the feed is stored in by two parts."""
    bronze = Bronze(spark, scratch_dir(spark, "bronze"))
    feed = feeds.load_feed(spark, sf_dir)
    events = _messages(feed, "batch_id")
    half = feed.agg(F.max("batch_id")).first()[0] // 2
    bronze.append_all(events.filter(F.col("batch_id") <= half))
    bronze.write_change_log()
    bronze.append_all(events.filter(F.col("batch_id") > half))
    bronze.write_change_log()
    return bronze.commits()


@query
def commit_running_total(spark, sf_dir):
    return _commits(spark, sf_dir).select(
        "table_key", "batch_id", F.coalesce("new_rows", F.lit(0)).alias("new_rows"), "total_records"
    )


@query
def commit_latest(spark, sf_dir):
    columns = "table_key batch_id commit_type operation total inserts updates deletes new_rows total_records".split()
    return commits.commit_latest(_commits(spark, sf_dir).select(*columns))


@query
def commit_totals_of_log(spark, sf_dir):
    feed = feeds.load_feed(spark, sf_dir)
    totals = commits.running_totals(commits.batch_summary(feed), commits.new_rows(feed, USER))
    return totals.select("table_key", "batch_id", "new_rows", "total_records")


@query
def stored_change_log(spark, sf_dir):
    bronze = Bronze(spark, scratch_dir(spark, "bronze"))
    feed = feeds.change_feed(spark, sf_dir)
    last = feed.agg(F.max("seq")).first()[0] + 1
    events = _messages(feed.withColumn("batch_id", F.expr(f"seq * 6 div {last}")), "batch_id")
    for first, after in ((0, 2), (2, 3), (3, 5), (5, 6)):
        bronze.append_all(events.filter(F.col("batch_id").between(first, after - 1)))
        if first != 3:
            bronze.compact()
    bronze.write_change_log()

    def image(side: str) -> list[Column]:
        data = F.col(f"{side}.data")
        return [
            data["value"].cast("double").alias(f"{side}_value"),
            data["event_type"].alias(f"{side}_event_type"),
            F.col(f"{side}.deleted").alias(f"{side}_deleted"),
        ]

    user = F.col("row_key").cast("bigint").alias("user_id")
    return bronze.stored_change_log().select("table_key", user, "seq", "operation", *image("before"), *image("after"))


@query
def commit_schema_changes(spark, sf_dir):
    events = envelope.parse_envelope(feeds.evolving_feed(spark, sf_dir)).filter("route <> 'schema'")
    numbered = events.withColumn("batch_id", F.expr(f"seq div {2 * feeds.BATCH_ROWS}"))
    filled = F.map_filter("data", lambda _, value: value.isNotNull())
    return commits.schema_changes(numbered.withColumn("data", filled))


# Schema drift


def _drift(operation: str, *fields: str, match_default: bool = True) -> Query:
    def run(spark, sf_dir):
        old, new = feeds.catalogs(spark, sf_dir)
        if operation.endswith("TABLE"):
            events = drift.table_events(old, new)
        else:
            events = drift.column_events(old, new, match_default)
        return events.filter(F.col("operation") == operation).select(*fields)

    return run


QUERIES["ddl_add_table"] = _drift("ADD_TABLE", "table")
QUERIES["ddl_drop_table"] = _drift("DROP_TABLE", "table")
QUERIES["ddl_rename_table"] = _drift("RENAME_TABLE", "old_table", "new_table")
QUERIES["ddl_add_column"] = _drift("ADD_COLUMN", "table", "column", "data_type", "default")
QUERIES["ddl_drop_column"] = _drift("DROP_COLUMN", "table", "column")
QUERIES["ddl_rename_column"] = _drift("RENAME_COLUMN", "table", "old_column", "new_column", "data_type")
QUERIES["ddl_rename_column_by_type"] = _drift(
    "RENAME_COLUMN", "table", "old_column", "new_column", "data_type", match_default=False
)


@query
def schema_versions(spark, sf_dir):
    old, new = feeds.catalogs(spark, sf_dir)
    earlier = old.groupBy(F.col("table_full").alias("table")).agg((F.max("ordinal") % 3).alias("version"))
    return drift.schema_versions(drift.ddl_diff(old, new), earlier)


# Schema events


@query
def added_table_columns(spark, sf_dir):
    return drift.added_table_columns(*feeds.catalogs(spark, sf_dir))


@query
def apply_add_table(spark, sf_dir):
    messages = poll.schema_messages(*feeds.catalogs(spark, sf_dir), "shop", "mssql", _polled_at())
    raw = messages.select(F.lit(1).cast("bigint").alias("seq"), "value")
    events = envelope.identify(envelope.parse_envelope(raw), "none").filter("operation = 'ADD_TABLE'")
    bronze = Bronze(spark, scratch_dir(spark, "bronze"))
    bronze.append(events, 0)
    return bronze.tables().select("table_key", F.explode("columns").alias("column", "data_type"))


def _evolved_orders(*events: dict[str, str]) -> Query:
    def run(spark, sf_dir):
        return evolve.apply_schema_events(feeds.table(spark, sf_dir, "orders"), events)

    return run


QUERIES["apply_add_column"] = _evolved_orders(
    {"operation": "ADD_COLUMN", "column": "channel", "data_type": "text", "default": "'web'::text"},
    {"operation": "ADD_COLUMN", "column": "parcels", "data_type": "integer", "default": "1"},
    {"operation": "ADD_COLUMN", "column": "checked", "data_type": "date", "default": "now()"},
)
QUERIES["apply_rename_column"] = _evolved_orders(
    {"operation": "RENAME_COLUMN", "old_column": "o_totalprice", "new_column": "amount"},
    {"operation": "RENAME_COLUMN", "old_column": "absent", "new_column": "other"},
)
QUERIES["apply_drop_column"] = _evolved_orders(
    {"operation": "DROP_COLUMN", "column": "o_orderpriority"},
)


def _moved(operation: str) -> Query:
    def run(spark, sf_dir):
        good, _ = envelope.split_valid(_parsed(spark, sf_dir))
        first = feeds.table(spark, sf_dir, "events").filter(
            F.col("ts") >= F.lit(feeds.RENAMED_ON).cast("timestamp_ntz")
        ).agg(F.min("event_id").alias("seq"))
        fields = ("table", "old_table", "new_table", "column", "old_column", "new_column", "default")
        names = {"table": "orders"} if operation == "DROP_TABLE" else {"old_table": "orders", "new_table": "sales"}
        events = first.select(
            "seq",
            F.lit("shop").alias("database"),
            F.lit(operation).alias("operation"),
            *[F.lit(names.get(f)).cast("string").alias(f) for f in fields],
        )
        log = good.filter("route <> 'schema'").select("seq", "table_key", "data")
        return evolve.evolve_log(log, events, stored=False).select(
            "seq", "table_key", *[F.col("data")[c].alias(c) for c in feeds.DATA]
        )

    return run


QUERIES["apply_rename_table"] = _moved("RENAME_TABLE")
QUERIES["apply_drop_table"] = _moved("DROP_TABLE")


# Silver


@query
def prune_soft_dropped(spark, sf_dir):
    return conform.prune_soft_dropped(feeds.source_a(spark, sf_dir)).select(
        "stt", "so_the", "so_tien"
    )


@query
def filter_soft_deleted(spark, sf_dir):
    return conform.filter_soft_deleted(feeds.source_a(spark, sf_dir)).select("stt", "deleted")


@query
def conform_a(spark, sf_dir):
    return conform.conform(conform.drop_soft_deleted(feeds.source_a(spark, sf_dir)), silver.SPEC_A)


@query
def conform_b(spark, sf_dir):
    return conform.conform(conform.drop_soft_deleted(feeds.source_b(spark, sf_dir)), silver.SPEC_B)


@query
def silver_unified(spark, sf_dir):
    return silver.unify(feeds.source_a(spark, sf_dir), feeds.source_b(spark, sf_dir))


@query
def append_evolve(spark, sf_dir):
    return conform.append_evolve(*feeds.parties(spark, sf_dir))


# Streams


def _topic(spark: SparkSession, feed: DataFrame) -> str:
    """A folder of JSON lines that stands for the topics."""
    folder = scratch_dir(spark, "topic")
    feed.repartition(_files(spark)).write.json(folder)
    return folder


WIRE = "seq bigint, value string"


def _applied(spark: SparkSession, feed: DataFrame, key: str = "user_id") -> Bronze:
    """The bronze area after the feed has run through the apply stream."""
    raw = readers.read_lines_stream(spark, _topic(spark, feed), WIRE, files_per_batch=_files(spark) // 2)
    base = scratch_dir(spark, "bronze")
    stream = start_apply_stream(raw, base, scratch_dir(spark, "checkpoint"), key)
    stream.awaitTermination()
    return Bronze(spark, base)


@query
def stream_envelope_parse(spark, sf_dir):
    raw = readers.read_lines_stream(spark, _topic(spark, feeds.raw_feed(spark, sf_dir)), WIRE)
    out = scratch_dir(spark, "parsed")
    events = envelope.parse_envelope(raw).select("seq", "operation", "table_key", "route", "fault")
    stream = (
        events.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", scratch_dir(spark, "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    stream.awaitTermination()
    return spark.read.parquet(out)


def _state_columns(state: DataFrame, columns: list[str]) -> DataFrame:
    return state.select(
        "record_id", *[F.col("data")[c].alias(c) for c in columns], "_operation", "_seq", "deleted"
    )


@query
def stream_cdc_apply(spark, sf_dir):
    state = _applied(spark, feeds.raw_feed(spark, sf_dir)).state()
    return _state_columns(state, ["cents", "event_type", "props"])


@query
def stream_events_per_table(spark, sf_dir):
    bronze = _applied(spark, feeds.raw_feed(spark, sf_dir))
    return bronze.commits().groupBy("table_key").agg(
        *[F.sum(c).alias(c) for c in ("total", "inserts", "updates", "deletes")]
    )


@query
def stream_key_rename(spark, sf_dir):
    cur = feeds.order_snapshots(spark, sf_dir)[1].withColumnRenamed("o_orderkey", "number")
    state = _applied(spark, feeds.key_rename_feed(spark, sf_dir), "o_orderkey").state().filter("NOT deleted")
    return state.select(*[F.col("data")[f.name].cast(f.dataType).alias(f.name) for f in cur.schema.fields])


@query
def stream_ddl_apply(spark, sf_dir):
    state = _applied(spark, feeds.evolving_feed(spark, sf_dir)).state()
    return _state_columns(state, ["cents", "amount", "event_type", "event_type_deleted", "tier"])


@query
def stream_keyed_state(spark, sf_dir):
    schema = feeds.table(spark, sf_dir, "events").schema
    stream = readers.read_table_stream(spark, sf_dir, "events.parquet", schema)
    kind: Column = F.col("event_type")
    operation = F.when(kind == "signup", "INSERT").when(kind == "error", "DELETE").otherwise("UPDATE")
    events = stream.select("user_id", F.col("event_id").alias("seq"), operation.alias("operation"), *IMAGE)
    path = scratch_dir(spark, "state")
    start_state_stream(
        events, USER, "seq", IMAGE, path, scratch_dir(spark, "checkpoint")
    ).awaitTermination()
    return latest_state(spark.read.parquet(path), USER)


def _feed_files(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, Callable[[], None]]:
    """A stream of a folder with the first half of the change feed by time, and what adds the second one.

    Each half is dealt out to the same number of files and read in two micro-batches, however large it is.
    """
    feed = feeds.change_feed(spark, sf_dir).select("user_id", "seq", "operation", *IMAGE, "ts")
    folder, files = scratch_dir(spark, "feed"), _files(spark)
    middle = F.lit("2024-01-16").cast("timestamp_ntz")

    def put(half: Column) -> None:
        feed.filter(half).drop("ts").repartition(files).write.mode("append").parquet(folder)

    put(F.col("ts") < middle)
    stream = spark.readStream.schema(feed.drop("ts").schema).option("maxFilesPerTrigger", files // 2).parquet(folder)
    return stream, lambda: put(F.col("ts") >= middle)


@query
def stream_state_tws(spark, sf_dir):
    stream, add_rest = _feed_files(spark, sf_dir)
    path, checkpoint = scratch_dir(spark, "state"), scratch_dir(spark, "checkpoint")

    def run() -> None:
        start_processor_stream(stream, USER, "seq", IMAGE, path, checkpoint).awaitTermination()

    # The stream ends in the middle, and a new one goes on from its checkpoint.
    run()
    add_rest()
    run()
    return processor_state(spark, checkpoint, USER, IMAGE)


@query
def stream_state_read(spark, sf_dir):
    stream, add_rest = _feed_files(spark, sf_dir)
    add_rest()
    checkpoint = scratch_dir(spark, "checkpoint")
    start_state_stream(stream, USER, "seq", IMAGE, scratch_dir(spark, "state"), checkpoint).awaitTermination()
    return aggregate_state(spark, checkpoint, USER, IMAGE)
