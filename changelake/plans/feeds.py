"""Inputs of the registered queries, derived from the whole given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from changelake.operators.envelope import build_envelope
from changelake.operators.evolve import apply_schema_events
from changelake.plans.kept import Kept
from changelake.plans.poll import Polled, load_messages, row_messages
from changelake.session import scratch_dir

BATCH_ROWS = 1000
RENAMED_ON, DROPPED_ON = "2024-01-10", "2024-01-20"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders before and after the finished ones left, the pending ones came in
    and the urgent ones were repriced."""
    orders = table(spark, sf_dir, "orders")
    price = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 1)
    later = orders.filter("o_orderstatus <> 'F'").withColumn(
        "o_totalprice", price.otherwise(F.col("o_totalprice"))
    )
    return orders.filter("o_orderstatus <> 'P'"), later


def line_snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Line items, which have no key, before returns left and open lines came in."""
    lines = table(spark, sf_dir, "lineitem")
    before = lines.filter("l_returnflag <> 'N' OR l_linestatus <> 'O'")
    return before, lines.filter("l_returnflag <> 'R'")


def wide_snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Line items under a key, of which a seventh of those of one supplier in a hundred changed their price."""
    line = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", F.date_format("l_shipdate", "yyyyMMdd"))
    wide = table(spark, sf_dir, "lineitem").withColumn("line", line).withColumn("note", F.concat(F.lit("line "), line))
    price = F.when((F.col("l_suppkey") % 100 == 0) & (F.col("l_orderkey") % 7 == 0), F.col("l_extendedprice") + 1)
    return wide, wide.withColumn("l_extendedprice", F.coalesce(price, "l_extendedprice"))


def first_poll(spark: SparkSession, sf_dir: str) -> Kept:
    """The wide lines as the poll before has stored them."""
    prev, _ = wide_snapshots(spark, sf_dir)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return Kept(spark, scratch_dir(spark, "kept"), prev.schema, "line", False, (), buckets).write(prev)


def event_snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Events keyed by their time, before errors left, purchases came in and clicks were revalued."""
    events = table(spark, sf_dir, "events")
    kind = F.col("event_type")
    value = F.when(kind == "click", F.col("value") + 1).otherwise(F.col("value"))
    return events.filter(kind != "purchase"), events.filter(kind != "error").withColumn("value", value)


def part_keyed_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The snapshots of the orders, of which those of low priority have no key or a blank one."""
    def keyed(orders: DataFrame) -> DataFrame:
        key = F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", " ").when(
            F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey").cast("string")
        )
        return orders.withColumn("okey", key)

    prev, cur = order_snapshots(spark, sf_dir)
    return keyed(prev), keyed(cur)


def key_rename_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages `seq, value`: the orders are loaded, their key gets another name, and a poll follows."""
    prev, cur = order_snapshots(spark, sf_dir)
    at = F.lit("2024-02-01 08:30:00").cast("timestamp_ntz")
    renamed = {"operation": "RENAME_COLUMN", "table": "public.orders", "old_column": "o_orderkey", "new_column": "number"}
    source = ("orders", "shop", "postgresql", at)
    load = load_messages(prev, "o_orderkey", *source, unique=True)
    polled = row_messages(
        apply_schema_events(prev, [renamed]), cur.withColumnRenamed("o_orderkey", "number"), "number", *source, unique=True
    )
    event = {**renamed, "database": "shop", "source": "postgresql"}
    schema = spark.range(1).select(F.to_json(F.struct(*[F.lit(v).alias(c) for c, v in event.items()])).alias("value"))
    parts = ((load, 1), (schema, 2), (polled, 3))
    rows = [df.select(F.lit(seq).cast("bigint").alias("seq"), "value") for df, seq in parts]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def polled_tables(spark: SparkSession, sf_dir: str) -> tuple[dict[str, Polled], DataFrame]:
    """Three tables and an unreadable one since the last poll.

    Of the customers the balance has another name and some values changed, of the suppliers
    some left, and the parts are polled for the first time.
    """
    customers, suppliers, parts = (table(spark, sf_dir, name) for name in ("customer", "supplier", "part"))
    changed = F.when(F.col("c_nationkey") == 1, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal"))
    now = customers.withColumn("c_acctbal", changed).withColumnRenamed("c_acctbal", "balance")
    columns = "operation string, table string, column string, old_column string, new_column string"
    events = spark.createDataFrame([("RENAME_COLUMN", "customer", None, "c_acctbal", "balance")], columns)
    return {
        "customer": Polled(lambda: now, "c_custkey", unique=True, last=customers),
        "supplier": Polled(lambda: suppliers.filter("s_nationkey <> 2"), "s_suppkey", unique=True, last=suppliers),
        "part": Polled(lambda: parts, "p_partkey", unique=True),
        "missing": Polled(lambda: table(spark, sf_dir, "missing"), "id", last=suppliers),
    }, events


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as changes of a row per user, or per user and table."""
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        "user_id",
        F.col("event_id").alias("seq"),
        F.when(kind == "signup", "INSERT").when(kind == "error", "DELETE").otherwise("UPDATE").alias("operation"),
        "value",
        "event_type",
        F.expr(f"event_id div {BATCH_ROWS}").alias("batch_id"),
        F.when(F.get_json_object("props", "$.k").cast("int") < 50, "shop.users")
        .otherwise("crm.users")
        .alias("table_key"),
        "ts",
    )


def load_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change feed, its first days being an initial load."""
    load = F.col("ts") < F.lit("2024-01-04").cast("timestamp_ntz")
    return change_feed(spark, sf_dir).withColumn(
        "operation", F.when(load, "INITIAL_LOAD").otherwise(F.col("operation"))
    )


def _tables(k: Column) -> tuple[Column, Column]:
    database = F.when(k < 50, "shop").otherwise(" crm ")
    name = (
        F.when(k < 25, "public.Orders")
        .when(k < 50, "dbo.VISITS")
        .when(k < 75, " Accounts")
        .when(k < 95, "public.leads")
        .when(k < 98, "")
    )
    return database, name


def envelope_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as rows to be put into envelopes, with the faults of a real feed."""
    kind, value = F.col("event_type"), F.col("value")
    k = F.get_json_object("props", "$.k").cast("int")
    database, name = _tables(k)
    load = F.col("ts") < F.lit("2024-01-04").cast("timestamp_ntz")
    operation = (
        F.when(load, "INITIAL_LOAD")
        .when(kind == "signup", "insert")
        .when(kind == "error", "DELETE")
        .when((kind == "view") & (value > 100), "TRUNCATE")
        .otherwise("Update")
    )
    full = operation != "DELETE"
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"),
        operation.alias("operation"),
        name.alias("table"),
        F.when(value < 0.5, "").otherwise(database).alias("database"),
        F.when(value < 10, "mssql").when(value < 300, "postgresql").otherwise("oracle").alias("source"),
        "ts",
        "user_id",
        F.when(full, F.round(value * 100).cast("bigint")).alias("cents"),
        F.when(full, kind).alias("event_type"),
        F.when(full, F.col("props")).alias("props"),
        ((kind == "click") & (value < 1)).alias("broken"),
        ((kind == "click") & (value >= 1) & (value < 3)).alias("repeated"),
    )


DATA = ["user_id", "cents", "event_type", "props"]


def built_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row with its envelope, `value`."""
    parts = [F.col(c) for c in ("operation", "table", "database", "source", "ts")]
    return build_envelope(envelope_rows(spark, sf_dir), DATA, *parts)


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes `seq, value` as they come off a topic; some are not JSON, some name a column twice."""
    built = built_feed(spark, sf_dir)
    text = F.when(F.col("broken"), F.concat(F.lit("{"), "value")).otherwise(F.col("value"))
    twice = F.regexp_replace("value", r'"data":\{', '"data":{"user_id":0,')
    text = F.when(~F.col("broken") & F.col("repeated"), twice).otherwise(text)
    return built.select("seq", text.alias("value"))


def evolving_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good row events with schema events among them.

    In `shop.orders` the amount is renamed on one day, in `shop.visits` the
    event type is dropped on another; `crm.accounts` gains a column, and
    `crm.leads` gets a new name. The rows change with them.
    """
    rows = envelope_rows(spark, sf_dir).filter(
        "`table` IS NOT NULL AND `table` <> '' AND database <> '' AND operation <> 'TRUNCATE'"
    )
    k = F.col("table")
    after_rename = F.col("ts") >= F.lit(RENAMED_ON).cast("timestamp_ntz")
    after_drop = F.col("ts") >= F.lit(DROPPED_ON).cast("timestamp_ntz")
    renamed = (k == "public.Orders") & after_rename
    moved = (k == "public.leads") & after_rename
    changed = rows.select(
        (F.col("seq") * 2 + 1).alias("seq"),
        F.upper("operation").alias("operation"),
        F.when(moved, "prospects").otherwise(k).alias("table"),
        "database",
        "source",
        "ts",
        "user_id",
        F.when(~renamed, F.col("cents")).alias("cents"),
        F.when(renamed, F.col("cents")).alias("amount"),
        F.when(~((k == "dbo.VISITS") & after_drop), F.col("event_type")).alias("event_type"),
        "repeated",
    )
    data = F.struct("user_id", "cents", "amount", "event_type")
    text = F.to_json(F.struct("operation", "table", "database", "source", data.alias("data")))
    twice = F.regexp_replace(text, r'"data":\{', '"data":{"user_id":0,')
    row_values = changed.select("seq", F.when(F.col("repeated"), twice).otherwise(text).alias("value"))

    def event(operation: str, database: str, day: str, **fields: str) -> DataFrame:
        first = table(spark, sf_dir, "events").filter(
            F.col("ts") >= F.lit(day).cast("timestamp_ntz")
        ).agg(F.min("event_id").alias("at"))
        payload = {"operation": operation, "database": database, "source": "postgresql", **fields}
        return first.filter("at IS NOT NULL").select(
            (F.col("at") * 2).alias("seq"),
            F.to_json(F.struct(*[F.lit(v).alias(c) for c, v in payload.items()])).alias("value"),
        )

    return (
        row_values.unionByName(
            event(
                "RENAME_COLUMN", "shop", RENAMED_ON, table="public.orders", old_column="cents", new_column="amount"
            )
        )
        .unionByName(event("RENAME_TABLE", "crm", RENAMED_ON, old_table="public.leads", new_table="public.prospects"))
        .unionByName(event("DROP_COLUMN", "shop", DROPPED_ON, table="dbo.visits", column="event_type"))
        .unionByName(
            event(
                "ADD_COLUMN", "crm", DROPPED_ON, table="accounts", column="tier", data_type="text", default="'basic'"
            )
        )
    )


def catalogs(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two states of a catalog with a table per order and a column per line.

    Between them tables are added, dropped and renamed by order priority and
    status, and columns by return flag and line status. The states are stored,
    as a poll leaves them for the next one to compare.
    """
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_returnflag").alias("flag"), F.min("l_linestatus").alias("status")
    )
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    rows = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    order, state = F.col("o_orderpriority"), F.col("o_orderstatus")
    flag, status, number = F.col("flag"), F.col("status"), F.col("l_linenumber").cast("string")
    moving = order != "1-URGENT"
    returned = moving & (flag == "R")

    def state_of(kept: Column, prefix: Column, letter: Column, default: Column) -> DataFrame:
        return rows.filter(kept).select(
            F.concat(F.lit("shop."), prefix, F.col("l_orderkey").cast("string")).alias("table_full"),
            F.concat(letter, number).alias("column"),
            F.col("l_linenumber").alias("ordinal"),
            F.when(flag == "A", "text").when(flag == "N", "integer").otherwise("date").alias("data_type"),
            default.alias("column_default"),
        )

    zero = F.when(status == "F", "0")
    old = state_of(
        ~((order == "2-HIGH") & (state == "P")) & ~(moving & (flag == "N") & (status == "O")),
        F.lit("o"), F.lit("c"), zero,
    )
    new = state_of(
        ~((order == "2-HIGH") & (state == "F")) & ~(moving & (flag == "A") & (status == "F")),
        F.when(order == "1-URGENT", "r").otherwise("o"),
        F.when(returned, "d").otherwise("c"),
        F.when(returned & (status == "O"), "1").otherwise(zero),
    )
    folder = scratch_dir(spark, "catalogs")
    for name, state in (("old", old), ("new", new)):
        state.write.parquet(f"{folder}/{name}")
    return spark.read.parquet(f"{folder}/old"), spark.read.parquet(f"{folder}/new")


def information_schema(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """`tables` and `columns` rows of a server, system schemas and views included."""
    order = F.col("o_orderpriority")
    schema = (
        F.when(order == "1-URGENT", "pg_catalog")
        .when(order == "2-HIGH", "INFORMATION_SCHEMA")
        .when(order == "3-MEDIUM", "sys")
        .when(order == "4-NOT SPECIFIED", "dbo")
        .otherwise("public")
    )
    name = F.concat(F.lit("t"), F.col("o_orderkey").cast("string"))
    orders = table(spark, sf_dir, "orders")
    tables = orders.select(
        schema.alias("table_schema"),
        name.alias("table_name"),
        F.when(F.col("o_orderstatus") == "P", "VIEW").otherwise("BASE TABLE").alias("table_type"),
    )
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_returnflag").alias("flag")
    )
    columns = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        schema.alias("table_schema"),
        name.alias("table_name"),
        F.concat(F.lit("c"), F.col("l_linenumber").cast("string")).alias("column_name"),
        F.col("l_linenumber").alias("ordinal_position"),
        F.when(F.col("flag") == "A", "text").otherwise("integer").alias("data_type"),
        F.lit(None).cast("string").alias("column_default"),
    )
    return tables, columns


def dirty_date(orders: DataFrame) -> Column:
    """The order date as different sources write it."""
    date, order = F.col("o_orderdate"), F.col("o_orderpriority")
    return (
        F.when(order == "1-URGENT", F.date_format(date, "yyyy-MM-dd"))
        .when(order == "2-HIGH", F.date_format(date, "dd/MM/yyyy"))
        .when(order == "3-MEDIUM", F.date_format(date, "d.M.yyyy"))
        .when(order == "4-NOT SPECIFIED", F.date_format(date, " yyyy/M/d "))
        .when(F.col("o_orderstatus") == "F", F.date_format(date, "yyyy-MM-dd HH:mm:ss"))
        .when(F.col("o_orderstatus") == "O", F.date_format(date, "yyyy-dd-MM"))
        .otherwise("n/a")
    )


def source_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as text rows of the first silver source."""
    orders = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey").cast("string")
    customer = F.col("o_custkey").cast("string")
    state = F.col("o_orderstatus")
    return orders.select(
        key.alias("stt"),
        F.col("o_orderpriority").alias("ma_nv"),
        F.concat(F.lit("9704-"), customer).alias("so_the"),
        F.concat(F.lit("  NGUYỄN \t Văn  "), customer, F.lit("\n")).alias("ten_in_tren_the"),
        F.when(state == "F", "").otherwise(F.concat(state, F.lit("  \r\n "), F.col("o_orderpriority"))).alias("san_pham"),
        F.format_number(F.floor("o_totalprice"), 0).alias("so_tien"),
        F.concat(F.lit("gd/"), key, F.lit("-"), state).alias("so_giao_dich"),
        dirty_date(orders).alias("ngay_di_thuc_te"),
        F.date_format("o_orderdate", "dd.MM.yyyy").alias("ngay_hieu_luc"),
        F.concat(F.lit("51đ-"), customer, F.lit(".é")).alias("bs_xe"),
        F.when(state == "P", "   ").otherwise(F.concat(F.lit(" sân  bay "), customer)).alias("diem_don_ghi_chu"),
        F.lit("quận   1").alias("diem_tra"),
        F.when(state != "O", F.concat(F.lit("đơn vị\t"), state)).alias("don_vi_phat_sinh"),
        F.when(F.col("o_orderpriority") == "5-LOW", "x").alias("ghi_chu_deleted"),
        F.when((state == "F") & (F.col("o_orderpriority") == "5-LOW"), "True")
        .when(state == "F", "false")
        .when(state == "O", "None")
        .alias("deleted"),
    )


def source_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as text rows of the second silver source."""
    order, part = F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string")
    supplier, flag = F.col("l_suppkey").cast("string"), F.col("l_returnflag")
    return table(spark, sf_dir, "lineitem").select(
        F.when(flag == "R", F.concat(F.lit("x"), order)).otherwise(order).alias("stt"),
        F.concat(F.lit("kh-"), supplier).alias("ma_kh"),
        F.concat(F.lit("hđ/"), order).alias("ma_hd"),
        F.concat(F.lit("nv "), supplier).alias("nv_quan_ly"),
        F.concat(F.lit("lx_"), part).alias("ma_lai_xe"),
        F.concat(order, F.lit("#"), F.col("l_linenumber").cast("string")).alias("id_cuoc_xe"),
        F.concat(F.lit("9704-"), part).alias("so_the"),
        F.concat(F.lit(" TRẦN  "), supplier).alias("ten_in_tren_the"),
        F.concat(flag, F.lit("\t\t"), F.col("l_linestatus")).alias("san_pham"),
        F.when(flag == "A", F.concat(F.lit("-"), F.floor("l_extendedprice").cast("string")))
        .otherwise(F.concat(F.floor("l_extendedprice").cast("string"), F.lit(".00")))
        .alias("so_tien"),
        F.concat(F.lit("gd-"), order).alias("ma_gd"),
        F.lit("---").alias("so_tai"),
        F.date_format("l_shipdate", "d/M/yyyy").alias("thoi_diem_giao_dich"),
        F.concat(F.lit("đv."), supplier).alias("ma_dv_phat_sinh_gd"),
        F.concat(F.lit("Đơn  vị "), supplier).alias("ten_dv_phat_sinh_gd"),
        F.when(flag == "N", "thành  công").otherwise("").alias("trang_thai"),
        F.concat(F.lit("loại\n"), F.col("l_linestatus")).alias("loai_gd"),
        ((flag == "R") & (F.col("l_linestatus") == "O")).alias("deleted"),
    )


def parties(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers and suppliers, whose columns overlap only in part."""
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"),
        F.col("c_mktsegment").alias("segment"),
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        F.col("s_name").alias("name"),
        F.col("s_suppkey").alias("id"),
        F.col("s_nationkey").alias("nation"),
        F.col("s_acctbal").alias("balance"),
    )
    return customers, suppliers
