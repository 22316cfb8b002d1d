"""Schema drift: two states of a catalog compared into schema events.

A catalog is a DataFrame `table_full, column, ordinal, data_type,
column_default`, one row per column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelake.operators.scan import prefix_scan
from changelake.session import small_methods

EVENT_FIELDS = (
    "operation",
    "table",
    "old_table",
    "new_table",
    "column",
    "old_column",
    "new_column",
    "data_type",
    "default",
)


def _both(old: DataFrame, new: DataFrame) -> DataFrame:
    small_methods(old.sparkSession)
    return old.withColumn("is_new", F.lit(False)).unionByName(new.withColumn("is_new", F.lit(True)))


def _numbered(df: DataFrame, group: Sequence[str], order: str, bits: int) -> DataFrame:
    """Add `rank` by the bigint `order`, which occurs once per group.

    One level of segments bounds the groups: ordinals are 31 bits, in segments
    of 20; name orders are 60 even bits, in segments of 40.
    """
    ones = df.withColumn("_one", F.lit(1))
    counted = prefix_scan(ones, group, order, {"_one": "sum"}, bits, levels=1)
    return counted.withColumn("rank", F.col("_one_after")).drop("_one", "_one_before", "_one_after")


def _name_order(name: Column) -> Column:
    """A fixed order of names that spreads them evenly: 60 bits of their MD5."""
    return F.conv(F.substring(F.md5(name), 1, 15), 16, 10).cast("bigint")


def _pairs(alone: DataFrame, group: Sequence[str], order: str, bits: int, **values: str) -> DataFrame:
    """Rows of one state beside those of the other with equal group and rank.

    The n-th of several alike goes with the n-th. `values` names the result
    columns as `<name>=<column>`, each as `old_<name>` and `new_<name>`.
    """
    ranked = _numbered(alone, [*group, "is_new"], order, bits)
    sides = {"old_": ~F.col("is_new"), "new_": F.col("is_new")}
    return ranked.groupBy(*group, "rank").agg(
        *[
            F.max(F.when(here, F.col(column))).alias(f"{side}{name}")
            for side, here in sides.items()
            for name, column in values.items()
        ]
    )


def _fingerprint(seed: int) -> Column:
    """What a column adds to its table's sum of hashes."""
    parts = ["column", "data_type", "column_default", F.col("column_default").isNull()]
    return F.xxhash64(F.lit(seed), *parts).cast("decimal(20,0)")


def _equal_columns(old: DataFrame, new: DataFrame, pairs: DataFrame) -> DataFrame:
    """`old_table, new_table, equal`: the number of columns that are the same in both tables of a pair."""
    left = old.select(F.col("table_full").alias("old_table"), "column", "data_type", "column_default").join(pairs, "old_table")
    right = new.select(*[F.col(c).alias(f"_{c}") for c in ("table_full", "column", "data_type", "column_default")])
    same = (F.col("new_table") == F.col("_table_full")) & (F.col("column") == F.col("_column"))
    for c in ("data_type", "column_default"):
        same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
    return left.join(right, same).groupBy("old_table", "new_table").agg(F.count("*").alias("equal"))


def table_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """`old_table, new_table` of tables in one state only; null where there is none.

    A dropped and an added table with equal columns are one renamed table. Their number and
    two sums of hashes find those that may be; their columns are then compared themselves, and
    tables that only their hashes pair are a dropped and an added one. No step needs a
    column list in one place, so a table may be as wide as it likes.
    """
    hashes = [_fingerprint(seed) for seed in (1, 2)]
    tables = (
        _both(old, new)
        .groupBy("table_full")
        .agg(
            F.min("is_new").alias("is_new"),
            F.max("is_new").alias("last"),
            F.count("*").alias("n"),
            F.sum(hashes[0]).alias("h1"),
            F.sum(hashes[1]).alias("h2"),
        )
    )
    alone = tables.filter("is_new = last").withColumn("order", _name_order(F.col("table_full")))
    pairs = _pairs(alone, ["n", "h1", "h2"], "order", 40, table="table_full")
    equal = _equal_columns(old, new, pairs.filter("old_table IS NOT NULL AND new_table IS NOT NULL"))
    checked = pairs.join(equal, ["old_table", "new_table"], "left")
    apart = F.array(F.struct("old_table", F.lit(None).cast("string").alias("new_table")), F.struct(F.lit(None).cast("string").alias("old_table"), "new_table"))
    whole = F.array(F.struct("old_table", "new_table"))
    single = F.col("old_table").isNull() | F.col("new_table").isNull()
    return checked.select(F.inline(F.when(single | F.coalesce(F.col("equal") == F.col("n"), F.lit(False)), whole).otherwise(apart)))


def column_changes(old: DataFrame, new: DataFrame, match_default: bool = True) -> DataFrame:
    """Columns dropped from, added to or renamed in tables that both states have.

    A dropped and an added column of one table are one renamed column if their
    type, and with `match_default` also their default, are equal; of several
    alike, the n-th dropped goes with the n-th added, by ordinal.
    """
    both = _both(old, new)
    sides = [F.min("is_new").alias("is_new"), F.max("is_new").alias("last")]
    details = F.struct("ordinal", "data_type", "column_default")
    columns = both.groupBy("table_full", "column").agg(*sides, F.max(details).alias("_d"))
    common = both.groupBy("table_full").agg(*sides).filter("is_new <> last").select("table_full")
    alone = (
        columns.filter("is_new = last")
        .join(common, "table_full", "left_semi")
        .select("table_full", "column", "is_new", "_d.*")
        .withColumn("order", F.col("ordinal").cast("bigint"))
        .withColumn("default", F.col("column_default"))
    )
    group = ["table_full", "data_type", *(["column_default"] if match_default else [])]
    return _pairs(alone, group, "order", 20, column="column", default="default").select(
        F.col("table_full").alias("table"),
        "old_column",
        "new_column",
        "data_type",
        F.col("new_default").alias("default"),
    )


def _events(df: DataFrame, **fields: Column) -> DataFrame:
    empty = F.lit(None).cast("string")
    return df.select(*[fields.get(f, empty).alias(f) for f in EVENT_FIELDS])


def table_events(old: DataFrame, new: DataFrame) -> DataFrame:
    """`ADD_TABLE`, `DROP_TABLE` and `RENAME_TABLE` events."""
    before, after = F.col("old_table"), F.col("new_table")
    operation = (
        F.when(before.isNull(), "ADD_TABLE").when(after.isNull(), "DROP_TABLE").otherwise("RENAME_TABLE")
    )
    renamed = operation == "RENAME_TABLE"
    return _events(
        table_changes(old, new),
        operation=operation,
        table=F.when(~renamed, F.coalesce(before, after)),
        old_table=F.when(renamed, before),
        new_table=F.when(renamed, after),
    )


def column_events(old: DataFrame, new: DataFrame, match_default: bool = True) -> DataFrame:
    """`ADD_COLUMN`, `DROP_COLUMN` and `RENAME_COLUMN` events."""
    before, after = F.col("old_column"), F.col("new_column")
    operation = (
        F.when(before.isNull(), "ADD_COLUMN").when(after.isNull(), "DROP_COLUMN").otherwise("RENAME_COLUMN")
    )
    renamed, added = operation == "RENAME_COLUMN", operation == "ADD_COLUMN"
    return _events(
        column_changes(old, new, match_default),
        operation=operation,
        table=F.col("table"),
        column=F.when(~renamed, F.coalesce(before, after)),
        old_column=F.when(renamed, before),
        new_column=F.when(renamed, after),
        data_type=F.when(after.isNotNull(), F.col("data_type")),
        default=F.when(added, F.col("default")),
    )


def ddl_diff(old: DataFrame, new: DataFrame, match_default: bool = True) -> DataFrame:
    """All schema events between two states of a catalog, net of renames.

    `match_default` is the rule for sources that report column defaults.
    """
    return table_events(old, new).unionByName(column_events(old, new, match_default))


def added_table_columns(old: DataFrame, new: DataFrame) -> DataFrame:
    """The columns of the added tables, one row each."""
    added = table_events(old, new).filter("operation = 'ADD_TABLE'")
    return new.join(added.select(F.col("table").alias("table_full")), "table_full", "left_semi")


def schema_versions(events: DataFrame, earlier: DataFrame) -> DataFrame:
    """`table, version` after the events of one poll, from those before it.

    Adding a table counts one, and so does each column added, dropped or renamed. A dropped
    table has no version any more; a renamed one takes its version along.
    """
    operation = F.col("operation")
    dropped = events.filter(operation == "DROP_TABLE").select("table")
    renamed = events.filter(operation == "RENAME_TABLE").select(F.col("old_table").alias("table"), "new_table")
    kept = earlier.select("table", "version").join(dropped, "table", "left_anti").join(renamed, "table", "left")
    counted = events.filter(operation.isin("ADD_TABLE", "ADD_COLUMN", "DROP_COLUMN", "RENAME_COLUMN"))
    parts = kept.select(F.coalesce("new_table", "table").alias("table"), F.col("version").cast("bigint").alias("version"))
    parts = parts.unionByName(counted.select("table", F.lit(1).cast("bigint").alias("version")))
    return parts.groupBy("table").agg(F.sum("version").alias("version"))
