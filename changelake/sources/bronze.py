"""The bronze area: an append-only log per batch, compacted bases, commits.

    log/batch_id=N                    row events, sorted by table and row
    schema_events/batch_id=N          schema events
    quarantine/batch_id=N             events that cannot be applied, with the fault
    commits/batch_id=N                counts per table
    batches/batch_id=N                one row, written last: the batch is whole
    base/upto=N                       state of all rows after batch N
    bases/upto=N                      one row, written last: the base is whole
    change_log/through=N              before and after images of the batches since the last part
    totals/through=N                  commits of that part, with rows born and alive and the schema id
    heads/through=N                   one row per table: rows alive and schema id after that part
    parts/through=N                   one row, written last: the part is whole
    closed/upto=N/NAME                schema events, quarantine, commits and numbers of many batches
    logs/upto=N                       row events of many batches that were written at once
    closes/upto=N                     one row, written last: that set of files is whole

A batch is written with overwrite under its own number, so a replayed batch
replaces itself. Parts of the change log are added and never written again.
Whole batches but the last are closed now and then: their small folders become
one set of files, so the folders don't grow with the batches. Many new batches
at once are such a set from the start.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from changelake.functions.keys import record_id
from changelake.operators.commits import GROUP, batch_summary, carried_totals, effective_counts, heads_after
from changelake.operators.envelope import SCHEMA_FIELDS, split_valid
from changelake.operators.evolve import evolve_log, table_rules
from changelake.operators.fold import change_log, fold_state
from changelake.operators.scan import BITS
from changelake.session import scratch_dir
from changelake.sources.readers import OFFSET_BITS, read_or_empty

# Folders that closed batches leave.
CLOSED = ("schema_events", "quarantine", "commits", "batches")
#: New batches that `append_all` gives folders of their own; more of them become one set of files.
MOST_FOLDERS = 64

KEY = ["table_key", "row_key"]
IMAGE = ["source", "data"]

_LOG = {
    "seq": "bigint",
    "operation": "string",
    "source": "string",
    "timestamp": "string",
    "data": "map<string,string>",
    "row_key": "string",
    "processed_at": "timestamp",
    "table_key": "string",
}
_SCHEMA_EVENT = {
    "seq": "bigint",
    "operation": "string",
    "database": "string",
    "table": "string",
    "source": "string",
    "columns": "string",
    **dict.fromkeys(SCHEMA_FIELDS, "string"),
}
_QUARANTINE = {"seq": "bigint", "value": "string", "fault": "string"}
_COMMIT = {
    "table_key": "string",
    "commit_type": "string",
    "operation": "string",
    "total": "bigint",
    "inserts": "bigint",
    "updates": "bigint",
    "deletes": "bigint",
    "schema_events": "bigint",
    "processed_at": "timestamp",
    "duration_ms": "bigint",
}
_TOTALS = {
    **_COMMIT,
    "batch_id": "bigint",
    "new_rows": "bigint",
    "effective_deletes": "bigint",
    "total_records": "bigint",
    "schema_id": "bigint",
}
_HEADS = {"table_key": "string", "total_records": "bigint", "schema_id": "bigint"}
_STATE = {
    "table_key": "string",
    "row_key": "string",
    "source": "string",
    "data": "map<string,string>",
    "_operation": "string",
    "_seq": "bigint",
    "deleted": "boolean",
}


def _schema(columns: dict[str, str], number: str) -> str:
    return ", ".join(f"`{name}` {kind}" for name, kind in {**columns, number: "bigint"}.items())


class Bronze:
    """Reads and writes one bronze area below a base URI.

    `seq` is the type of the sequence numbers: bigint, or `SEQUENCE` where topics are read
    across. The change log then cuts a key's events by seconds.
    """

    def __init__(self, spark: SparkSession, base_uri: str, seq: str = "bigint"):
        self.spark = spark
        self.base = base_uri.rstrip("/")
        self.bits = BITS if seq == "bigint" else OFFSET_BITS + 10
        self.log_columns, self.schema_columns, self.bad_columns = ({**c, "seq": seq} for c in (_LOG, _SCHEMA_EVENT, _QUARANTINE))
        self.state_columns = {**_STATE, "_seq": seq}
        self.small = dict(zip(CLOSED, (self.schema_columns, self.bad_columns, _COMMIT, {}), strict=True))

    def _write(self, df: DataFrame, folder: str, sort: Sequence[str] = (), by: Sequence[str] = ()) -> None:
        if sort:
            # Sizes the files by their data, hot tables being split; a table's rows lie
            # together, so a reader of one table skips the others by file statistics.
            df = df.hint("rebalance", *[F.col(c) for c in (*by, sort[0])]).sortWithinPartitions(*by, *sort)
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if by else "static")
        (writer.partitionBy(*by) if by else writer).parquet(f"{self.base}/{folder}")

    def _delete(self, uri: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(uri)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def _drop(self, folder: str) -> None:
        self._delete(f"{self.base}/{folder}")

    @contextmanager
    def _once(self, events: DataFrame) -> Iterator[DataFrame]:
        """Events that several folders are written from, computed once; the copy goes with the block."""
        if events.is_cached:
            yield events
            return
        folder = scratch_dir(self.spark, "events")
        try:
            events.write.parquet(folder)
            yield self.spark.read.schema(events.schema).parquet(folder)
        finally:
            self._delete(folder)

    def _mark(self, folder: str) -> None:
        self._write(self.spark.range(1).coalesce(1), folder)

    def _read(self, name: str, columns: dict[str, str], number: str = "batch_id") -> DataFrame:
        return read_or_empty(self.spark, f"{self.base}/{name}", _schema(columns, number))

    def _numbers(self, name: str) -> list[int]:
        """Numbers of the folders below one."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = [folder.getPath().getName() for folder in files.listStatus(path)] if files.exists(path) else []
        # Rows without a number lie in a folder that has none.
        return sorted(int(number) for name in found if (number := name.partition("=")[2]).lstrip("-").isdigit())

    def _sets(self) -> list[Row]:
        """`after, upto, batches` of the sets of closed batches in use, the latest first.

        A set that a wider one has replaced ends within it, so no set in use begins where it ends.
        """
        closes = {row.upto: row for row in self._read("closes", {"after": "bigint", "batches": "bigint"}, "upto").collect()}
        upto, sets = max(closes, default=None), []
        while upto in closes:
            sets.append(closes[upto])
            upto = closes[upto].after
        return sets

    def _open(self, sets: list[Row]) -> DataFrame:
        """Numbers of the whole batches that are not closed."""
        batches = self._read("batches", {"id": "bigint"}).select("batch_id")
        return batches.filter(F.col("batch_id") > sets[0].upto) if sets else batches

    def _closed(self, name: str, sets: list[Row]) -> list[DataFrame]:
        schema = _schema(self.small[name], "batch_id")
        return [self.spark.read.schema(schema).parquet(f"{self.base}/closed/upto={row.upto}/{name}") for row in sets]

    def _batches(self, sets: list[Row] | None = None) -> DataFrame:
        """Numbers of all whole batches."""
        sets = self._sets() if sets is None else sets
        return reduce(DataFrame.unionByName, self._closed("batches", sets), self._open(sets))

    def _whole(self, name: str, columns: dict[str, str]) -> DataFrame:
        sets = self._sets()
        rows = self._read(name, columns)
        if name not in self.small:
            if name == "log" and sets:
                many = self._read("logs", {**columns, "batch_id": "bigint"}, "upto").filter(F.col("upto") <= sets[0].upto)
                rows = rows.unionByName(many.drop("upto"))
            return rows.join(self._batches(sets), "batch_id", "left_semi")
        if sets:
            rows = rows.filter(F.col("batch_id") > sets[0].upto)
        return reduce(DataFrame.unionByName, self._closed(name, sets), rows.join(self._open(sets), "batch_id", "left_semi"))

    def append(self, events: DataFrame, batch_id: int) -> None:
        """Write one batch of parsed, identified events; one that is closed already stays as it is."""
        start = time.monotonic()
        sets = self._sets()
        if sets and batch_id <= sets[0].upto:
            if self._batches(sets).filter(F.col("batch_id") == batch_id).isEmpty():
                raise ValueError(f"batch {batch_id} is older than the closed ones, up to {sets[0].upto}")
            return
        self._drop_unfinished(sets)
        at = f"batch_id={batch_id}"
        with self._once(events) as found:
            rows, schema, bad = self._parts(found)
            self._write(rows.select(*self.log_columns), f"log/{at}", ["table_key", "row_key"])
            self._write(schema.select(*_SCHEMA_EVENT), f"schema_events/{at}")
            self._write(bad.select(*_QUARANTINE), f"quarantine/{at}")
            numbered = [df.withColumn("batch_id", F.lit(batch_id).cast("bigint")) for df in (rows, schema)]
            commits = self._commit_rows(*numbered).withColumn("duration_ms", F.lit(round(1000 * (time.monotonic() - start))))
            self._write(commits.select(*_COMMIT), f"commits/{at}")
        self._mark(f"batches/{at}")

    def append_all(self, events: DataFrame) -> None:
        """Write many batches at once, numbered by `batch_id`: a first load, or a replay of open ones.

        More than `MOST_FOLDERS` new batches, all later than those there are, become one set of
        files and are closed with it.
        """
        with self._once(events) as found:
            self._append_all(found)

    def _append_all(self, events: DataFrame) -> None:
        sets = self._sets()
        if sets and not events.filter(F.col("batch_id") <= sets[0].upto).isEmpty():
            raise ValueError(f"batches up to {sets[0].upto} are closed")
        self._drop_unfinished(sets)
        rows, schema, bad = self._parts(events)
        commits = self._commit_rows(rows, schema).withColumn("duration_ms", F.lit(None).cast("bigint"))
        numbers = events.select("batch_id", F.col("batch_id").alias("id")).distinct()
        first, last, count = numbers.agg(F.min("id"), F.max("id"), F.count("id")).first()
        there = max((number for name in ("log", *CLOSED) for number in self._numbers(name)), default=None)
        if count > MOST_FOLDERS and (there is None or there < first):
            # Lies beside the log, and is read once the set is there.
            self._write(rows.select(*self.log_columns, "batch_id"), f"logs/upto={last}", ["table_key", "row_key"])
            whole = self._open(sets).agg(F.min("batch_id"), F.count_distinct("batch_id")).first()
            after = sets[0].upto if sets else min(first, first if whole[0] is None else whole[0]) - 1
            new = {"schema_events": schema, "quarantine": bad, "commits": commits, "batches": numbers.select("batch_id")}
            self._write_set(sets, after, last, count + whole[1], new)
            return
        for df, folder, columns, sort in (
            (rows, "log", _LOG, ["table_key", "row_key"]),
            (schema, "schema_events", _SCHEMA_EVENT, ["seq"]),
            (bad, "quarantine", _QUARANTINE, ["seq"]),
            (commits, "commits", _COMMIT, ["table_key"]),
        ):
            self._write(df.select(*columns, "batch_id"), folder, sort, ["batch_id"])
        self._write(numbers, "batches", ["id"], ["batch_id"])

    def _drop_unfinished(self, sets: list[Row]) -> None:
        """Delete row events of many batches whose set of files was never whole."""
        for number in self._numbers("logs"):
            if not sets or number > sets[0].upto:
                self._drop(f"logs/upto={number}")

    def _parts(self, events: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        good, bad = split_valid(events.withColumn("processed_at", F.current_timestamp()))
        return good.filter("route <> 'schema'"), good.filter("route = 'schema'"), bad

    def _commit_rows(self, rows: DataFrame, schema: DataFrame) -> DataFrame:
        """What each batch brought each table; a renamed table is filed under its old name."""
        table_key = F.concat_ws(".", "database", F.coalesce("table", "old_table"))
        changes = schema.groupBy("batch_id", table_key.alias("table_key")).agg(F.count("*").alias("schema_events"))
        both = batch_summary(rows).join(changes, list(GROUP), "full_outer")
        counts = [c for c in ("total", "inserts", "updates", "deletes", "schema_events")]
        commit_type = F.when(F.col("schema_events") > 0, "schema_change").otherwise(F.col("commit_type"))
        return both.select(
            *GROUP,
            commit_type.alias("commit_type"),
            F.coalesce("operation", F.lit("ddl")).alias("operation"),
            *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
            F.current_timestamp().alias("processed_at"),
        )

    def log(self) -> DataFrame:
        return self._whole("log", self.log_columns)

    def schema_events(self) -> DataFrame:
        return self._whole("schema_events", self.schema_columns)

    def quarantine(self) -> DataFrame:
        return self._whole("quarantine", self.bad_columns)

    def commits(self) -> DataFrame:
        """Commits with the rows of the table after each, as far as the change log is stored.

        `schema_id` counts the schema events of the table up to the commit. Parts of the change
        log keep both with their commits; only commits since the last part are scanned, on from
        where it ended.
        """
        done = self._logged()
        parts = self._read("parts", {"id": "bigint"}, "through").select("through")
        totals = self._read("totals", _TOTALS, "through").join(parts, "through", "left_semi")
        place = F.concat(F.lit(f"{self.base}/change_log/through="), F.col("through").cast("string"))
        counted = F.col("new_rows").isNotNull()
        # Rows without a commit are those of a table that the part has under a later name.
        stored = totals.filter("total IS NOT NULL").withColumns(
            {"total_records": F.when(counted, F.col("total_records")), "change_log": F.when(counted, place)}
        )
        since = self._whole("commits", _COMMIT).filter(F.col("batch_id") > done)
        columns = [*GROUP, *[c for c in _COMMIT if c != "table_key"], "schema_id", "new_rows", "effective_deletes", "total_records", "change_log"]
        if since.isEmpty():
            return stored.select(columns)
        none = {c: F.lit(None).cast("bigint") for c in ("new_rows", "effective_deletes")}
        later = carried_totals(since.withColumns(none), self._heads(done))
        later = later.withColumns({"total_records": F.lit(None).cast("bigint"), "change_log": F.lit(None).cast("string")})
        return stored.select(columns).unionByName(later.select(columns))

    def _heads(self, part: int) -> DataFrame:
        return self._read("heads", _HEADS, "through").filter(F.col("through") == part).drop("through")

    def tables(self) -> DataFrame:
        """`table_key`, `columns` (name to type) of the registered tables, also of those without rows.

        Tables and columns are registered by `ADD_TABLE` and `ADD_COLUMN`, and stand under
        their present names.
        """
        schema = self.schema_events()
        added = F.when(F.col("operation") == "ADD_TABLE", F.from_json("columns", "map<string,string>"))
        added = added.when(F.col("operation") == "ADD_COLUMN", F.create_map(F.col("column"), F.coalesce("data_type", F.lit(""))))
        none = F.from_json(F.lit("{}"), "map<string,string>")
        rows = schema.filter(F.col("operation").isin("ADD_TABLE", "ADD_COLUMN")).select(
            F.concat_ws(".", "database", "table").alias("table_key"), "seq", F.coalesce(added, none).alias("data")
        )
        present = evolve_log(rows, schema.filter("operation <> 'ADD_COLUMN'"))
        entries = present.select("table_key", F.explode_outer(F.map_entries("data")).alias("e"))
        last = entries.groupBy("table_key", F.col("e.key").alias("key")).agg(F.max("e.value").alias("value"))
        pairs = F.collect_list(F.when(F.col("key").isNotNull(), F.struct("key", "value")))
        return last.groupBy("table_key").agg(F.map_from_entries(pairs).alias("columns"))

    def _base(self) -> tuple[DataFrame | None, int]:
        """The last whole base and the batch it reaches."""
        bases = self._read("bases", {"id": "bigint"}, "upto")
        upto = bases.agg(F.max("upto")).first()[0]
        if upto is None:
            return None, -1
        return read_or_empty(self.spark, f"{self.base}/base/upto={upto}", self._state_schema()), upto

    def _state_schema(self) -> str:
        return ", ".join(f"`{name}` {kind}" for name, kind in self.state_columns.items())

    def _inputs(
        self, through: int | None = None, table_key: str | None = None
    ) -> tuple[DataFrame | None, DataFrame]:
        """Base, and events after it, both in the schema of the last schema event.

        For one table, only folders under its present and earlier names are read.
        """
        base, upto = self._base()
        log, schema = self.log().filter(F.col("batch_id") > upto), self.schema_events()
        if through is not None:
            log, schema = (df.filter(F.col("batch_id") <= through) for df in (log, schema))
        if schema.isEmpty():
            only = F.lit(True) if table_key is None else F.col("table_key") == table_key
            return base if base is None else base.filter(only), log.filter(only)
        tables = table_rules(schema)
        if table_key is not None:
            was = tables.filter(F.exists("tables", lambda step: step["name"] == table_key)).select("table_key")
            # As many names as a table has had.
            only = F.col("table_key").isin(table_key, *[row.table_key for row in was.collect()])
            base, log = base if base is None else base.filter(only), log.filter(only)
        if base is not None:
            oldest = base.withColumn("seq", F.lit(-(2**63)).cast(self.log_columns["seq"]))
            base = evolve_log(oldest, schema.filter(F.col("batch_id") > upto)).drop("seq")
        return base, evolve_log(log, schema, tables)

    def state(self, table_key: str | None = None) -> DataFrame:
        """Current rows of all tables or one, soft-deleted ones flagged, with `record_id`."""
        base, events = self._inputs(table_key=table_key)
        state = fold_state(events, KEY, "seq", IMAGE, base=base)
        table = F.substring_index("table_key", ".", -1)
        database = F.expr("substring(table_key, 1, length(table_key) - length(`table`) - 1)")
        return (
            state.withColumn("table", table)
            .withColumn("database", database)
            .withColumn("record_id", record_id(F.col("database"), F.col("table"), F.col("row_key")))
        )

    def table(self, table_key: str, columns: Sequence[str]) -> DataFrame:
        """One table as text columns with its `deleted` flag."""
        rows = self.state(table_key).filter(F.col("table_key") == table_key)
        return rows.select(
            "record_id", *[F.col("data")[c].alias(c) for c in columns], "deleted"
        )

    def _logged(self) -> int:
        """The last batch whose changes are stored."""
        last = self._read("parts", {"id": "bigint"}, "through").agg(F.max("through")).first()[0]
        return -1 if last is None else last

    def change_log(self, after: int | None = None, through: int | None = None) -> DataFrame:
        """Before and after images of the events of the batches after one, up to another.

        Without bounds, of all batches since the last base. The images start from the state
        that the last base or the events before `after` give, whichever is there.
        """
        base, upto = self._base()
        if after is None or after == upto:
            base, events = self._inputs(through)
            return change_log(events, KEY, "seq", IMAGE, base=base, keep=["batch_id"], bits=self.bits)
        if after < upto:
            raise ValueError(f"the events between batch {after} and the base at {upto} are folded already")
        base, events = self._inputs(through)
        early = fold_state(events.filter(F.col("batch_id") <= after), KEY, "seq", IMAGE, base=base)
        return change_log(events.filter(F.col("batch_id") > after), KEY, "seq", IMAGE, base=early, keep=["batch_id"], bits=self.bits)

    def write_change_log(self) -> int | None:
        """Add the changes of the whole batches since the last part; returns the last of these batches.

        Images have the column names of the time they are stored.
        """
        done = self._logged()
        through = self._batches().agg(F.max("batch_id")).first()[0]
        if through is None or through <= done:
            return None
        part = f"through={through}"
        changes = self.change_log(done, through)
        self._write(changes, f"change_log/{part}", ["table_key", "batch_id"])
        stored = self.spark.read.parquet(f"{self.base}/change_log/{part}")
        commits = self._whole("commits", _COMMIT).filter(F.col("batch_id").between(done + 1, through))
        counts = commits.join(effective_counts(stored), list(GROUP), "full_outer")
        earlier = self._heads(done)
        self._write(carried_totals(counts, earlier), f"totals/{part}", ["batch_id"])
        totals = self.spark.read.parquet(f"{self.base}/totals/{part}")
        self._write(heads_after(totals, earlier), f"heads/{part}", ["table_key"])
        self._mark(f"parts/{part}")
        return through

    def stored_change_log(self) -> DataFrame:
        """All changes stored so far."""
        parts = self._read("parts", {"id": "bigint"}, "through").select("through")
        if parts.isEmpty():
            return self.change_log().limit(0)
        return self.spark.read.parquet(f"{self.base}/change_log").join(parts, "through", "left_semi").drop("through")

    def effective_counts(self) -> DataFrame:
        return effective_counts(self.change_log())

    def close_batches(self, grace: bool = True) -> int | None:
        """Put the small folders of whole batches into one set of files; returns the last batch closed.

        The last whole batch stays open, as a stream may write it again. The new set takes in the
        latest ones that have no more batches than it has so far: there are as many sets as the
        logarithm of the batches, and a batch is written as often at most.

        What a set replaces is deleted by the next call, so readers that have planned on it may
        go on; without `grace` it is deleted at once.
        """
        old = sets = self._sets()
        found = self._open(sets).agg(F.min("batch_id"), F.max("batch_id"), F.count_distinct("batch_id")).first()
        first, last, count = found
        if count > 1:
            upto = self._open(sets).filter(F.col("batch_id") < last).agg(F.max("batch_id")).first()[0]
            self._write_set(sets, sets[0].upto if sets else first - 1, upto, count - 1)
        kept = old if grace else self._sets()
        if kept:
            for name in self.small:
                for number in self._numbers(name):
                    if number <= kept[0].upto:
                        self._drop(f"{name}/batch_id={number}")
            used = {row.upto for row in (*kept, *self._sets())}
            for number in self._numbers("closed"):
                if number < kept[0].upto and number not in used:
                    self._drop(f"closes/upto={number}")
                    self._drop(f"closed/upto={number}")
        sets = self._sets()
        return sets[0].upto if sets else None

    def _write_set(self, old: list[Row], after: int, upto: int, held: int, new: dict[str, DataFrame] | None = None) -> None:
        """One set of the `held` batches after one, up to another, and of the latest sets that have no more.

        `new` are rows of batches that have no folders.
        """
        sets = old
        while sets and sets[0].batches <= held:
            after, held, sets = sets[0].after, held + sets[0].batches, sets[1:]
        for name, columns in self.small.items():
            rows = self._batches(old) if name == "batches" else self._whole(name, columns)
            rows = rows.filter((F.col("batch_id") > after) & (F.col("batch_id") <= upto))
            if new:
                rows = rows.unionByName(new[name].select(rows.columns).filter("batch_id IS NOT NULL"))
            self._write(rows.distinct() if name == "batches" else rows, f"closed/upto={upto}/{name}", ["batch_id"])
        mark = self.spark.range(1).select(F.lit(after).cast("bigint").alias("after"), F.lit(held).cast("bigint").alias("batches"))
        self._write(mark.coalesce(1), f"closes/upto={upto}")

    def compact(self, clean: bool = True, grace: bool = True) -> int | None:
        """Fold the whole batches into a new base; returns the batch it reaches.

        Their changes are stored first. With `clean`, row events that a base and the change
        log hold, and bases before the last two, are deleted, and batches are closed
        (`close_batches`, with its `grace`); no schema events, commits or quarantine go. A
        reader that has planned on the base before may go on.
        """
        self.write_change_log()
        through = self._batches().agg(F.max("batch_id")).first()[0]
        if through is None:
            return None
        bases = sorted(row.upto for row in self._read("bases", {"id": "bigint"}, "upto").select("upto").distinct().collect())
        if not bases or bases[-1] != through:
            base, events = self._inputs(through)
            state = fold_state(events, KEY, "seq", IMAGE, base=base)
            self._write(state.select(*_STATE), f"base/upto={through}", ["table_key", "row_key"])
            self._mark(f"bases/upto={through}")
            if clean and bases:
                # Batches behind the base before this one; that base still serves readers.
                for number in self._numbers("log"):
                    if number <= bases[-1]:
                        self._drop(f"log/batch_id={number}")
                for number in self._numbers("logs"):
                    if number <= bases[-1]:
                        self._drop(f"logs/upto={number}")
                for upto in bases[:-1]:
                    self._drop(f"bases/upto={upto}")
                    self._drop(f"base/upto={upto}")
        if clean:
            self.close_batches(grace)
        return through
