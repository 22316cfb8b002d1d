"""Polls on stored snapshots: each source table is read once a poll.

A poll first writes what it read, then derives all else from the written rows: a digest per
row id, bucketed by id, which is compared with the one that the last whole poll left. Two
bucketed tables are joined bucket to bucket, so neither is shuffled; rows are read for the
ids that differ alone. A table that fails, when it is read or when it is written, fails by itself.

    area = Snapshots(spark, base_uri)
    poll = area.poll(tables, schema_events, database, source, at)
    ...                       # deliver poll.messages
    poll.commit()             # these snapshots are what the next poll compares with

Until the commit, a poll run again compares with the same snapshots as before: messages
reach the topics once at least. Snapshots that no manifest names any more are deleted.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from changelake.functions.keys import row_id
from changelake.operators.diff import ROW_ID, briefed, compared_rows, last_by_hash
from changelake.operators.evolve import apply_schema_events
from changelake.plans.poll import Polled, change_messages, column_events, load_messages

#: Buckets of the digests. The next poll has to use as many, else the digests are shuffled again.
BUCKETS = 64
_MANIFEST = "poll bigint, name string, status string, detail string"
WHOLE = "WHOLE"


@dataclass(frozen=True)
class Kept:
    """A stored snapshot: the folder of its rows, their digests, and how they were made."""

    spark: SparkSession
    folder: str
    schema: StructType
    key: str | None
    unique: bool
    order: tuple[str, ...] = ()
    buckets: int = BUCKETS

    @property
    def detail(self) -> str:
        made = {"key": self.key, "unique": self.unique, "order": list(self.order), "buckets": self.buckets}
        return json.dumps({"folder": self.folder, "schema": self.schema.jsonValue(), **made})

    @classmethod
    def of(cls, spark: SparkSession, detail: str) -> Kept:
        held = json.loads(detail)
        held["schema"], held["order"] = StructType.fromJson(held["schema"]), tuple(held["order"])
        return cls(spark, **held)

    def rows(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.folder}/rows")

    def _brief(self) -> DataFrame:
        return briefed(self.rows(), self.key, self.schema.names, self.order, self.unique).select(ROW_ID, "_same1", "_same2")

    def write(self, df: DataFrame) -> Kept:
        """Stores the rows, the only time that `df` is read, then the digests of what was stored."""
        df.write.mode("overwrite").parquet(f"{self.folder}/rows")
        digests = self._brief().repartition(self.buckets, ROW_ID)
        self.spark.sql(f"DROP TABLE IF EXISTS {self._name}")
        writer = digests.write.mode("overwrite").bucketBy(self.buckets, ROW_ID).sortBy(ROW_ID)
        writer.option("path", f"{self.folder}/digests").format("parquet").saveAsTable(self._name)
        return self

    @property
    def _name(self) -> str:
        """Name of the digests in the session's catalog, which knows of their buckets."""
        return "kept_" + "".join(c if c.isalnum() else "_" for c in self.folder.lower())[-100:]

    def digests(self) -> DataFrame:
        """`_row_id` and two hashes of all columns; bucketed and sorted by id."""
        if not self.spark.catalog.tableExists(self._name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self._brief().schema.fields)
            self.spark.sql(
                f"CREATE TABLE {self._name} ({columns}) USING parquet CLUSTERED BY ({ROW_ID}) SORTED BY ({ROW_ID})"
                f" INTO {self.buckets} BUCKETS LOCATION '{self.folder}/digests'"
            )
        return self.spark.table(self._name)

    def evolved(self, events: Sequence[dict]) -> DataFrame:
        return apply_schema_events(self.rows(), events)

    def comparable(self, other: Kept) -> bool:
        """Whether the digests of both are those of the same columns under the same ids."""
        return self.schema.names == other.schema.names and [f.dataType for f in self.schema] == [f.dataType for f in other.schema] and (
            (self.key, self.order, self.unique) == (other.key, other.order, other.unique)
        )


def differing(old: Kept, new: Kept, events: Sequence[dict] = ()) -> DataFrame:
    """`_row_id` and `operation` of the ids whose digests differ, in the columns that both have.

    Where the columns are the same, stored digests are joined bucket to bucket. Else those of both
    sides are made anew from the stored rows, with the schema `events` applied to the old ones.
    """
    if not events and old.comparable(new):
        sides = [old.digests(), new.digests()]
    else:
        prev, cur = old.evolved(events), new.rows()
        common = [c for c in prev.columns if c in cur.columns]
        sides = [briefed(df, new.key, common, new.order, new.unique) for df in (prev, cur)]
    left, right = (df.select(ROW_ID, F.struct("_same1", "_same2").alias(side)) for df, side in zip(sides, ("p", "c")))
    operation = F.when(F.col("p").isNull(), "INSERT").when(F.col("c").isNull(), "DELETE").otherwise("UPDATE")
    joined = left.join(right, ROW_ID, "full_outer").filter(~F.col("p").eqNullSafe(F.col("c")))
    return joined.select(ROW_ID, operation.alias("operation"))


def _of_ids(df: DataFrame, ids: DataFrame, kept: Kept) -> DataFrame:
    """The rows of those ids, one for each; Spark broadcasts the ids where they are few."""
    rows = df.withColumn(ROW_ID, row_id(df.columns, kept.key)).join(ids, ROW_ID, "left_semi")
    return rows if kept.unique else last_by_hash(rows, kept.order)


def snapshot_diff_kept(old: Kept, new: Kept, folder: str) -> DataFrame:
    """`_row_id, operation, before, after` of each row that differs, as `snapshot_diff` gives them.

    The ids that differ are stored in `folder`; rows of the snapshots are read for them alone.
    """
    differing(old, new).write.parquet(folder)
    ids = new.spark.read.parquet(folder).select(ROW_ID)
    prev, cur = old.rows(), new.rows()
    return compared_rows(_of_ids(prev, ids, old), _of_ids(cur, ids, new), prev, cur)


@dataclass
class Poll:
    """Messages of a poll, and why tables failed; `commit` once the messages have been delivered."""

    area: Snapshots
    number: int
    messages: DataFrame | None
    failed: dict[str, str]
    kept: dict[str, Kept] = field(default_factory=dict)

    def commit(self) -> None:
        self.area._commit(self)


def _condition(error: PySparkException) -> str:
    return error.getCondition() or type(error).__name__


class Snapshots:
    """Stored snapshots of the tables of one source, in a folder that all executors reach."""

    def __init__(self, spark: SparkSession, base_uri: str, buckets: int = BUCKETS) -> None:
        self.spark, self.base, self.buckets = spark, base_uri.rstrip("/"), buckets

    def manifest(self) -> DataFrame:
        """What each committed poll knows of each table: `WHOLE` with its snapshot, or why it failed."""
        path = f"{self.base}/manifest"
        if not self._exists(path):
            return self.spark.createDataFrame([], _MANIFEST)
        return self.spark.read.schema(_MANIFEST).json(path)

    def last(self) -> dict[str, Kept]:
        """The last whole snapshot of each table."""
        whole = self.manifest().filter(F.col("status") == WHOLE)
        rows = whole.groupBy("name").agg(F.max_by("detail", "poll").alias("detail")).collect()
        return {row["name"]: Kept.of(self.spark, row["detail"]) for row in rows}

    def poll(self, tables: Mapping[str, Polled], schema_events: DataFrame, database: str, source: str, at: Column) -> Poll:
        """Reads each enabled table once, stores it, and compares it with its last whole snapshot.

        `last` of the tables is not used. Column events of this poll are applied to a table's last
        snapshot first. A table without one is loaded whole. Any error of Spark in reading or
        writing a table is its own; it keeps its last snapshot, and the others go on.
        """
        number = (self.manifest().agg(F.max("poll")).first()[0] or 0) + 1
        events, last = column_events(schema_events, tables), self.last()
        out, messages = Poll(self, number, None, {}), []
        for name, table in tables.items():
            if not table.enabled:
                continue
            folder = f"{self.base}/snapshots/{name}/poll={number}"
            try:
                now = table.read()
                new = Kept(self.spark, folder, now.schema, table.key, table.unique, tuple(table.order), self.buckets).write(now)
                messages.append(self._messages(new, last.get(name), events.get(name, ()), (name, database, source, at)))
            except PySparkException as error:
                out.failed[name] = _condition(error)
                continue
            out.kept[name] = new
        out.messages = reduce(DataFrame.unionByName, messages) if messages else None
        return out

    def _messages(self, new: Kept, old: Kept | None, events: Sequence[dict], named: tuple) -> DataFrame:
        if old is None:
            return load_messages(new.rows(), new.key, *named, new.order, new.unique)
        path = f"{new.folder}/changed"
        differing(old, new, events).write.mode("overwrite").parquet(path)
        changed = self.spark.read.parquet(path)
        ids = changed.filter("operation <> 'DELETE'").select(ROW_ID)
        after = _of_ids(new.rows(), ids, new).select(ROW_ID, F.struct(*new.schema.names).alias("after"))
        return change_messages(changed.join(after, ROW_ID, "left"), new.key, *named)

    def _commit(self, poll: Poll) -> None:
        rows = [(poll.number, name, WHOLE, kept.detail) for name, kept in poll.kept.items()]
        rows += [(poll.number, name, reason, None) for name, reason in poll.failed.items()]
        if rows:
            before = {name: kept.folder for name, kept in self.last().items()}
            self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").json(f"{self.base}/manifest/poll={poll.number}")
            for name in poll.kept:
                if name in before and before[name] != poll.kept[name].folder:
                    self._delete(before[name])

    def _path(self, path: str):
        jvm = self.spark._jvm
        held = jvm.org.apache.hadoop.fs.Path(path)
        return held.getFileSystem(self.spark._jsc.hadoopConfiguration()), held

    def _exists(self, path: str) -> bool:
        system, held = self._path(path)
        return system.exists(held)

    def _delete(self, path: str) -> None:
        system, held = self._path(path)
        system.delete(held, True)
