"""Change events folded in Spark's state store: by a processor of our own, and the state read back.

A processor keeps one row of state per key, the running values of the fold. Each task folds
its own events before the shuffle, so a key with very many of them costs one row for each
`FOLD_ROWS` of a task's events. Deleted rows may be forgotten after a time, and columns may be added between two runs.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from typing import Any

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from changelake.operators.fold import finished

AVAILABLE_NOW = {"availableNow": True}
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: What a processor's state needs; Avro lets a later run add columns to it.
SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    "spark.sql.streaming.stateStore.encodingFormat": "avro",
}
#: With timers on the clock Spark would go on with empty micro-batches, and a run under
#: `availableNow` would not end; so they expire in micro-batches that have events.
TIMED = {"spark.sql.streaming.noDataMicroBatches.enabled": "false"}
#: Name of the state, and of its columns before those of the image.
STATE = "state"
VALUES = ("first", "delete", "insert", "seq", "operation")
#: Rows, and bytes, that a task folds at once; rows of a batch that it returns.
FOLD_ROWS, FOLD_BYTES, OUT_ROWS = 1 << 17, 1 << 26, 10_000


@contextmanager
def _settings(spark: SparkSession, wanted: Mapping[str, str]) -> Iterator[None]:
    """A query keeps the settings of the session that it starts in."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def _folded(batches: list[pa.RecordBatch], key: Sequence[str]) -> list[pa.RecordBatch]:
    """One row per key of these batches: `first`, `delete`, `insert`, and the last image with its `seq` and `operation`."""
    rows = pa.Table.from_batches(batches).sort_by("seq")
    deletes = pc.equal(rows["operation"], "DELETE")
    inserts = pc.is_in(rows["operation"], pa.array(["INSERT", "INITIAL_LOAD"]))
    none = pa.scalar(None, rows["seq"].type)
    place = pa.array(range(rows.num_rows), pa.int64())
    named = {
        "first": pc.if_else(deletes, none, rows["seq"]),
        "delete": pc.if_else(deletes, rows["seq"], none),
        "insert": pc.if_else(inserts, rows["seq"], none),
        "place": pc.if_else(deletes, pa.scalar(None, pa.int64()), place),
    }
    grouped = pa.table({**{f"k{i}": rows[name] for i, name in enumerate(key)}, **named}).group_by([f"k{i}" for i in range(len(key))])
    out = grouped.aggregate([("first", "min"), ("delete", "max"), ("insert", "max"), ("place", "max")])
    # The last image lies at the greatest place; a key with deletes alone has none.
    last = rows.take(out["place_max"])
    arrays = [out[f"k{i}"] for i in range(len(key))] + [out[f"{name}_{how}"] for name, how in (("first", "min"), ("delete", "max"), ("insert", "max"))]
    held = [name for name in rows.column_names if name not in key]
    return pa.table(dict(zip([*key, *VALUES[:3], *held], arrays + [last[name] for name in held]))).combine_chunks().to_batches(OUT_ROWS)


def fold_partly(events: DataFrame, key: Sequence[str], seq: str, image: Sequence[str], op: str = "operation") -> DataFrame:
    """Running values per key of each `FOLD_ROWS` of a task's `events`; works on streams, without a shuffle."""
    order = events.schema[seq].dataType
    values = [StructField(name, order) for name in VALUES[:4]] + [StructField("operation", StringType())]
    fields = [events.schema[name] for name in key] + values + [StructField(name, events.schema[name].dataType) for name in image]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, number, size = [], 0, 0
        for batch in batches:
            held.append(batch)
            number, size = number + batch.num_rows, size + batch.nbytes
            if number >= FOLD_ROWS or size >= FOLD_BYTES:
                yield from _folded(held, key)
                held, number, size = [], 0, 0
        if number:
            yield from _folded(held, key)

    rows = events.select(*key, F.col(seq).alias("seq"), F.col(op).alias("operation"), *image)
    return rows.mapInArrow(run, StructType(fields))


def _least(one: Any, two: Any) -> Any:
    return two if one is None else one if two is None else min(one, two)


def _greatest(one: Any, two: Any) -> Any:
    return two if one is None else one if two is None else max(one, two)


class FoldProcessor(StatefulProcessor):
    """State of one key: the running values and the last image.

    With `keep_ms`, a row that is deleted, or known by deletes alone, is forgotten that long
    after it was last written, unless an event came in between.
    """

    def __init__(self, state: StructType, key: Sequence[str], image: Sequence[str], keep_ms: int | None) -> None:
        self.schema, self.key, self.image, self.keep_ms = state, key, image, keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState(STATE, self.schema)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        # Absent state is None: no call of its own asks whether there is one.
        first, delete, insert, seq, *last = self.state.get() or (None,) * len(self.schema)
        for row in rows:
            first, delete, insert = _least(first, row["first"]), _greatest(delete, row["delete"]), _greatest(insert, row["insert"])
            if row["seq"] is not None and (seq is None or row["seq"] > seq):
                seq, last = row["seq"], [row["operation"], *[row[name] for name in self.image]]
        self.state.update((first, delete, insert, seq, *last))
        deleted = first is not None and delete is not None and delete > first and (insert is None or delete > insert)
        if self.keep_ms is not None:
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            if deleted or first is None:
                self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.keep_ms)
        if first is not None:
            by_delete = delete is not None and delete > seq
            names = [*self.key, *self.image, "_operation", "_seq", "deleted"]
            yield Row(*names)(*key, *last[1:], "DELETE" if by_delete else last[0], delete if by_delete else seq, deleted)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        self.state.clear()
        return iter(())

    def close(self) -> None:
        pass


def start_processor_stream(
    events: DataFrame,
    key: Sequence[str],
    seq: str,
    image: Sequence[str],
    path: str,
    checkpoint: str,
    op: str = "operation",
    keep_ms: int | None = None,
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Fold a stream of events in a processor; the rows that changed are written below `path` by micro-batch.

    A later run on the same checkpoint goes on with the state; it may name further columns at the end of
    `image`, which rows written before have as null. `keep_ms` bounds how long deleted rows
    are remembered after their last event: an update that comes later finds no row and makes a live one.
    They go with the first micro-batch after that time.
    """
    partly = fold_partly(events, key, seq, image, op)
    state = StructType([StructField(field.name, field.dataType) for field in partly.schema.fields[len(key) :]])
    out = [*[partly.schema[name] for name in (*key, *image)], StructField("_operation", StringType()), StructField("_seq", partly.schema["seq"].dataType)]

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    rows = partly.groupBy(*key).transformWithState(
        FoldProcessor(state, list(key), list(image), keep_ms),
        StructType([*out, StructField("deleted", BooleanType())]),
        "update",
        "None" if keep_ms is None else "ProcessingTime",
    )
    with _settings(events.sparkSession, SETTINGS if keep_ms is None else {**SETTINGS, **TIMED}):
        return (
            rows.writeStream.outputMode("update")
            .foreachBatch(put)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or AVAILABLE_NOW))
            .start()
        )


def processor_state(spark: SparkSession, checkpoint: str, key: Sequence[str], image: Sequence[str]) -> DataFrame:
    """Current rows of a processor stream, read from its state: one row per key, whatever was written before."""
    with _settings(spark, SETTINGS):
        state = spark.read.format("statestore").option("stateVarName", STATE).load(checkpoint)
    held = {field.name for field in state.schema["value"].dataType}
    columns = [F.col(f"value.{name}").alias(name) if name in held else F.lit(None).alias(name) for name in ("seq", "operation", *image)]
    state = state.select(
        *[F.col(f"key.{name}").alias(name) for name in key],
        *[F.col(f"value.{name}").alias(f"_{name}") for name in VALUES[:3]],
        F.lit(None).cast("boolean").alias("_flag"),
        F.when(F.col("value.seq").isNotNull(), F.struct(*columns)).alias("_image"),
    )
    return finished(state, key, image)


def aggregate_state(spark: SparkSession, checkpoint: str, key: Sequence[str], image: Sequence[str]) -> DataFrame:
    """Current rows of a stream started by `start_state_stream`, read from its state: one row per key."""
    state = spark.read.format("statestore").load(checkpoint)
    # The aggregates' buffers in their order: minimum, three maxima, last image and its order.
    buffers = state.schema["value"].dataType.fields
    kept = ("_first", "_delete", "_insert", "_flag", "_image", "_at")
    named = StructType([StructField(name, field.dataType) for name, field in zip(kept, buffers, strict=True)])
    state = state.select(*[F.col(f"key.{name}").alias(name) for name in key], F.col("value").cast(named).alias("value"))
    return finished(state.select(*key, "value.*"), key, image)
