"""Envelopes applied as a stream: a log by micro-batch, or state kept by Spark."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from changelake.operators.envelope import identify, parse_envelope
from changelake.operators.fold import fold_state
from changelake.sources.bronze import Bronze

AVAILABLE_NOW = {"availableNow": True}
#: Names under which the streams report what each micro-batch received.
APPLY_METRICS, STATE_METRICS = "bronze_apply", "keyed_state"


def received(events: DataFrame, name: str) -> DataFrame:
    """`events`, counted as they pass; each progress report of the stream holds the counts."""
    return events.observe(name, F.count(F.lit(1)).alias("events"), F.max("seq").alias("last_seq"))


def start_apply_stream(
    raw: DataFrame,
    base_uri: str,
    checkpoint: str,
    key: str | Mapping[str, str],
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Append each micro-batch of envelopes (`value, seq`) to the bronze area.

    A first load of everything under `availableNow` should be read with a limit per
    micro-batch, for each is kept on executors while its parts are written.

    The micro-batch number is the batch number, and a batch overwrites itself,
    so a batch that is run again after a failure leaves the same result.
    """

    seq = raw.schema["seq"].dataType.simpleString()

    def apply(batch: DataFrame, batch_id: int) -> None:
        events = identify(parse_envelope(batch), key).persist()
        try:
            Bronze(batch.sparkSession, base_uri, seq).append(events, batch_id)
        finally:
            events.unpersist()

    return (
        received(raw, APPLY_METRICS)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def start_state_stream(
    events: DataFrame,
    key: Sequence[str],
    seq: str,
    image: Sequence[str],
    path: str,
    checkpoint: str,
    op: str = "operation",
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Keep the fold of a stream of events in Spark's state store.

    Each micro-batch is reduced before its shuffle, and each key holds one row
    of state. The rows that changed are written below `path` by micro-batch;
    `latest_state` reads them.
    """

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    counted = events.observe(STATE_METRICS, F.count(F.lit(1)).alias("events"), F.max(seq).alias("last_seq"))
    return (
        fold_state(counted, key, seq, image, op)
        .writeStream.outputMode("update")
        .foreachBatch(put)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or AVAILABLE_NOW))
        .start()
    )


def latest_state(changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """The last written row per key of a state stream."""
    rest = [c for c in changes.columns if c not in key and c != "batch_id"]
    last = changes.groupBy(*key).agg(F.max_by(F.struct(*rest), "batch_id").alias("_row"))
    return last.select(*key, "_row.*")
