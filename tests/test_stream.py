"""Streams: equal to the batch fold, repeatable, and compactable."""

import json
import random

import pytest
from pyspark.sql import functions as F

from changelake.operators.envelope import identify, parse_envelope
from changelake.operators.fold import change_log, fold_state
from changelake.sources.bronze import IMAGE, KEY, Bronze
from changelake.sources.readers import SEQUENCE, read_lines_stream, topic_sequence
from changelake.streaming.apply import APPLY_METRICS, latest_state, start_apply_stream, start_state_stream

WIRE = "seq bigint, value string"


def lines(seed=1, n=400):
    rng = random.Random(seed)
    out = []
    for seq in range(n):
        event = {
            "operation": rng.choice(["INSERT", "UPDATE", "DELETE", "OTHER"]),
            "table": rng.choice(["public.a", "b"]),
            "database": "d",
            "source": "mssql",
            "data": {"id": 0 if rng.random() < 0.4 else rng.randrange(9), "v": rng.randrange(50)},
        }
        out.append((seq, json.dumps(event)))
    return out


def put(spark, rows, folder, files):
    size = -(-len(rows) // files)
    for i in range(0, len(rows), size):
        spark.createDataFrame(rows[i : i + size], WIRE).coalesce(1).write.mode("append").json(str(folder))


def run(spark, folder, base, checkpoint, files_per_batch=1):
    raw = read_lines_stream(spark, str(folder), WIRE, files_per_batch)
    start_apply_stream(raw, str(base), str(checkpoint), "id").awaitTermination()
    return Bronze(spark, str(base))


def states(df):
    return {(r.table_key, r.row_key): (r.data, r._operation, r._seq, r.deleted) for r in df.collect()}


def batch_state(spark, rows):
    events = identify(parse_envelope(spark.createDataFrame(rows, WIRE)), "id").filter("fault IS NULL")
    return fold_state(events, KEY, "seq", IMAGE)


def test_stream_is_the_batch(spark, tmp_path):
    rows = lines()
    put(spark, rows, tmp_path / "in", 5)
    bronze = run(spark, tmp_path / "in", tmp_path / "out", tmp_path / "cp")
    assert states(bronze.state()) == states(batch_state(spark, rows))
    other = sum('"OTHER"' in value for _, value in rows)
    assert bronze.quarantine().count() == other
    assert bronze.commits().agg(F.sum("total")).first()[0] == len(rows) - other
    assert bronze.commits().select("batch_id").distinct().count() == 5


def test_repeated_batch_changes_nothing(spark, tmp_path):
    rows = lines(2)
    put(spark, rows, tmp_path / "in", 2)
    bronze = run(spark, tmp_path / "in", tmp_path / "out", tmp_path / "cp")
    before = states(bronze.state())
    run(spark, tmp_path / "in", tmp_path / "out", tmp_path / "second-cp")
    assert states(bronze.state()) == before
    assert bronze.log().count() + bronze.quarantine().count() == len(rows)


def test_unfinished_batch_is_not_read(spark, tmp_path):
    put(spark, lines(3), tmp_path / "in", 1)
    bronze = run(spark, tmp_path / "in", tmp_path / "out", tmp_path / "cp")
    whole = bronze.log().count()
    part = spark.read.parquet(f"{tmp_path}/out/log/batch_id=0")
    part.write.parquet(f"{tmp_path}/out/log/batch_id=1")
    assert bronze.log().count() == whole


def test_compaction(spark, tmp_path):
    rows = lines(4)
    put(spark, rows[:200], tmp_path / "in", 2)
    bronze = run(spark, tmp_path / "in", tmp_path / "out", tmp_path / "cp")
    assert bronze.compact() == 1
    put(spark, rows[200:], tmp_path / "in", 2)
    run(spark, tmp_path / "in", tmp_path / "out", tmp_path / "cp")
    want = states(batch_state(spark, rows))
    assert states(bronze.state()) == want
    since = bronze.change_log().count()
    assert bronze.write_change_log() == 3 and bronze.write_change_log() is None
    log = bronze.stored_change_log()
    assert log.count() == batch_log(spark, rows).count() > since > 0
    assert changes(log) == changes(batch_log(spark, rows))
    assert log.filter("operation = 'INSERT' AND after IS NULL").count() == 0
    assert (tmp_path / "out/log/batch_id=1").exists()
    assert bronze.compact() == 3 and bronze.compact() == 3
    assert not (tmp_path / "out/log/batch_id=1").exists() and (tmp_path / "out/log/batch_id=2").exists()
    assert states(bronze.state()) == want
    assert bronze.change_log().count() == 0
    alive = batch_state(spark, rows).groupBy("table_key").count()
    totals = bronze.commits().groupBy("table_key").agg(F.max_by("total_records", "batch_id").alias("count"))
    assert {tuple(r) for r in totals.collect()} == {tuple(r) for r in alive.collect()}
    assert bronze.commits().filter("change_log IS NULL OR operation IS NULL OR duration_ms IS NULL").count() == 0


def batch_log(spark, rows):
    events = identify(parse_envelope(spark.createDataFrame(rows, WIRE)), "id").filter("fault IS NULL")
    return change_log(events, KEY, "seq", IMAGE)


def changes(log):
    return {(r.table_key, r.row_key, r.seq): (r.operation, r.before, r.after) for r in log.collect()}


def test_times_before_offsets_order_events(spark, tmp_path):
    rows = lines(7)
    plain = identify(parse_envelope(spark.createDataFrame(rows, WIRE)), "id")
    # Two records a millisecond, whose offsets pass a multiple of 2^20.
    time, offset = F.timestamp_millis(F.expr("seq div 2 + 1700000000000")), F.col("seq") + 2**20 - 200
    events = plain.withColumn("at", F.col("seq")).withColumn("seq", topic_sequence(time, offset))
    bronze = Bronze(spark, str(tmp_path / "out"), SEQUENCE)
    for batch, (first, after) in enumerate(((0, 150), (150, 300), (300, 400))):
        bronze.append(events.filter(F.col("at").between(first, after - 1)).drop("at"), batch)
        if batch == 0:
            bronze.compact()
    bronze.write_change_log()
    good = plain.filter("fault IS NULL")
    whole = {key: value[:2] + value[3:] for key, value in states(fold_state(good, KEY, "seq", IMAGE)).items()}
    assert {key: value[:2] + value[3:] for key, value in states(bronze.state()).items()} == whole
    stored = sorted((r.table_key, r.row_key, r.seq, r.operation, str(r.before), str(r.after)) for r in bronze.stored_change_log().collect())
    want = sorted((r.table_key, r.row_key, r.seq, r.operation, str(r.before), str(r.after)) for r in change_log(good, KEY, "seq", IMAGE).collect())
    assert [row[:2] + row[3:] for row in stored] == [row[:2] + row[3:] for row in want]


def test_streams_report_what_they_received(spark, tmp_path):
    rows = lines(6)
    put(spark, rows, tmp_path / "in", 2)
    raw = read_lines_stream(spark, str(tmp_path / "in"), WIRE, 1)
    stream = start_apply_stream(raw, str(tmp_path / "out"), str(tmp_path / "cp"), "id")
    stream.awaitTermination()
    counts = [p.observedMetrics[APPLY_METRICS].events for p in stream.recentProgress if APPLY_METRICS in p.observedMetrics]
    assert sum(counts) == len(rows)


def test_schema_events_across_a_compaction(spark, tmp_path):
    def row(seq, table, **data):
        event = {"operation": "INSERT", "table": table, "database": "d", "source": "mssql", "data": data}
        return (seq, json.dumps(event))

    def ddl(seq, operation, **fields):
        return (seq, json.dumps({"operation": operation, "database": "d", "source": "mssql", **fields}))

    put(spark, [row(1, "t", id=1, x="a"), row(2, "t", id=2, x="b"), ddl(3, "RENAME_COLUMN", table="t", old_column="x", new_column="y"), row(4, "t", id=2, y="c")], tmp_path / "in", 1)
    bronze = run(spark, tmp_path / "in", tmp_path / "out", tmp_path / "cp")
    bronze.compact()
    put(spark, [ddl(5, "RENAME_TABLE", old_table="s.t", new_table="s.u"), ddl(6, "DROP_COLUMN", table="u", column="y"), row(7, "u", id=1, z="d")], tmp_path / "in", 1)
    run(spark, tmp_path / "in", tmp_path / "out", tmp_path / "cp")
    got = {r.record_id: r.data for r in bronze.state().collect()}
    assert got == {"d_u_1": {"id": "1", "z": "d"}, "d_u_2": {"id": "2", "y_deleted": "c"}}
    table = bronze.table("d.u", ["id", "y_deleted"]).orderBy("id").collect()
    assert [(r.id, r.y_deleted, r.deleted) for r in table] == [("1", None, False), ("2", "c", False)]


def test_empty_bronze(spark, tmp_path):
    bronze = Bronze(spark, str(tmp_path / "none"))
    assert bronze.compact() is None and bronze.state().count() == 0


@pytest.mark.parametrize("files", [1, 4])
def test_keyed_state_is_the_batch(spark, tmp_path, files):
    rows = lines(5, 200)
    put(spark, rows, tmp_path / "in", files)
    events = identify(parse_envelope(read_lines_stream(spark, str(tmp_path / "in"), WIRE, 1)), "id")
    path = f"{tmp_path}/state"
    start_state_stream(
        events.filter("fault IS NULL"), KEY, "seq", IMAGE, path, f"{tmp_path}/cp"
    ).awaitTermination()
    out = latest_state(spark.read.parquet(path), KEY)
    assert states(out) == states(batch_state(spark, rows))
