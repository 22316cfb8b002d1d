"""State kept by a processor and state read back: equal to the batch fold."""

import random
import time

import pytest
from pyspark.sql import functions as F

from changelake.operators.fold import fold_state
from changelake.streaming.apply import start_state_stream
from changelake.streaming.state import aggregate_state, fold_partly, processor_state, start_processor_stream

SCHEMA = "k string, seq long, operation string, v int, d decimal(9,2), t timestamp_ntz"
KEY, IMAGE = ["k"], ["v", "d", "t"]


def events(spark, seed, n=400, schema=SCHEMA):
    """Changes in any order, a third of them of one key, some keys and values null."""
    draw = random.Random(seed)
    rows = []
    for seq in draw.sample(range(10 * n), n):
        key = "hot" if draw.random() < 0.33 else draw.choice([None, *map(str, range(25))])
        rows.append((key, seq, draw.choice(["INSERT", "UPDATE", "UPDATE", "DELETE", "INITIAL_LOAD"]), draw.choice([None, 1, 2, 3]), None, None))
    df = spark.createDataFrame(rows, schema)
    return df.withColumns({"d": F.when(F.col("seq") % 3 > 0, F.col("seq") / 4).cast("decimal(9,2)"), "t": F.timestamp_seconds("seq").cast("timestamp_ntz")})


def stream(spark, folder, schema, files=1):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(str(folder))


def run(spark, path, schema, image=IMAGE, **options):
    start_processor_stream(stream(spark, path / "in", schema), KEY, "seq", image, f"{path}/out", f"{path}/cp", **options).awaitTermination()


def rows(df):
    return sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)


def test_batches_folded_partly_fold_to_the_same(spark):
    df = events(spark, 1).repartition(3)
    assert rows(fold_partly(df, KEY, "seq", IMAGE).groupBy("k").agg(F.min("first"), F.max("delete"), F.max("insert"), F.max("seq"))) == rows(
        df.groupBy("k").agg(
            F.min(F.when(F.col("operation") != "DELETE", F.col("seq"))).alias("min(first)"),
            F.max(F.when(F.col("operation") == "DELETE", F.col("seq"))).alias("max(delete)"),
            F.max(F.when(F.col("operation").isin("INSERT", "INITIAL_LOAD"), F.col("seq"))).alias("max(insert)"),
            F.max(F.when(F.col("operation") != "DELETE", F.col("seq"))).alias("max(seq)"),
        )
    )
    (most,) = fold_partly(df, KEY, "seq", IMAGE).groupBy("k").count().agg(F.max("count")).first()
    assert most <= 3 and fold_partly(df.limit(0), KEY, "seq", IMAGE).count() == 0


def test_processor_is_the_batch_and_goes_on_after_a_restart(spark, tmp_path):
    whole = events(spark, 2)
    first, rest = whole.filter("seq % 2 = 0"), whole.filter("seq % 2 = 1")
    first.repartition(3).write.parquet(f"{tmp_path}/in")
    run(spark, tmp_path, whole.schema)
    assert rows(processor_state(spark, f"{tmp_path}/cp", KEY, IMAGE)) == rows(fold_state(first, KEY, "seq", IMAGE))
    # Events of the second run are earlier and later ones than those folded before.
    rest.repartition(2).write.mode("append").parquet(f"{tmp_path}/in")
    run(spark, tmp_path, whole.schema)
    state = processor_state(spark, f"{tmp_path}/cp", KEY, IMAGE)
    assert rows(state) == rows(fold_state(whole, KEY, "seq", IMAGE))
    assert "Exchange" not in state._jdf.queryExecution().executedPlan().toString()
    # What the stream wrote says the same, last row of each key.
    written = spark.read.parquet(f"{tmp_path}/out")
    last = written.groupBy("k").agg(F.max_by(F.struct("v", "d", "t", "_operation", "_seq", "deleted"), "batch_id").alias("r")).select("k", "r.*")
    assert rows(last) == rows(state)


def test_columns_added_between_two_runs(spark, tmp_path):
    whole = events(spark, 3)
    early, late = whole.filter("seq < 2000"), whole.filter("seq >= 2000")
    early.write.parquet(f"{tmp_path}/in")
    run(spark, tmp_path, whole.schema, ["v"])
    late.write.mode("append").parquet(f"{tmp_path}/in")
    run(spark, tmp_path, whole.schema, ["v", "d"])
    want = fold_state(early.withColumn("d", F.lit(None).cast("decimal(9,2)")).unionByName(late), KEY, "seq", ["v", "d"])
    assert rows(processor_state(spark, f"{tmp_path}/cp", KEY, ["v", "d"])) == rows(want)


def test_deleted_rows_are_forgotten_after_their_time(spark, tmp_path):
    def put(*events):
        spark.createDataFrame([(k, seq, op, v, None, None) for k, seq, op, v in events], SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    schema = spark.createDataFrame([], SCHEMA).schema
    put(("a", 1, "INSERT", 1), ("a", 2, "DELETE", None), ("b", 3, "INSERT", 2), ("c", 4, "DELETE", None), ("d", 5, "INSERT", 3), ("d", 6, "DELETE", None))
    run(spark, tmp_path, schema, keep_ms=12_000)
    start = time.time()
    state = lambda: {row.k: (row.v, row.deleted) for row in processor_state(spark, f"{tmp_path}/cp", KEY, IMAGE).collect()}
    assert state() == {"a": (1, True), "b": (2, False), "d": (3, True)}
    put(("d", 7, "INSERT", 4))
    run(spark, tmp_path, schema, keep_ms=12_000)
    assert state()["d"] == (4, False)
    time.sleep(max(0, 13 - (time.time() - start)))
    put(("e", 8, "UPDATE", 5))
    run(spark, tmp_path, schema, keep_ms=12_000)
    assert state() == {"b": (2, False), "d": (4, False), "e": (5, False)}


@pytest.mark.parametrize("files", [1, 3])
def test_state_of_the_aggregate_is_the_batch_one_row_for_each_key(spark, tmp_path, files):
    whole = events(spark, 4)
    whole.repartition(6).write.parquet(f"{tmp_path}/in")
    start_state_stream(stream(spark, tmp_path / "in", whole.schema, files), KEY, "seq", IMAGE, f"{tmp_path}/out", f"{tmp_path}/cp").awaitTermination()
    state = aggregate_state(spark, f"{tmp_path}/cp", KEY, IMAGE)
    assert rows(state) == rows(fold_state(whole, KEY, "seq", IMAGE))
    plan = state._jdf.queryExecution().executedPlan().toString()
    assert "StateTable" in plan and "Exchange" not in plan and "FileScan" not in plan
    stored = spark.read.format("statestore").load(f"{tmp_path}/cp").count()
    assert stored == whole.select("k").distinct().count() < spark.read.parquet(f"{tmp_path}/out").count()
