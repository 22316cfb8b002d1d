"""Fold and change log against a sequential replay."""

import random

import pytest
from pyspark.sql import functions as F

from changelake.operators.fold import change_log, compact, fold_state
from changelake.operators.scan import prefix_scan

SCHEMA = "k string, seq bigint, operation string, v int"
OPS = ["INSERT", "UPDATE", "DELETE", "INITIAL_LOAD"]


def replay(events):
    """State per key and the log, one event after the other."""
    state, log = {}, []
    for k, seq, op, v in sorted(events, key=lambda e: e[1]):
        row = state.get(k)
        before = row and (row["v"], row["deleted"])
        if op == "DELETE":
            if row:
                state[k] = {**row, "op": op, "seq": seq, "deleted": True}
        else:
            live = row is None or op != "UPDATE"
            state[k] = {"v": v, "op": op, "seq": seq, "deleted": False if live else row["deleted"]}
        row = state.get(k)
        log.append((k, seq, op, before, row and (row["v"], row["deleted"])))
    return {k: (r["v"], r["op"], r["seq"], r["deleted"]) for k, r in state.items()}, log


def events_like(seed, n=800, keys=12, step=1):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        hot = rng.random() < 0.4
        key = "hot" if hot else f"k{rng.randrange(keys)}"
        out.append((key, (i - 50) * step, rng.choice(OPS), rng.choice([None, rng.randrange(99)])))
    return out


EDGE = [
    ("a", 1, "DELETE", None), ("a", 2, "UPDATE", 1),
    ("b", 3, "INSERT", 1), ("b", 4, "DELETE", None), ("b", 5, "UPDATE", 2),
    ("c", 6, "INSERT", 1), ("c", 7, "DELETE", None), ("c", 8, "INSERT", 3),
    ("d", 9, "UPDATE", 1), ("d", 10, "DELETE", None),
    ("e", 11, "DELETE", None),
    ("f", 12, "INSERT", 1), ("f", 13, "INSERT", None),
    ("g", 14, "DELETE", None), ("g", 15, "UPDATE", 1), ("g", 16, "DELETE", None),
]


def as_state(df):
    return {r.k: (r.v, r._operation, r._seq, r.deleted) for r in df.collect()}


@pytest.mark.parametrize("events", [EDGE, events_like(1), events_like(2, step=977)])
def test_fold_is_the_replay(spark, events):
    df = spark.createDataFrame(events, SCHEMA).repartition(5)
    assert as_state(fold_state(df, ["k"], "seq", ["v"])) == replay(events)[0]


@pytest.mark.parametrize("bits, levels", [(20, 2), (3, 1), (2, 3), (20, 0)])
@pytest.mark.parametrize("events", [EDGE, events_like(3), events_like(4, step=977)])
def test_log_is_the_replay(spark, events, bits, levels):
    df = spark.createDataFrame(events, SCHEMA).repartition(5)
    log = change_log(df, ["k"], "seq", ["v"], bits=bits, levels=levels)
    got = [
        (r.k, r.seq, r.operation, r.before and tuple(r.before), r.after and tuple(r.after))
        for r in log.orderBy("seq").collect()
    ]
    assert got == replay(events)[1]


@pytest.mark.parametrize("cut", [0, 1, 400, 799, 800])
def test_compaction_law(spark, cut):
    events = events_like(7)
    first = spark.createDataFrame(events[:cut], SCHEMA)
    second = spark.createDataFrame(events[cut:], SCHEMA)
    base = compact(None, first, ["k"], "seq", ["v"])
    want, log = replay(events)
    assert as_state(fold_state(second, ["k"], "seq", ["v"], base=base)) == want
    rows = change_log(second, ["k"], "seq", ["v"], base=base, bits=4).orderBy("seq").collect()
    got = [(r.k, r.seq, r.operation, r.before and tuple(r.before), r.after and tuple(r.after)) for r in rows]
    assert got == log[cut:]


def test_scan_kinds(spark):
    rng = random.Random(5)
    rows = [("h" if rng.random() < 0.5 else "x", i, rng.choice([None, i % 17])) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, i bigint, v bigint").withColumn("s", F.col("v"))
    df = df.withColumn("lo", F.col("v")).withColumn("hi", F.col("v"))
    kinds = {"s": "sum", "lo": "min", "hi": "max", "v": "last"}
    plain = prefix_scan(df, ["k"], "i", kinds, levels=0)
    cut = prefix_scan(df, ["k"], "i", kinds, bits=2, levels=3)
    assert cut.columns == plain.columns
    assert sorted(map(str, cut.collect())) == sorted(map(str, plain.collect()))
