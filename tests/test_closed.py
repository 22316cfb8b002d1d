"""Closed batches: fewer folders, the same rows; commits carried on from part to part."""

import io
import json
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from changelake.operators.envelope import identify, parse_envelope
from changelake.sources.bronze import CLOSED, Bronze

WIRE = "batch_id bigint, seq bigint, value string"


def messages(batches):
    """Three rows a batch, a column renamed in every tenth and an unknown operation in every seventh."""
    out = []
    for batch in range(batches):
        for i in range(3):
            data = {"id": (batch * 5 + i) % 17, f"c{batch // 10}": batch}
            out.append((batch, batch * 10 + i, {"operation": "DELETE" if (batch + i) % 6 == 5 else "INSERT", "table": f"t{i % 2}", "data": data}))
        if batch % 10 == 9:
            out.append((batch, batch * 10 + 5, {"operation": "RENAME_COLUMN", "table": "t0", "old_column": f"c{batch // 10}", "new_column": f"c{batch // 10 + 1}"}))
        if batch % 7 == 6:
            out.append((batch, batch * 10 + 6, {"operation": "OTHER", "table": "t0", "data": {"id": 1}}))
    return [(batch, seq, json.dumps({"database": "d", "source": "mssql", **event})) for batch, seq, event in out]


def events(spark, rows):
    return identify(parse_envelope(spark.createDataFrame(rows, WIRE)), "id")


def fill(spark, base, rows, ends, **how):
    """A bronze area, compacted after the batches before each end."""
    bronze, first = Bronze(spark, str(base)), 0
    for end in ends:
        bronze.append_all(events(spark, [row for row in rows if first <= row[0] < end]))
        if how:
            bronze.compact(**how)
        first = end
    return bronze


def read(bronze):
    state = sorted((r.record_id, str(sorted(r.data.items())), r.deleted, r._seq) for r in bronze.state().collect())
    # Images have the column names of the time they are stored.
    changes = bronze.stored_change_log().withColumns({side: F.col(side).isNull() for side in ("before", "after")})
    rest = [
        sorted(str(sorted(r.asDict().items())) for r in df.collect())
        for df in (bronze.schema_events(), bronze.quarantine(), changes)
    ]
    times = ("processed_at", "duration_ms", "change_log")
    commits = sorted(str(sorted(r.asDict().items())) for r in bronze.commits().drop(*times).collect())
    return [state, *rest, commits]


def folders(base):
    return {name: len([p for p in (base / name).glob("*=*")]) for name in (*CLOSED, "closed", "log") if (base / name).exists()}


def plan(df):
    with redirect_stdout(io.StringIO()) as text:
        df.explain("formatted")
    return text.getvalue()


def test_closed_batches_read_as_open_ones(spark, tmp_path):
    rows = messages(14)
    open_ = fill(spark, tmp_path / "open", rows, [14])
    open_.write_change_log()
    closed = fill(spark, tmp_path / "closed", rows, [6, 11, 14], grace=False)
    assert read(closed) == read(open_)
    assert folders(tmp_path / "open")["commits"] == 14
    left = folders(tmp_path / "closed")
    # The last batch, where it has such rows.
    assert all(left[name] <= 1 for name in CLOSED) and left["closed"] <= 2 and left["log"] == 3


def test_what_a_set_replaces_goes_one_call_later(spark, tmp_path):
    bronze = fill(spark, tmp_path, messages(8), [8])
    bronze.write_change_log()
    want, planned = read(bronze), bronze.commits()
    assert bronze.close_batches() == 6
    assert folders(tmp_path)["commits"] == 8 and planned.count() == len(want[-1])
    assert read(bronze) == want
    assert bronze.close_batches() == 6
    assert folders(tmp_path)["commits"] == 1 and read(bronze) == want


def test_sets_stay_few(spark, tmp_path):
    rows, bronze = messages(8), Bronze(spark, str(tmp_path))
    for batch in range(8):
        bronze.append_all(events(spark, [row for row in rows if row[0] == batch]))
        bronze.close_batches(grace=False)
    sets = bronze._sets()
    assert len(sets) <= 3 and sum(row.batches for row in sets) == 7
    assert all(later.after == earlier.upto for later, earlier in zip(sets, sets[1:]))
    assert bronze.commits().select("batch_id").distinct().count() == 8


def test_an_unfinished_set_is_not_read(spark, tmp_path):
    bronze = fill(spark, tmp_path, messages(6), [6])
    want = read(bronze)
    spark.read.parquet(f"{tmp_path}/commits").filter("batch_id < 5").write.parquet(f"{tmp_path}/closed/upto=4/commits")
    assert read(bronze) == want
    assert bronze.close_batches(grace=False) == 4 and read(bronze) == want


def test_closed_batches_are_not_written_again(spark, tmp_path):
    rows = messages(6)
    bronze = fill(spark, tmp_path, [row for row in rows if row[0] != 2], [6])
    bronze.close_batches(grace=False)
    want = read(bronze)
    again = events(spark, rows).drop("batch_id")
    bronze.append(again.filter("seq < 10"), 0)
    bronze.append(events(spark, rows).filter("batch_id = 5").drop("batch_id"), 5)
    assert read(bronze) == want
    with pytest.raises(ValueError, match="batch 2 is older"):
        bronze.append(again.filter("seq BETWEEN 20 AND 29"), 2)
    with pytest.raises(ValueError, match="are closed"):
        bronze.append_all(events(spark, rows))


def test_nothing_to_close(spark, tmp_path):
    bronze = Bronze(spark, str(tmp_path / "none"))
    assert bronze.close_batches() is None and bronze.commits().count() == 0
    bronze = fill(spark, tmp_path / "one", messages(1), [1])
    assert bronze.close_batches() is None and bronze.commits().count() == 2


def test_commits_scan_no_history(spark, tmp_path):
    rows = messages(22)
    bronze = fill(spark, tmp_path / "parts", rows[: len([r for r in rows if r[0] < 8])], [8])
    bronze.write_change_log()
    bronze.append_all(events(spark, [row for row in rows if 8 <= row[0] < 16]))
    bronze.write_change_log()
    assert "Window" not in plan(bronze.commits())
    bronze.append_all(events(spark, [row for row in rows if row[0] >= 16]))
    # Commits since the last part have their schema ids, but no totals yet.
    ids = {(r.table_key, r.batch_id): (r.schema_id, r.total_records) for r in bronze.commits().collect()}
    assert ids["d.t0", 8] == (0, ids["d.t0", 8][1]) and ids["d.t0", 15][0] == 1 and ids["d.t0", 21] == (2, None)
    assert ids["d.t1", 21] == (0, None) and ids["d.t1", 15][1] > 0
    whole = fill(spark, tmp_path / "whole", rows, [22])
    whole.write_change_log()
    bronze.write_change_log()
    assert read(bronze) == read(whole)
    last = whole.commits().groupBy("table_key").agg(F.max_by("total_records", "batch_id").alias("n"))
    rows_of = whole.stored_change_log().filter("after IS NOT NULL").groupBy("table_key").agg(F.count_distinct("row_key").alias("n"))
    assert {tuple(r) for r in last.collect()} == {tuple(r) for r in rows_of.collect()}
