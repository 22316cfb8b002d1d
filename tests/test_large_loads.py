"""Many new batches at once: one set of files, the rows of as many folders."""

import pytest
from pyspark.sql import functions as F

from changelake.sources import bronze as bronze_module
from changelake.sources.bronze import CLOSED, Bronze
from tests.test_closed import events, fill, folders, messages, read


@pytest.fixture
def few(monkeypatch):
    monkeypatch.setattr(bronze_module, "MOST_FOLDERS", 3)


def test_a_large_load_reads_as_folders_do(spark, tmp_path, monkeypatch):
    rows = messages(16)
    # Two open batches, two large loads and a small one.
    folder = fill(spark, tmp_path / "folders", rows, [2, 8, 14, 16])
    folder.write_change_log()
    monkeypatch.setattr(bronze_module, "MOST_FOLDERS", 3)
    bulk = fill(spark, tmp_path / "bulk", rows, [2, 8, 14, 16])
    bulk.write_change_log()
    assert read(bulk) == read(folder)
    assert sum(row.batches for row in bulk._sets()) == 14 and folders(tmp_path / "bulk")["batches"] == 4
    assert bulk.log().count() == folder.log().count()
    compacted = fill(spark, tmp_path / "compacted", rows, [8, 14, 16], grace=False)
    assert read(compacted) == read(folder)
    assert compacted._numbers("logs") == [13] or compacted._numbers("logs") == []


def test_folders_do_not_grow_with_a_large_load(spark, tmp_path, few):
    bronze = fill(spark, tmp_path, messages(12), [12])
    assert not any(folders(tmp_path).get(name) for name in (*CLOSED, "log")) and bronze._numbers("logs") == [11]
    with pytest.raises(ValueError, match="are closed"):
        bronze.append_all(events(spark, messages(12)))


def test_replays_of_open_batches_keep_their_folders(spark, tmp_path, few):
    rows = messages(6)
    fill(spark, tmp_path, rows, [2])
    bronze = fill(spark, tmp_path, rows, [6])
    assert folders(tmp_path)["batches"] == 6 and not bronze._sets()


def test_an_unfinished_large_load_is_not_read(spark, tmp_path, few):
    rows = messages(9)
    bronze = fill(spark, tmp_path, rows[:3], [1])
    write = bronze._write

    def broken(df, folder, *rest):
        if folder.startswith("closes"):
            raise OSError("gone")
        write(df, folder, *rest)

    bronze._write = broken
    with pytest.raises(OSError):
        bronze.append_all(events(spark, [row for row in rows if row[0] > 0]))
    bronze._write = write
    assert bronze.log().select("batch_id").distinct().count() == 1
    # Fewer batches than before: the row events of the first try are gone.
    bronze.append_all(events(spark, [row for row in rows if 0 < row[0] < 3]))
    assert bronze._numbers("logs") == [] and sorted(r.batch_id for r in bronze.log().select("batch_id").distinct().collect()) == [0, 1, 2]
    whole = fill(spark, tmp_path / "whole", [row for row in rows if row[0] < 3], [1, 3])
    assert bronze.log().agg(F.count("*")).first() == whole.log().agg(F.count("*")).first()


def test_rows_without_a_batch_are_in_none(spark, tmp_path, few):
    rows = messages(6)
    lost = [(None, 1000 + seq, value) for _, seq, value in rows[:3]]
    bronze, plain = (fill(spark, tmp_path / name, more, [0]) for name, more in (("lost", rows), ("plain", rows)))
    bronze.append_all(events(spark, rows + lost))
    plain.append_all(events(spark, rows))
    for each in (bronze, plain):
        each.append_all(events(spark, [(6, 2000, rows[0][2])]))
        each.write_change_log()
    assert bronze._sets() and read(bronze) == read(plain)


def test_a_batch_of_its_own_is_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    found = events(spark, messages(1)).drop("batch_id")
    Bronze(spark, str(tmp_path)).append(found.mapInArrow(count, found.schema), 0)
    assert seen.value == found.count()
