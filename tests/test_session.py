"""Folders of intermediate tables."""

import os
from pathlib import Path

from changelake import session
from changelake.session import remove_scratch, scratch_dir


def backdate(path, seconds):
    for each in [path, *path.rglob("*")]:
        then = each.stat().st_mtime - seconds
        os.utime(each, (then, then))


def test_only_old_scratch_folders_go(spark, tmp_path):
    folder = tmp_path / "shared"
    assert remove_scratch(spark, 0, str(folder)) == []
    old, new, used, mixed = (folder / Path(scratch_dir(spark, name)).name for name in ("old", "new", "used-again", "in-part"))
    for path in (old, new, used):
        spark.range(3).write.parquet(str(path))
    spark.range(3).write.parquet(f"{mixed}/a/b")
    others = [folder / "tables", folder / "b3c1f6de-0000-4a4a-8888-0123456789ab", folder / ("x-" + "0" * 31)]
    for path in others:
        path.mkdir()
        (path / "file").write_text("")
    for path in (old, used, mixed, *others):
        backdate(path, 7200)
    # Files written later count, also where the folder keeps its old time.
    os.utime(used / "_SUCCESS")
    os.utime(next((mixed / "a" / "b").glob("*.parquet")))
    assert remove_scratch(spark, 3600, str(folder)) == [old.name]
    assert not old.exists() and all(path.exists() for path in (new, used, mixed, *others))
    assert spark.read.parquet(str(new)).count() == 3
    assert remove_scratch(spark, 3600, str(folder)) == []


class _Session:
    """A session without the setting."""

    class conf:
        get = staticmethod(lambda name, default: default)

    class sparkContext:
        master, applicationId = "local[2]", "local-test"


def test_local_sessions_without_a_shared_folder_have_one_of_their_own(monkeypatch):
    monkeypatch.setattr(session, "_OWN", {})
    one, two = (Path(scratch_dir(_Session, name)) for name in "ab")
    assert one.parent == two.parent and one.parent.is_dir() and one != two
    monkeypatch.setattr(_Session.sparkContext, "master", "spark://host:7077")
    monkeypatch.setattr(session, "_OWN", {})
    try:
        scratch_dir(_Session, "c")
    except ValueError as error:
        assert "spark.checkpoint.dir" in str(error)
    else:
        raise AssertionError("a cluster needs a shared folder")
