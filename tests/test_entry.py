"""The driver's entry without the optional parts."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
COUNT = "import __spark_entry__ as e; names = e.queries(); assert 'snapshot_diff' in names and set(e.oracle_sql()) <= set(names); print(any(n.startswith('op') for n in names), 'pipeline' in names)"


def names_of(folder, *options):
    run = subprocess.run([sys.executable, *options, "-c", COUNT], cwd=folder, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    return run.stdout.split()


@pytest.mark.parametrize("without_pipeline", [False, True])
def test_entry_without_the_llm_folders(tmp_path, without_pipeline):
    here = tmp_path / "repo"
    shutil.copytree(ROOT, here, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", *["corpus_pipeline.py"] * without_pipeline))
    assert names_of(here) == ["False", "False"]


def test_entry_without_what_an_operator_needs(tmp_path):
    here = tmp_path / "repo"
    shutil.copytree(ROOT, here, ignore=shutil.ignore_patterns(".git", "__pycache__"))
    (here / "ahocorasick.py").write_text("raise ImportError('not installed')")
    assert names_of(here) == ["False", "False"]


def test_entry_with_all():
    assert names_of(ROOT) == ["True", "True"]
