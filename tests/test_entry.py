"""The entry points work with and without the training-data folders."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LIST = "import __spark_entry__ as e; print(len(e.queries()), sorted(set(e.queries()) & {'pipeline', 'op3_exact_dedup'}))"


def _listed(folder) -> str:
    return subprocess.run([sys.executable, "-c", LIST], cwd=folder, check=True, capture_output=True, text=True).stdout


def test_without_the_training_data_folders(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__"))
    for leftover in ("threadloom/llm/__pycache__", "tests/llm/__pycache__"):
        (copy / leftover).mkdir(parents=True)
    with_pipeline = _listed(copy)
    os.remove(copy / "corpus_pipeline.py")
    assert _listed(copy) == with_pipeline
    assert with_pipeline.endswith(" []\n")
