"""The entry module where the corpus operators were taken out."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
NAMES = "import __spark_entry__ as e; q = e.queries(); print(len(q), set(e.oracle_sql()) <= set(q), 'pipeline' in q, any(n.startswith('op1_') for n in q))"


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_without_corpus_operators(tmp_path, with_pipeline):
    left_out = shutil.ignore_patterns(".git", "llm", "__pycache__", *([] if with_pipeline else ["corpus_pipeline.py"]))
    shutil.copytree(ROOT, tmp_path / "copy", ignore=left_out)
    done = subprocess.run([sys.executable, "-c", NAMES], cwd=tmp_path / "copy", capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    count, checked, pipeline, corpus = done.stdout.split()
    assert int(count) >= 167 and (checked, pipeline, corpus) == ("True", "False", "False")
