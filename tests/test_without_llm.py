"""The library and the contract stand without the training-data operators."""

from __future__ import annotations

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("gone", [["storelens/llm", "tests/llm"], ["storelens/llm", "tests/llm", "corpus_pipeline.py"]])
def test_import_without_training_data_operators(tmp_path, gone):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=lambda folder, names: [n for n in names if n in (".git", "__pycache__") or str((Path(folder) / n).relative_to(ROOT)) in gone])
    program = "import __spark_entry__ as e; n = e.queries(); assert len(n) > 60 and 'pipeline' not in n and not any(q.startswith('op1') for q in n); assert set(e.oracle_sql()) <= set(n)"
    run = subprocess.run([sys.executable, "-c", program], cwd=copy, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr[-2000:]
