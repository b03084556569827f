"""The entry file stands alone: the language-model operators may be left out of an installation."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

REPO = Path(__file__).resolve().parent.parent


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_entry_without_the_language_model_operators(folder, with_pipeline):
    copy = Path(folder) / "copy"
    left_out = {".git", "llm", *([] if with_pipeline else ["corpus_pipeline.py"])}
    shutil.copytree(REPO, copy, ignore=lambda _, names: [n for n in names if n in left_out])
    code = "import __spark_entry__ as e; q = e.queries(); s = e.oracle_sql(); print(len(q), len(s), 'pipeline' in q)"
    done = subprocess.run([sys.executable, "-c", code], cwd=copy, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr
    n, with_sql, pipeline = done.stdout.split()
    assert int(n) >= 64 and int(with_sql) >= 64 and pipeline == "False"
