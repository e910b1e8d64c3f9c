"""The entry module where the text operators, or what they need, are not there."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
COUNT = "import __spark_entry__ as e; q = e.queries(); print(sum(k.startswith('op') and k[2:3].isdigit() or k == 'pipeline' for k in q), len(q) > 90, set(e.oracle_sql()) <= set(q))"


def counted(folder: str, before: str = "") -> list[str]:
    done = subprocess.run([sys.executable, "-c", before + COUNT], cwd=folder, capture_output=True, text=True, timeout=120, env={**os.environ, "PYTHONPATH": folder})
    assert done.returncode == 0, done.stderr
    return done.stdout.split()


@pytest.mark.parametrize("module", ["assaysieve.llm", "assaysieve.llm.queries", "public_tokenizers"])
def test_blocked_modules(module):
    """A module that cannot be imported takes the text queries with it and nothing else."""
    assert counted(ROOT, f"import sys; sys.modules['{module}'] = None; ") == ["0", "True", "True"]


def test_a_deleted_folder_of_which_caches_are_left(tmp_path):
    copy = str(tmp_path / "copy")
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "__pycache__", "*.json"))
    os.makedirs(os.path.join(copy, "assaysieve", "llm", "__pycache__"))
    assert counted(copy) == ["0", "True", "True"]
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), copy)
    if os.path.exists(os.path.join(copy, "corpus_pipeline.py")):
        os.remove(os.path.join(copy, "corpus_pipeline.py"))
        assert counted(copy) == ["0", "True", "True"]
