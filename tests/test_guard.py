"""The entry point works without the training-data package."""

import shutil
import subprocess
import sys
from pathlib import Path

TOP = Path(__file__).parents[1]


def test_entry_without_llm(tmp_path):
    shutil.copytree(TOP / "tidemark", tmp_path / "tidemark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(TOP / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and 'pipeline' not in q and not any(k.startswith('op') for k in q); assert set(e.oracle_sql()) <= set(q); print(len(q))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr


def test_nothing_else_imports_llm():
    for path in (TOP / "tidemark").rglob("*.py"):
        if "llm" not in path.relative_to(TOP / "tidemark").parts:
            assert "llm" not in path.read_text(), path
