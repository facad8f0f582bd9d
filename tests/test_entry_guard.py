"""The entry works without the optional subpackage and its pipeline file."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _names(folder):
    code = "import __spark_entry__ as e; print(*e.queries()); print(*e.oracle_sql())"
    out = subprocess.run([sys.executable, "-B", "-c", code], cwd=folder, capture_output=True, text=True, timeout=120,
                         env=os.environ | {"PYTHONPATH": folder})
    assert out.returncode == 0, out.stderr
    return [set(x.split()) for x in out.stdout.strip().split("\n")]


def test_entry_without_the_optional_subpackage(tmp_path):
    here = str(tmp_path / "r")
    shutil.copytree(ROOT, here, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    queries, oracles = _names(here)
    assert len(queries) > 80 and oracles <= queries
    assert not [q for q in queries if q.startswith("op") and q[2:3].isdigit()] and "pipeline" not in queries


def test_nothing_else_imports_the_optional_subpackage():
    for folder, dirs, files in os.walk(os.path.join(ROOT, "quantlake")):
        dirs[:] = [d for d in dirs if d not in ("llm", "__pycache__")]
        for f in files:
            if f.endswith(".py"):
                with open(os.path.join(folder, f)) as text:
                    assert "quantlake.llm" not in text.read(), f
