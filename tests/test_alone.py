"""The library without the operators for training text."""

import os
import shutil
import subprocess
import sys

from conftest import ROOT


def test_the_rest_works_without_the_llm_folders(tmp_path):
    copy = f"{tmp_path}/repo"
    shutil.copytree(ROOT, copy, ignore=lambda folder, names: [n for n in names if n in ("llm", ".git", "__pycache__", ".pytest_cache")])
    assert not os.path.exists(f"{copy}/catalogflow/llm") and os.path.exists(f"{copy}/tests/test_queries.py")
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') or n == 'pipeline' for n in q); assert set(e.oracle_sql()) <= set(q)"
    for command in ([sys.executable, "-c", code], [sys.executable, "-m", "pytest", "tests", "--collect-only", "-q"]):
        done = subprocess.run(command, cwd=copy, capture_output=True, text=True, timeout=300, env={**os.environ, "PYTHONPATH": copy})
        assert done.returncode == 0, done.stdout + done.stderr


def test_comparison_is_imported_without_duckdb():
    code = "import sys; sys.modules['duckdb'] = None; import compare, tests.test_queries"
    done = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stdout + done.stderr
