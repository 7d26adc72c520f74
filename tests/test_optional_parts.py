"""The repository without the training-data subpackage, its tests and the pipeline."""

import os
import shutil
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import importlib.util, os, sys
sys.path[:0] = [os.getcwd(), os.path.join(os.getcwd(), "tests")]
import __spark_entry__ as e
names = set(e.queries())
assert not {n for n in names if n.startswith("op") or n == "pipeline"} and len(names) > 40, names
assert set(e.oracle_sql()) <= names
for f in sorted(os.listdir("tests")):
    if f.startswith("test_") and f != "test_optional_parts.py":
        spec = importlib.util.spec_from_file_location(f[:-3], os.path.join("tests", f))
        spec.loader.exec_module(importlib.util.module_from_spec(spec))
"""


@pytest.mark.parametrize("without", [("stratum/llm", "tests/llm"), ("stratum/llm", "tests/llm", "corpus_pipeline.py")])
def test_the_rest_imports_without_them(tmp_path, without):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=lambda d, names: [n for n in names if n == ".git" or n == "__pycache__" or os.path.relpath(os.path.join(d, n), ROOT) in without])
    run = subprocess.run([sys.executable, "-c", SCRIPT], cwd=copy, capture_output=True, text=True, env={**os.environ, "PYTHONDONTWRITEBYTECODE": "1"}, check=False)
    assert run.returncode == 0, run.stderr[-2000:]
