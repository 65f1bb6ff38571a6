"""The driver's entry module, with and without the training-data package."""

from __future__ import annotations

import os
import shutil
import subprocess
import sys

from ordermart.plans.catalog import QUERIES
from tests.conftest import ROOT

SHOW = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), 'op1_simhash' in e.queries())"


def shown(root: str) -> list[str]:
    out = subprocess.run([sys.executable, "-c", SHOW], cwd=root, capture_output=True, text=True, check=True)
    return out.stdout.split()


def test_without_the_training_data_package(tmp_dir):
    """No package, an empty folder in its place, or no pipeline: the rest is there."""
    root = f"{tmp_dir}/repo"
    shutil.copytree(ROOT, root, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    want = [str(len(QUERIES)), str(len(QUERIES)), "False"]
    assert shown(root) == want
    os.makedirs(f"{root}/ordermart/llm/__pycache__")
    assert shown(root) == want


def test_nothing_else_imports_the_package():
    for folder, _, names in os.walk(os.path.join(ROOT, "ordermart")):
        if os.path.basename(folder) not in ("llm", "__pycache__"):
            for name in names:
                if name.endswith(".py"):
                    with open(os.path.join(folder, name), encoding="utf-8") as f:
                        text = f.read()
                    assert "ordermart.llm" not in text and "from ..llm" not in text, name
