"""The library and its driver contract without the training-data subpackage."""

import os
import shutil
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_without_the_subpackage(tmp_path):
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=lambda folder, names: [
        n for n in names if n in ("llm", ".git", "__pycache__", ".pytest_cache", "spark-warehouse")])
    code = ("import __spark_entry__ as e; q = e.queries(); o = e.oracle_sql(); "
            "assert len(q) > 40 and set(o) <= set(q) and not any(n.startswith('op') and n[2].isdigit() for n in q)")
    for gone in (None, "corpus_pipeline.py"):  # the folder alone, then the pipeline file, too
        if gone:
            os.remove(copy / gone)
        subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, timeout=120)
