"""Session helpers: the shared folder and shipping the package."""

from __future__ import annotations

import os
import subprocess
import sys

from archivesearch import session

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_checkpoint_folder_is_read_from_the_session(spark):
    path = spark.conf.get("spark.checkpoint.dir")
    assert session.ensure_checkpoint_dir(spark) == path
    assert session.scratch_path(spark, "x").startswith(path)


def test_executors_import_the_package_from_any_folder(tmp_path):
    """A driver started elsewhere, without PYTHONPATH, runs a query with Python workers."""
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
from archivesearch.session import local_session
import __spark_entry__ as e
spark = local_session(2, 2)
print("ROWS", e.queries()["knn_exact"](spark, "/root/testdata/sf0.001").count())
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS" in out.stdout, out.stderr[-2000:]
