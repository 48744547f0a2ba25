"""The driver contract from outside the repo: a plain session, another cwd.

Python workers must import the package there too (the schedule flow runs
library code in them)."""

import os
import subprocess
import sys
import tempfile

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"

SCRIPT = f"""
import importlib.util
from pyspark.sql import SparkSession
spec = importlib.util.spec_from_file_location("spark_entry", {os.path.join(REPO, "__spark_entry__.py")!r})
E = importlib.util.module_from_spec(spec); spec.loader.exec_module(E)
spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.showConsoleProgress", "false").config("spark.ui.enabled", "false").getOrCreate())
assert E.entry(spark).count() > 0
for name in ("schedule_capped_cost", "asof_nearest_keyed"):
    assert E.queries()[name](spark, {SF!r}).count() > 0, name
assert set(E.oracle_sql()) <= set(E.queries())
print("CONTRACT-OK")
"""


@pytest.mark.skipif(not os.path.exists(SF), reason="driver tables missing")
def test_contract_from_another_directory():
    cwd = tempfile.mkdtemp(prefix="wattgrid-cwd-", dir="/tmp")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True,
                         timeout=900)
    assert "CONTRACT-OK" in out.stdout, out.stderr[-2000:]
