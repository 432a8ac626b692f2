"""The Python kernels must run where the package is not importable.

A fresh process, started outside the repository, loads the driver contract
by file path only; its Python workers cannot import ``corvid`` and must get
the kernels by value.
"""

import os
import subprocess
import sys
import tempfile

from conftest import ROOT, SF_SMALL

SCRIPT = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("se", {os.path.join(ROOT, "__spark_entry__.py")!r})
se = importlib.util.module_from_spec(spec)
spec.loader.exec_module(se)
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
for name in ("coreset", "fft_centers", "kcenter_report"):
    print(name, se.queries()[name](spark, {SF_SMALL!r}).count())
spark.stop()
"""


def test_kernels_run_without_the_package_on_the_path():
    cwd = tempfile.mkdtemp(prefix="run-deploy-", dir="/tmp")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run(
        [sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True, timeout=600
    )
    assert out.returncode == 0, out.stderr[-2000:]
    assert out.stdout.split() == ["coreset", "16", "fft_centers", "16", "kcenter_report", "1"]
