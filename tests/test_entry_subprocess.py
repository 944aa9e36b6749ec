"""The driver imports __spark_entry__ from elsewhere with a plain session: Python
workers must still find the package (shipped with addPyFile)."""

import os
import subprocess
import sys
import tempfile

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = f"""
import importlib.util
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false").getOrCreate())
spec = importlib.util.spec_from_file_location("entry_mod", "{REPO}/__spark_entry__.py")
m = importlib.util.module_from_spec(spec)
spec.loader.exec_module(m)
assert m.entry(spark).count() > 0
n = m.queries()["q_score_text"](spark, "/root/testdata/sf0.001").count()
print("ROWS", n)
"""


def test_entry_and_pandas_udf_from_foreign_cwd():
    cwd = tempfile.mkdtemp(prefix="rf-driver-")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT], cwd=cwd, env=env, capture_output=True, text=True,
                         timeout=600)
    assert "ROWS" in out.stdout, out.stderr[-2000:]
