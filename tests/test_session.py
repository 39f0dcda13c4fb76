"""The package reaches the workers wherever the driver was started."""

import os
import subprocess
import sys

from tests.conftest import ROOT, SF_SMALL

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
from recspark.session import spark_session
import __spark_entry__ as E
spark = spark_session("shipped", master="local[2]", shuffle_partitions=2)
print("rows", E.queries()["knn_exact"](spark, {data!r}).count())
"""


def test_python_stages_run_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", SCRIPT.format(root=ROOT, data=SF_SMALL)], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=300)
    assert "rows 5000" in run.stdout, run.stderr[-2000:]
