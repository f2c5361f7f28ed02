"""Python stages on workers that cannot import the package: it is on the driver's path only."""
import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
HEAD = f"""
import sys
sys.path.insert(0, {REPO!r})
import math, numpy as np
from gridspark.session import get_session
spark = get_session("w", **{{"spark.master": "local[2]", "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"}})
def seen(_):
    import importlib.util
    yield importlib.util.find_spec("gridspark") is not None
assert spark.sparkContext.parallelize([0], 1).mapPartitions(seen).collect() == [False]
"""


def run(body, tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", HEAD + body], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-3000:]
    return done.stdout.strip().splitlines()[-1]
