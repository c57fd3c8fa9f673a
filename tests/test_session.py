"""Sessions without any Spark settings of the machine."""

import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))

SCRIPT = """
from tidemark.session import local_session, scratch_path, shared_dir
spark = local_session(2)
assert spark.sparkContext.getConf().get("spark.checkpoint.dir", None) is None
first = shared_dir(spark)
assert shared_dir(spark) == first
path = scratch_path(spark, "t")
spark.range(5).write.parquet(path)
assert path.startswith(first) and spark.read.parquet(path).count() == 5
assert spark.range(3).checkpoint().count() == 3
print("fine")
"""


def test_local_session_without_a_checkpoint_setting(tmp_path):
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": ROOT}
    out = subprocess.run([sys.executable, "-c", SCRIPT], env=env, capture_output=True, text=True, timeout=240, cwd=tmp_path)
    assert out.stdout.strip().endswith("fine"), out.stderr[-2000:]
