"""Where scratch tables go, with and without a folder named by the session."""

import os
import subprocess
import sys
from types import SimpleNamespace

import pytest

from sharelens.session import scratch_path, shared_dir

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _fake(master, named=None, checkpoint=None):
    context = SimpleNamespace(master=master, getCheckpointDir=lambda: checkpoint)
    return SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: named))


def test_named_folder_wins():
    assert shared_dir(_fake("spark://x:7077", "hdfs://shared/dir/")) == "hdfs://shared/dir"
    assert shared_dir(_fake("yarn", None, "s3a://b/c")) == "s3a://b/c"


def test_cluster_without_a_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(_fake("spark://x:7077"))


def test_paths_are_never_reused(spark):
    first, second = scratch_path(spark, "t"), scratch_path(spark, "t")
    assert first != second and first.startswith(shared_dir(spark))


def test_local_session_without_a_folder(tmp_path):
    """A session started with no defaults file still checkpoints."""
    code = (
        "from pyspark.sql import SparkSession\n"
        "from sharelens.session import checkpointed, shared_dir\n"
        "s = SparkSession.builder.master('local[1]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "assert s.conf.get('spark.checkpoint.dir', None) is None\n"
        "assert checkpointed(s.range(5)).count() == 5\n"
        "assert shared_dir(s) == s.conf.get('spark.sql.warehouse.dir')\n"
        "s.stop()\n"
    )
    env = {**os.environ, "SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": ROOT}
    done = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120, cwd=tmp_path)
    assert done.returncode == 0, done.stderr[-2000:]
    left = [f for _, _, files in os.walk(tmp_path) for f in files if f.endswith(".parquet")]
    assert left == []  # a run's folder goes with it
