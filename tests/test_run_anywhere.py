"""The package reaches the tasks wherever the driver is started; no unshared folder on a cluster."""

import os
import subprocess
import sys
from types import SimpleNamespace

import pytest

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as E
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "4")
         .config("spark.ui.enabled", "false").getOrCreate())
print("ROWS", E.queries()["load_log_upsert"](spark, "/root/testdata/sf0.001").count())
"""


def test_ingest_from_another_folder_without_pythonpath(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=REPO)], cwd=tmp_path, env=env, capture_output=True,
                         text=True, timeout=600)
    assert "ROWS 1096" in out.stdout, out.stderr[-2000:]


def test_refresh_starts_by_file_path(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, f"{REPO}/paylake/refresh.py", "--help"], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=120)
    assert out.returncode == 0 and "--warehouse" in out.stdout, out.stderr[-2000:]


def test_a_cluster_needs_a_shared_folder(spark):
    from paylake import session
    sc = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None,
                         getConf=lambda: SimpleNamespace(get=lambda k, d=None: d))
    cluster = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda k, d=None: d))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_dir(cluster)
