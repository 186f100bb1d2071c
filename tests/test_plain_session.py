"""A plain local session, which names no shared folder: operators that store tables make one of their own."""

import os
import subprocess
import sys
from pathlib import Path

CODE = """
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").getOrCreate()
assert not spark.conf.get("spark.checkpoint.dir", ""), "the session has a folder"
from brightledger.plans import registry
from brightledger.sources.scratch import shared_folder
assert registry.queries()["j17_descendants"](spark, "/root/testdata/sf0.001").count() > 0
assert shared_folder(spark) == shared_folder(spark)
spark.stop()
"""


def run_plain(code, tmp_path):
    (tmp_path / "conf").mkdir()
    env = {k: v for k, v in os.environ.items() if k != "PYSPARK_SUBMIT_ARGS"} | {"SPARK_CONF_DIR": str(tmp_path / "conf"), "TMPDIR": str(tmp_path), "PYTHONPATH": str(Path(__file__).parents[1])}
    done = subprocess.run([sys.executable, "-c", code], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=600)
    assert done.returncode == 0, done.stderr[-2000:]


def test_statement_operators(tmp_path):
    run_plain(CODE, tmp_path)
