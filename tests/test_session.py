"""The shared folder: named by the session, or a temporary one of a local master."""

import subprocess
import sys
from pathlib import Path

CODE = """
import sys
sys.path.insert(0, {root!r})
from pyspark.sql import SparkSession
from statcube.session import cut_lineage, scratch_path, shared_dir
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "1").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
first = shared_dir(spark)
assert first == shared_dir(spark) and scratch_path(spark, "x").startswith(first)
assert cut_lineage(spark.range(5)).count() == 5
print("kept", first)
spark.stop()
"""


def test_without_a_named_folder_a_local_master_has_its_own(tmp_path):
    """In a process of its own, with an empty configuration folder, so that no default names the folder."""
    root = str(Path(__file__).resolve().parents[1])
    done = subprocess.run(
        [sys.executable, "-c", CODE.format(root=root)], env={"SPARK_CONF_DIR": str(tmp_path), "PATH": "/usr/bin:/bin", **_java()},
        capture_output=True, text=True, timeout=300, check=False)
    assert "kept " in done.stdout, done.stderr[-2000:]


def _java():
    import os

    return {k: v for k, v in os.environ.items() if k in ("JAVA_HOME", "HOME", "PYTHONPATH", "PATH", "SPARK_LOCAL_IP", "PYSPARK_PYTHON")}
