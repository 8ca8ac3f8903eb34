"""Every training-data query runs where workers have no copy of the package, from any working folder."""

import os
import subprocess
import sys

import pytest

HERE = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
DATA = os.environ.get("SMALL_SF_DIR", "/root/testdata/sf0.001")

SCRIPT = """
import sys
from pyspark.sql import SparkSession
# The workers start before the package is on the path, and so never see it.
spark = (SparkSession.builder.master("local-cluster[2,2,1800]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
         .config("spark.executor.memory", "1500m").config("spark.checkpoint.dir", sys.argv[2]).config("spark.sql.warehouse.dir", sys.argv[2]).getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
sys.path.insert(0, sys.argv[1])
import __spark_entry__
queries = __spark_entry__.queries()
names = [n for n in queries if n == "pipeline" or n.startswith("op")]
assert len(names) >= 14, names


def package_seen(batches):
    import importlib.util
    import pyarrow as pa

    for _ in batches:
        yield pa.RecordBatch.from_arrays([pa.array([importlib.util.find_spec("wardmetrics") is not None])], names=["seen"])


assert spark.range(1).mapInArrow(package_seen, "seen boolean").first()[0] is False
for name in names:
    print(name, queries[name](spark, sys.argv[3]).count(), flush=True)
"""


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
def test_all_queries_on_workers_without_the_package(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", SCRIPT, HERE, str(tmp_path), DATA], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert done.returncode == 0, done.stdout[-2000:] + done.stderr[-4000:]
    assert "op13_spelling" in done.stdout and "pipeline" in done.stdout
