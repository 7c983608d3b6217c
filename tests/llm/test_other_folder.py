"""All operators from a session that was started in another folder, whose workers cannot import this package."""

import subprocess
import sys

JOB = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
import __spark_entry__ as entry
spark = (SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4")
         .config("spark.driver.memory", "4g").config("spark.sql.warehouse.dir", "warehouse").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
for name, query in entry.queries().items():
    if name.startswith("op") or name == "pipeline":
        print(name, query(spark, "/root/testdata/sf0.001").count() > 0, flush=True)
"""


def test_every_operator_runs(tmp_path, request):
    repo = str(request.config.rootpath)
    done = subprocess.run([sys.executable, "-c", JOB.format(repo=repo)], cwd=tmp_path, capture_output=True, text=True, timeout=900)
    out = [line.split() for line in done.stdout.splitlines() if line.startswith(("op", "pipeline"))]
    assert done.returncode == 0, done.stderr[-2000:]
    assert [x for x in out if x[1] != "True"] == [] and len(out) == 14
