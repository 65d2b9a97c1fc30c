"""Lost tasks: every task of the batch's stage fails once and is retried; the compacted table
must equal the one written without failures. Runs in its own process, because retries need
``local[n, maxFailures]`` and a JVM has one master."""

import os
import subprocess
import sys

SCRIPT = r'''
import sys
sys.path.insert(0, sys.argv[1])
from pyspark import TaskContext
from pyspark.sql import functions as F
from feedloom.session import build_session
from feedloom.operators.merge import compact_days

spark = build_session("local[2,3]", shuffle_partitions=4)

@F.udf("bigint")
def lost_once(x):
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("executor lost")
    return x

recs = [(i % 40, float(i), i, "2026-09-1%d" % (6 + i % 2)) for i in range(400)]
batch = (spark.createDataFrame(recs, "id bigint, v double, pos bigint, day string")
         .withColumn("day", F.to_date("day")).repartition(3))
out = {}
for name, df in (("clean", batch), ("flaky", batch.withColumn("id", lost_once("id")))):
    path = sys.argv[2] + "/" + name
    compact_days(spark, path, df, "id", order=[F.desc("pos")], day_col="day", run_log=False)
    out[name] = sorted(tuple(r) for r in spark.read.parquet(path).select("day", "id", "v").collect())
assert out["clean"] == out["flaky"] and len(out["clean"]) == 40, (len(out["clean"]), len(out["flaky"]))
print("RETRIES-OK")
'''


def test_compaction_survives_lost_tasks(tmp_path):
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    res = subprocess.run([sys.executable, "-c", SCRIPT, repo, str(tmp_path)], capture_output=True, text=True,
                         timeout=600)
    assert "RETRIES-OK" in res.stdout, res.stderr[-3000:]
