"""Stage timings of one registered query, from Spark's event log (no UI, no server).

    python tools/stage_profile.py QUERY [SF_DIR]

The event log goes to a fresh scratch folder under /tmp; stages longer than 0.3 s or
writing more than 100k shuffle records are listed with wall time, task CPU time, task
count and shuffle records written.
"""
import glob
import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from pyspark.sql import SparkSession
q = sys.argv[1]; sf = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1"
d = tempfile.mkdtemp(prefix="run-", dir="/tmp")
spark = (SparkSession.builder.master("local[8]").config("spark.sql.shuffle.partitions", "32")
  .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
  .config("spark.sql.adaptive.coalescePartitions.parallelismFirst", "false")
  .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
  .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", d)
  .config("spark.eventLog.compress", "false")
  .config("spark.driver.memory", "16g").config("spark.sql.session.timeZone", "UTC").getOrCreate())
spark.sparkContext.setLogLevel("ERROR")
from recengine.plans import registry as R
R.QUERIES["group_count_1"](spark, sf).write.format("noop").mode("overwrite").save()
t = time.time(); R.QUERIES[q](spark, sf).write.format("noop").mode("overwrite").save(); print(q, round(time.time() - t, 2))
spark.stop()
stages = {}
for f in [x for x in glob.glob(d + "/**/*", recursive=True) if "events" in x.split("/")[-1]]:
    for line in open(f):
        e = json.loads(line)
        if e["Event"] == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            acc = {a.get("Name"): a.get("Value") for a in si.get("Accumulables", [])}
            stages[si["Stage ID"]] = ((si["Completion Time"] - si["Submission Time"]) / 1000, si["Number of Tasks"],
                                      int(acc.get("internal.metrics.executorRunTime", 0)) / 1000,
                                      acc.get("internal.metrics.shuffle.write.recordsWritten", 0))
for sid, (dur, nt, cpu, recs) in sorted(stages.items()):
    if dur > 0.3 or recs > 100000:
        print(f"stage {sid:3d} {dur:6.2f}s cpu={cpu:6.1f}s tasks={nt:3d} shuffle_recs={recs}")
