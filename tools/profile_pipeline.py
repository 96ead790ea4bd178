"""Profile the pipeline from Spark's event log (no UI, no server).

Usage: python tools/profile_pipeline.py [sf_dir]
Runs the pipeline twice (cold, warm) with the event log written to a fresh
scratch folder, then prints per step of the warm run: wall time, number of
jobs, summed job time and its slowest stages (tasks, duration).
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import zstandard  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

from flightlake.plans.pipeline import land_raw_inputs, run  # noqa: E402


def events(log_dir: str):
    for f in sorted(glob.glob(os.path.join(log_dir, "*", "*")) + glob.glob(os.path.join(log_dir, "*"))):
        if os.path.isdir(f) or "appstatus" in f:
            continue
        with open(f, "rb") as fh:
            stream = (io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(fh), encoding="utf-8")
                      if f.endswith(".zstd") else io.TextIOWrapper(fh, encoding="utf-8"))
            for line in stream:
                yield json.loads(line)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    work = tempfile.mkdtemp(prefix="profile-")
    log_dir = os.path.join(work, "events")
    os.makedirs(log_dir)
    spark = (SparkSession.builder.master("local[8]").appName("flightlake-profile")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", log_dir)
             .config("spark.sql.shuffle.partitions", "16").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    land_raw_inputs(spark, sf_dir, os.path.join(work, "raw"))
    run(spark, os.path.join(work, "raw"), os.path.join(work, "cold"))
    r = run(spark, os.path.join(work, "raw"), os.path.join(work, "warm"))
    spark.stop()

    jobs, stages = {}, {}
    for e in events(log_dir):
        kind = e["Event"]
        if kind == "SparkListenerJobStart":
            jobs[e["Job ID"]] = [e["Submission Time"], None, [s["Stage ID"] for s in e["Stage Infos"]]]
        elif kind == "SparkListenerJobEnd":
            jobs[e["Job ID"]][1] = e["Completion Time"]
        elif kind == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si["Number of Tasks"],
                                      si.get("Completion Time", 0) - si.get("Submission Time", 0))
    print(f"{'step':32s} {'wall s':>7s} {'jobs':>5s} {'job s':>7s}  slowest stages (tasks, ms)")
    for step, (w0, w1) in r.windows.items():
        js = [v for v in jobs.values() if w0 * 1000 <= v[0] <= w1 * 1000 and v[1]]
        busy = sum(v[1] - v[0] for v in js) / 1000
        st = sorted((stages[s] for v in js for s in v[2] if s in stages), key=lambda x: -x[1])[:3]
        print(f"{step:32s} {r.timings[step]:7.2f} {len(js):5d} {busy:7.2f}  {st}")


if __name__ == "__main__":
    main()
