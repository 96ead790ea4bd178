"""Command line: ``python -m flightlake run|refresh ...``.

``run``     builds the whole lake from the raw files;
``refresh`` merges a newly landed folder of flight files (daily load).
On a cluster, submit this module's file with ``spark-submit``; the session's
settings (master, checkpoint folder, executors) come from the submit.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from flightlake.plans.pipeline import run, run_incremental
from flightlake.session import configure


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="flightlake")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p_run = sub.add_parser("run", help="build the lake from raw files")
    p_ref = sub.add_parser("refresh", help="merge newly landed flight files")
    for p in (p_run, p_ref):
        p.add_argument("--raw", required=True, help="folder with the raw input files")
        p.add_argument("--out", required=True, help="lake folder")
    p_ref.add_argument("--new", required=True, help="folder of new flight CSV files")
    args = ap.parse_args(argv)

    spark = configure(SparkSession.builder.appName("flightlake").getOrCreate())
    if args.cmd == "run":
        r = run(spark, args.raw, args.out)
    else:
        r = run_incremental(spark, args.raw, args.out, args.new)
    print(json.dumps({"steps": r.timings, "counts": r.counts, "months": r.months}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
