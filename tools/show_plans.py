"""Print condensed physical plans of the pipeline's main steps (Markdown).

Usage: python tools/show_plans.py [sf_dir] > PLANS.md
Publishes the layers once under a scratch folder, then explains each step
over them: operator tree plus the scan lines that show pruning/pushdown.
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from flightlake.operators import analytics, marts, quality  # noqa: E402
from flightlake.operators.enrich import combine  # noqa: E402
from flightlake.operators.transform import transform_flights, with_partition_key  # noqa: E402
from flightlake.plans.pipeline import Layout, _lookups, land_raw_inputs, run  # noqa: E402
from flightlake.schemas import FLIGHTS, RAW_FLIGHTS  # noqa: E402
from flightlake.session import local_session  # noqa: E402
from flightlake.sources.files import read_csv_table, read_layer  # noqa: E402

KEEP = re.compile(r"^(ReadSchema|PushedFilters|PartitionFilters)")


def condensed(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    txt = buf.getvalue()
    tree = txt.split("\n\n")[0].replace("== Physical Plan ==\n", "")
    scans = sorted({line[:200] for line in txt.splitlines() if KEEP.match(line)})
    return tree + "\n" + "\n".join(scans)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session(8)
    work = tempfile.mkdtemp(prefix="plans-")
    raw, out = os.path.join(work, "raw"), os.path.join(work, "out")
    land_raw_inputs(spark, sf_dir, raw)
    run(spark, raw, out)
    lay = Layout(raw, out)
    flights = read_layer(spark, lay.layer("primary", "flights"), FLIGHTS)
    combined = read_layer(spark, lay.layer("combined"))
    one_month = combined.where(F.col("year_month") == "1996_03")
    steps = {
        "transform flights (CSV -> typed, month key)":
            with_partition_key(transform_flights(read_csv_table(spark, lay.raw("flights"), RAW_FLIGHTS)))
            .hint("rebalance", "year_month").sortWithinPartitions("year_month", "fl_date"),
        "validate flights: per-month profile": quality.profile(
            flights.withColumn("year_month", F.date_format("fl_date", "yyyy_MM")),
            ["fl_date", "origin"], group="year_month"),
        "enrich: six broadcast lookup joins": combine(flights, _lookups(spark, lay)),
        "carrier mart (value histograms)": marts.carrier_daily(combined),
        "airport mart from route counts": marts.departure_airport_from_routes(marts.route_counts(combined)),
        "state mart, one month (partition pruning)": marts.state_monthly(one_month),
        "busiest airports per month (top-N window)": analytics.busiest_airports(combined),
        "cancellation reasons (grouping sets)": analytics.cancellation_reasons_all(combined),
    }
    print(f"# Physical plans ({os.path.basename(sf_dir)}, local[8], AQE on)\n")
    print("Generated by `tools/show_plans.py`; AQE may still re-plan joins and coalesce "
          "partitions at run time.\n")
    for name, df in steps.items():
        print(f"## {name}\n\n```\n{condensed(df)}\n```\n")
    spark.stop()


if __name__ == "__main__":
    main()
