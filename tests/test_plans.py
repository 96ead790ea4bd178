"""Plan shapes that matter at scale, checked with explain()."""

import contextlib
import io
import os

from pyspark.sql import functions as F

from flightlake.operators import joins, marts
from flightlake.operators.enrich import combine
from flightlake.operators.transform import with_partition_key
from flightlake.plans import flows
from flightlake.schemas import FLIGHTS
from flightlake.sinks.writers import write_partitioned
from flightlake.sources.files import read_layer
from tests.conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def layer(spark, tmp_out):
    """Flights layer and lookups published as files, as the pipeline has them."""
    from flightlake.operators.enrich import LOOKUP_NAMES, Lookups

    t = flows.typed(spark, SF_SMALL)
    path = os.path.join(tmp_out, "flights")
    write_partitioned(with_partition_key(t.flights), path)
    files = {}
    for name in LOOKUP_NAMES:
        getattr(t.lookups, name).write.parquet(os.path.join(tmp_out, name))
        files[name] = spark.read.parquet(os.path.join(tmp_out, name))
    t.lookups = Lookups(**files)
    return t, read_layer(spark, path, FLIGHTS)


def test_combine_never_shuffles_the_fact(spark, tmp_out):
    t, fl = layer(spark, tmp_out)
    p = plan(combine(fl, t.lookups))
    # six joins on the fact (+ the tiny airports x population join inside
    # each of its two broadcast sides); no shuffle of any kind
    assert p.count("BroadcastHashJoin") == 8
    assert "SortMergeJoin" not in p and "ShuffledHashJoin" not in p
    assert "Exchange hashpartitioning" not in p and "Exchange rangepartitioning" not in p


def test_lookups_beyond_bound_fall_back_to_shuffle_joins(spark, tmp_out, monkeypatch):
    t, fl = layer(spark, tmp_out)
    expected = combine(fl, t.lookups)
    monkeypatch.setattr(joins, "BROADCAST_MAX_FILE_BYTES", 2)
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        from flightlake.operators.enrich import LOOKUP_NAMES, Lookups

        lk = Lookups(**{n: getattr(t.lookups, n) for n in LOOKUP_NAMES})   # fresh size checks
        assert not lk.all_broadcast()
        got = combine(fl, lk)
        assert "SortMergeJoin" in plan(got)
        assert got.exceptAll(expected).count() == 0 and expected.exceptAll(got).count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_marts_read_only_their_columns_and_prune_months(spark, tmp_out):
    t, fl = layer(spark, tmp_out)
    path = os.path.join(tmp_out, "combined")
    write_partitioned(combine(fl, t.lookups), path, clustered=True)
    c = read_layer(spark, path)
    p = plan(marts.departure_airport(c))
    assert "ReadSchema: struct<origin:string,destination:string>" in p or \
        ("struct<origin:string,destination:string>" in p)
    p = plan(marts.state_monthly(c.where(F.col("year_month") == "1995_03")))
    assert "PartitionFilters: [isnotnull(year_month" in p and "1995_03" in p
    assert "wind_dir" not in p                            # wide columns never read


def test_top_n_per_month_is_limited_before_the_window(spark):
    from flightlake.operators.analytics import busiest_airports

    p = plan(busiest_airports(flows.combined(spark, SF_SMALL)))
    assert "WindowGroupLimit" in p


def test_building_the_combined_query_starts_no_job(spark):
    flows.combined(spark, SF_SMALL)                       # reads each file's schema once
    sc = spark.sparkContext
    sc.setJobGroup("build-only", "build-only")
    flows.combined(spark, SF_SMALL)
    marts.carrier_daily(flows.combined(spark, SF_SMALL))
    assert not sc.statusTracker().getJobIdsForGroup("build-only")
    sc.setJobGroup("other", "other")


def test_carrier_mart_has_no_window(spark):
    p = plan(marts.carrier_daily(flows.combined(spark, SF_SMALL)))
    assert "Window" not in p and "percentile" in p
