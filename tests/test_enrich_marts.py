"""Lookup joins, the cardinality guard, and mart edge cases (literal rows)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from flightlake.operators import marts
from tests.reference import carrier_daily_direct
from flightlake.operators.enrich import Lookups, check_cardinality, combine
from flightlake.operators.joins import lookup_join

D1, D2 = dt.date(2022, 1, 1), dt.date(2022, 1, 2)
FL = ("fl_date date, origin string, destination string, op_unique_carrier string, "
      "mkt_unique_carrier string, dep_delay bigint, air_time bigint, distance bigint, "
      "cancelled bigint, active_weather bigint")


def lookups(spark, population=None, carriers=None):
    return Lookups(
        airports=spark.createDataFrame(
            [("A", "S1", "s1"), ("B", "S2", "s2"), ("C", "S3", "s3"), ("Z", "S4", "s4")],
            "airport string, airport_state_name string, airport_state_code string"),
        population=spark.createDataFrame(population or [("S1", 1000), ("S3", 0)],
                                         "name string, population bigint"),
        cancellation_codes=spark.createDataFrame([(0, "none"), (1, "weather")],
                                                 "STATUS bigint, CANCELLATION_REASON string"),
        weather_codes=spark.createDataFrame([(3, "rain")], "STATUS bigint, WEATHER_DESCRIPTION string"),
        carriers=spark.createDataFrame(carriers or [("OP", "Op Air"), ("MK", "Mk Air")],
                                       "CODE string, DESCRIPTION string"),
    )


def flights(spark):
    return spark.createDataFrame([
        (D1, "A", "B", "OP", "MK", 10, 100, 500, 0, 3),
        (D1, "A", "C", "OP", "XX", 20, 200, 600, 1, 9),
        (D1, "B", "A", "OP", "MK", None, 300, 700, 0, 3),
        (D2, "C", "A", "OP", "MK", None, None, None, 0, None),
        (D2, "Z", "A", "OP", "MK", 5, 50, 50, 0, 3),   # Z only departs
        (D2, "A", "Q", "OP", "MK", 5, 50, 50, 0, 3),   # Q only arrives, has no airport row
    ], FL)


def test_combine_left_joins_keep_rows(spark):
    f = flights(spark)
    c = combine(f, lookups(spark))
    assert c.count() == f.count()
    check_cardinality(f, c)
    r = c.where("destination = 'C'").first()
    assert r["origin_state_population"] == 1000          # S1
    assert r["destination_state_population"] == 0        # S3 has population 0
    assert r["mkt_carrier_name"] is None                 # XX unmatched
    assert r["cancellation_reason"] == "weather"
    assert r["weather_description"] is None              # 9 unmatched
    q = c.where("destination = 'Q'").first()             # T8: unmatched airport keeps NULLs
    assert q["destination_state_name"] is None and q["destination_state_population"] is None


def test_cardinality_guard_fails_on_fan_out(spark):
    f = flights(spark)
    lk = lookups(spark, carriers=[("OP", "Op Air"), ("OP", "Op Air 2"), ("MK", "Mk Air")])
    with pytest.raises(AssertionError, match="changed the number of rows"):
        check_cardinality(f, combine(f, lk))


def test_cardinality_guard_passes_unmatched_duplicate_key(spark):
    f = flights(spark)
    lk = lookups(spark, carriers=[("OP", "Op Air"), ("MK", "Mk Air"), ("NO", "x"), ("NO", "y")])
    check_cardinality(f, combine(f, lk))


def test_lookup_join_drops_right_key(spark):
    f = flights(spark)
    out = lookup_join(f, lookups(spark).carriers, "op_unique_carrier", "CODE", {"DESCRIPTION": "n"})
    assert out.columns == f.columns + ["n"]


def test_carrier_daily_null_group(spark):
    c = combine(flights(spark), lookups(spark))
    got = {(r["fl_date"], r["op_unique_carrier"]): r for r in marts.carrier_daily(c).collect()}
    d1 = got[(D1, "OP")]
    assert d1["total_departure_delay"] == 30 and d1["avg_departure_delay"] == 15.0
    assert d1["median_departure_delay"] == 15.0          # interpolated, NULL skipped
    assert d1["median_airtime"] == 200.0
    only_null = marts.carrier_daily(c.where("origin = 'C'")).first()
    assert only_null["total_departure_delay"] is None    # D3: all-NULL sum is NULL
    assert only_null["avg_departure_delay"] is None and only_null["median_departure_delay"] is None


def test_departure_airport_inner_join_drops(spark):
    c = combine(flights(spark), lookups(spark))
    got = {r["origin"]: tuple(r)[1:] for r in marts.departure_airport(c).collect()}
    assert "Z" not in got and "Q" not in got              # only departs / only arrives
    assert got["A"] == (3, 3, 3)                          # to B, C, Q; arrivals from B, C, Z


def test_state_monthly_null_state_and_zero_population(spark):
    c = combine(flights(spark), lookups(spark))
    rows = marts.state_monthly(c).collect()
    by = {(r["month"], r["origin_state_name"]): r for r in rows}
    s1 = by[(D1, "S1")]
    assert s1["count_departures"] == 3 and s1["count_unique_airports"] == 1
    assert s1["departures_per_million_citizens"] == 3000.0
    s3 = by[(D1, "S3")]
    assert s3["count_citizens"] == 0 and s3["airports_per_million_citizens"] is None
    s4 = by[(D1, "S4")]                                   # no population row -> NULL
    assert s4["count_citizens"] is None and s4["departures_per_million_citizens"] is None
    assert marts.state_monthly(c).schema.simpleString().startswith("struct<month:date")


def test_histogram_median_equals_builtin(spark):
    import random

    from pyspark.sql import functions as F

    rnd = random.Random(7)
    rows = []
    for g in range(6):
        for _ in range(rnd.randint(1, 40)):
            rows.append((D1, f"C{g}", rnd.choice([None, rnd.randint(-20, 60)]),
                         rnd.randint(0, 9), None if g == 5 else rnd.randint(100, 105),
                         "A", "B", "MK", 0, 3))
    df = spark.createDataFrame(rows, "fl_date date, op_unique_carrier string, dep_delay bigint, "
                                     "air_time bigint, distance bigint, origin string, destination string, "
                                     "mkt_unique_carrier string, cancelled bigint, active_weather bigint")
    a = marts.carrier_daily(df, sort=False)
    b = carrier_daily_direct(df).select(*a.columns)
    assert a.count() == b.count() == 6
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert a.where(F.col("op_unique_carrier") == "C5").first()["median_distance"] is None


def test_fits_reads_file_sizes_without_a_job(spark, tmp_out):
    from flightlake.operators.joins import fits, source_bytes

    path = os.path.join(tmp_out, "side")
    spark.range(1000).withColumn("s", F.col("id").cast("string")).coalesce(1).write.parquet(path)
    schema = spark.read.parquet(path).schema
    spark.sparkContext.setJobGroup("size-check", "size-check")
    df = spark.read.schema(schema).parquet(path)
    joined = df.join(df.withColumnRenamed("s", "t"), "id").groupBy("t").count()
    size = source_bytes(df)
    assert 1000 < size < 100_000 and size <= source_bytes(joined) <= 2 * size
    assert fits(df, size) and not fits(df, size - 1)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("size-check")
    spark.sparkContext.setJobGroup("other", "other")
