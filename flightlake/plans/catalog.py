"""The registered query set: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver tables under ``sf_dir`` through the
flight-shaped fixture inputs, so its work grows with the data.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.functions.columns import first_of_month, zero_pad
from flightlake.operators import analytics, marts, quality, stats
from flightlake.operators.enrich import LOOKUP_NAMES, combine, guarded_counts
from flightlake.operators.joins import lookup_join
from flightlake.operators.transform import (
    PARTITION_KEY,
    transform_airports,
    transform_flights,
    transform_population,
    with_partition_key,
)
from flightlake.plans import flows, lake
from flightlake.plans.pipeline import Layout, land_raw_inputs
from flightlake.schemas import (
    CARRIER_DAILY,
    DEPARTURE_AIRPORT,
    FLIGHT_REQUIRED,
    FLIGHTS,
    RAW_AIRPORTS,
    RAW_FLIGHTS,
    STATE_MONTHLY,
)
from flightlake.session import freed_shuffles, scratch_path
from flightlake.sinks import clustering
from flightlake.sinks import upsert as upsert_sink
from flightlake.sinks.writers import schema_dictionary, write_partitioned
from flightlake.sources import fixtures
from flightlake.sources.files import read_census_json, read_csv_table, read_layer
from flightlake.streaming.daily_load import run_daily_lake, run_daily_load

Query = Callable[[SparkSession, str], DataFrame]
_REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        _REGISTRY[name] = fn
        return fn
    return deco


@register("combined_wide")
def combined_wide(spark, sf_dir):
    return flows.combined(spark, sf_dir)


@register("flights_typed")
def flights_typed(spark, sf_dir):
    return flows.typed(spark, sf_dir).flights


@register("carrier_daily")
def carrier_daily(spark, sf_dir):
    return marts.carrier_daily(flows.combined(spark, sf_dir))


@register("departure_airport")
def departure_airport(spark, sf_dir):
    return marts.departure_airport(flows.combined(spark, sf_dir))


@register("state_monthly")
def state_monthly(spark, sf_dir):
    return marts.state_monthly(flows.combined(spark, sf_dir))


# ------------------------------------------------------------- single joins

FLIGHT_ID = ["fl_date", "op_carrier_fl_num", "origin", "destination"]


@register("join_origin_state")
def join_origin_state(spark, sf_dir):
    t = flows.typed(spark, sf_dir)
    j = lookup_join(t.flights, t.lookups.airports, "origin", "airport",
                    {"airport_state_name": "origin_state_name",
                     "airport_state_code": "origin_state_code"})
    return j.select(*FLIGHT_ID, "origin_state_name", "origin_state_code")


@register("join_destination_state")
def join_destination_state(spark, sf_dir):
    t = flows.typed(spark, sf_dir)
    j = lookup_join(t.flights, t.lookups.airports, "destination", "airport",
                    {"airport_state_name": "destination_state_name",
                     "airport_state_code": "destination_state_code"})
    return j.select(*FLIGHT_ID, "destination_state_name", "destination_state_code")


@register("join_population_both")
def join_population_both(spark, sf_dir):
    return flows.combined(spark, sf_dir).select(
        *FLIGHT_ID, "origin_state_name", "destination_state_name",
        "origin_state_population", "destination_state_population")


@register("join_cancellation")
def join_cancellation(spark, sf_dir):
    t = flows.typed(spark, sf_dir)
    j = lookup_join(t.flights, t.lookups.cancellation_codes, "cancelled", "STATUS",
                    {"CANCELLATION_REASON": "cancellation_reason"})
    return j.select(*FLIGHT_ID, "cancelled", "cancellation_reason")


@register("join_weather")
def join_weather(spark, sf_dir):
    t = flows.typed(spark, sf_dir)
    j = lookup_join(t.flights, t.lookups.weather_codes, "active_weather", "STATUS",
                    {"WEATHER_DESCRIPTION": "weather_description"})
    return j.select(*FLIGHT_ID, "active_weather", "weather_description")


@register("join_carrier_roles")
def join_carrier_roles(spark, sf_dir):
    t = flows.typed(spark, sf_dir)
    j = lookup_join(t.flights, t.lookups.carriers, "mkt_unique_carrier", "CODE",
                    {"DESCRIPTION": "mkt_carrier_name"})
    j = lookup_join(j, t.lookups.carriers, "op_unique_carrier", "CODE",
                    {"DESCRIPTION": "op_carrier_name"})
    return j.select(*FLIGHT_ID, "mkt_unique_carrier", "op_unique_carrier",
                    "mkt_carrier_name", "op_carrier_name")


@register("join_hybrid_all")
def join_hybrid_all(spark, sf_dir):
    """The wide table with every lookup treated as too large to broadcast (the join that flights
    go through beyond the bound)."""
    t = flows.typed(spark, sf_dir)
    beyond = dict.fromkeys((*LOOKUP_NAMES, "airport_states"), False)
    return combine(flows.stored(spark, t.flights, "flights"), replace(t.lookups, _small=beyond), stored=True)


@register("join_cardinality_guard")
def join_cardinality_guard(spark, sf_dir):
    t = flows.typed(spark, sf_dir)
    return guarded_counts(t.flights, combine(t.flights, t.lookups))


@register("airport_missing_arrivals")
def airport_missing_arrivals(spark, sf_dir):
    # Flights into one state are removed: its airports still depart but no
    # longer receive arrivals, so the inner join drops them from the mart.
    c = flows.combined(spark, sf_dir)
    c = c.where(~F.col("destination_state_name").eqNullSafe(F.lit(MISSING_ARRIVALS_STATE)))
    return marts.departure_airport(c)


MISSING_ARRIVALS_STATE = "EUROPE"


@register("state_monthly_via_routes")
def state_monthly_via_routes(spark, sf_dir):
    # The state mart computed from the same month-partitionable route counts.
    return marts.state_monthly_from_routes(marts.route_counts(flows.combined(spark, sf_dir)))


@register("departure_airport_via_routes")
def departure_airport_via_routes(spark, sf_dir):
    # The same mart computed from month-partitionable route counts.
    return marts.departure_airport_from_routes(marts.route_counts(flows.combined(spark, sf_dir)))


# ------------------------------------------------------ typing, partitions

@register("zero_pad_flight_number")
def zero_pad_flight_number(spark, sf_dir):
    raw = fixtures.raw_flights(spark, sf_dir)
    nums = (raw.select(F.col("OP_CARRIER_FL_NUM").alias("flight_number"))
            .unionByName(raw.select(F.col("MKT_CARRIER_FL_NUM").alias("flight_number")))
            .distinct())
    padded = zero_pad("flight_number")
    return nums.select("flight_number", padded.alias("padded"),
                       F.length(padded).cast("bigint").alias("padded_length"))


@register("population_typed")
def population_typed(spark, sf_dir):
    return transform_population(fixtures.population_records(spark, sf_dir))


@register("partition_month_counts")
def partition_month_counts(spark, sf_dir):
    path = scratch_path(spark, "flights-by-month")
    write_partitioned(with_partition_key(flows.typed(spark, sf_dir).flights), path)
    layer = read_layer(spark, path, FLIGHTS)
    return layer.groupBy(PARTITION_KEY).agg(F.count(F.lit(1)).alias("rows"))


@register("partition_year_month_counts")
def partition_year_month_counts(spark, sf_dir):
    path = scratch_path(spark, "flights-by-year-month")
    f = flows.typed(spark, sf_dir).flights.withColumns({
        "year": F.date_format("fl_date", "yyyy"), "month": F.date_format("fl_date", "MM")})
    (f.hint("rebalance", "year", "month").sortWithinPartitions("year", "month", "fl_date")
     .write.mode("overwrite").partitionBy("year", "month").parquet(path))
    schema = T.StructType(FLIGHTS.fields + [T.StructField("year", T.StringType()),
                                            T.StructField("month", T.StringType())])
    layer = spark.read.schema(schema).parquet(path)
    return layer.groupBy("year", "month").agg(F.count(F.lit(1)).alias("rows"))


@register("monthly_concat")
def monthly_concat(spark, sf_dir):
    # Two separately landed sets of months, aggregated apart and concatenated.
    c = flows.combined(spark, sf_dir)
    odd = F.coalesce(F.month("fl_date") % 2 == 1, F.lit(False))   # rows without a date go with the even months
    return (marts.carrier_daily(c.where(odd), sort=False)
            .unionByName(marts.carrier_daily(c.where(~odd), sort=False)))


# ------------------------------------------------------------ data quality

def _stored_flights(spark, sf_dir):
    """Typed flights as a stored table: the joins that make them run once, however often a query goes through them."""
    return flows.stored(spark, flows.typed(spark, sf_dir).flights, "flights")


@register("dq_flights_metrics")
def dq_flights_metrics(spark, sf_dir):
    f = with_partition_key(_stored_flights(spark, sf_dir))
    return quality.flight_metrics(f, PARTITION_KEY, FLIGHT_REQUIRED)


@register("dq_airports_metrics")
def dq_airports_metrics(spark, sf_dir):
    return _profile_with_duplicates(flows.typed(spark, sf_dir).lookups.airports)


def _profile_with_duplicates(a):
    prof = quality.profile(a, a.columns)
    dup = quality.duplicate_summary(a)
    # Both sides are single-row aggregates joined on a constant key.
    one = F.lit(1)
    return prof.withColumn("__k", one).join(dup.withColumn("__k", one), "__k").drop("__k")


@register("dq_population_metrics")
def dq_population_metrics(spark, sf_dir):
    p = transform_population(fixtures.population_records(spark, sf_dir))
    return p.agg(F.count(F.lit(1)).alias("rows"),
                 F.count_if(F.col("population") < 0).cast("bigint").alias("negative_population"),
                 *quality.null_count_exprs(p.columns))


def _broken_flights(f):
    """Flights of four hours broken in one way each, and two of them landed twice."""
    hour = F.col("dep_hour")
    return f.withColumns({
        "latitude": F.when(hour == 1, F.lit(90.5)).otherwise(F.col("latitude")),
        "longitude": F.when(hour == 2, F.lit(-180.5)).otherwise(F.col("longitude")),
        "destination": F.when(hour == 3, F.lit(None).cast("string")).otherwise(F.col("destination")),
        "fl_date": F.when(hour == 4, F.lit(None).cast("date")).otherwise(F.col("fl_date")),
    }).unionByName(f.where(hour == 5)).unionByName(f.where(hour == 5))


@register("dq_flights_violations")
def dq_flights_violations(spark, sf_dir):
    f = with_partition_key(_broken_flights(_stored_flights(spark, sf_dir)))
    return quality.flight_metrics(f, PARTITION_KEY, FLIGHT_REQUIRED)


@register("dq_airports_violations")
def dq_airports_violations(spark, sf_dir):
    # Every nation's airport, some of them off the map, nameless, or landed twice.
    a = flows.typed(spark, sf_dir).lookups.airports
    code = F.col("airport_state_code")
    broken = a.withColumns({
        "latitude": F.when(code == "AF", F.col("latitude") - 100).otherwise(F.col("latitude")),
        "longitude": F.when(code == "EU", F.col("longitude") + 400).otherwise(F.col("longitude")),
        "airport_state_name": F.when(code == "AS", F.lit(None).cast("string")).otherwise(F.col("airport_state_name")),
    }).unionByName(a.where(code == "AM"))
    return _profile_with_duplicates(broken)


@register("dq_population_violations")
def dq_population_violations(spark, sf_dir):
    p = transform_population(fixtures.population_records(spark, sf_dir))
    p = p.withColumn("population", F.when(F.col("name") == "EUROPE", -F.col("population")).otherwise(F.col("population")))
    return p.agg(F.count(F.lit(1)).alias("rows"),
                 F.count_if(F.col("population") < 0).cast("bigint").alias("negative_population"),
                 *quality.null_count_exprs(p.columns))


@register("dq_duplicates")
def dq_duplicates(spark, sf_dir):
    # Seeded copies: the flights of hour 0 are landed twice.
    f = with_partition_key(_stored_flights(spark, sf_dir))
    seeded = f.unionByName(f.where(F.col("dep_hour") == 0))
    return quality.duplicate_summary(seeded, group=PARTITION_KEY)


@register("null_profile_long")
def null_profile_long(spark, sf_dir):
    return quality.null_profile_long(flows.combined(spark, sf_dir))


# --------------------------------------------------------------- analytics

@register("top_delayed_airlines")
def top_delayed_airlines(spark, sf_dir):
    return analytics.most_delayed(flows.combined(spark, sf_dir), "op_unique_carrier")


@register("top_delayed_airports")
def top_delayed_airports(spark, sf_dir):
    return analytics.most_delayed(flows.combined(spark, sf_dir), "origin")


@register("on_time_performance")
def on_time_performance(spark, sf_dir):
    return analytics.on_time_performance(flows.combined(spark, sf_dir))


@register("busiest_airports_monthly")
def busiest_airports_monthly(spark, sf_dir):
    return analytics.busiest_airports(flows.combined(spark, sf_dir))


@register("cancellation_reasons_by_month")
def cancellation_reasons_by_month(spark, sf_dir):
    return analytics.cancellation_reasons(flows.combined(spark, sf_dir), "month")


@register("cancellation_reasons_by_airport")
def cancellation_reasons_by_airport(spark, sf_dir):
    return analytics.cancellation_reasons(flows.combined(spark, sf_dir), "airport")


@register("cancellation_reasons_by_airline")
def cancellation_reasons_by_airline(spark, sf_dir):
    return analytics.cancellation_reasons(flows.combined(spark, sf_dir), "airline")


@register("cancellation_reasons_all")
def cancellation_reasons_all(spark, sf_dir):
    return analytics.cancellation_reasons_all(flows.combined(spark, sf_dir))


@register("state_rank_population_vs_flights")
def state_rank_population_vs_flights(spark, sf_dir):
    return analytics.population_vs_flights(flows.combined(spark, sf_dir))


@register("state_population_flight_correlation")
def state_population_flight_correlation(spark, sf_dir):
    return analytics.population_flight_correlation(flows.combined(spark, sf_dir))


@register("state_flights_per_thousand")
def state_flights_per_thousand(spark, sf_dir):
    return analytics.flights_per_inhabitants(flows.combined(spark, sf_dir), 1_000)


# ------------------------------------------------- sources, sinks, streams

@register("census_json_table")
def census_json_table(spark, sf_dir):
    # Land a census-style response built from the data, then read it back.
    path = scratch_path(spark, "census-response")
    fixtures.census_document(spark, sf_dir).write.mode("overwrite").text(path)
    return transform_population(read_census_json(spark, path))


@register("upsert_months")
def upsert_months(spark, sf_dir):
    # Initial load carries stale December rows and rows without a date; the
    # new load brings the December months again, some flights in two
    # versions, and more rows without a date. The later version must stay,
    # and no undated row may be lost.
    f = _stored_flights(spark, sf_dir)
    december = F.month("fl_date") == 12
    undated = F.lit(None).cast("date")
    stale = f.withColumn("dep_delay", F.when(december, F.col("dep_delay") + 1000)
                         .otherwise(F.col("dep_delay")))
    first = stale.unionByName(f.where("dep_hour = 1").withColumn("fl_date", undated))
    earlier = f.where(december & (F.col("dep_hour") < 12)).withColumn("dep_delay", F.lit(-1).cast("bigint"))
    later = f.where(december).unionByName(f.where("dep_hour = 2").withColumn("fl_date", undated))
    load = (upsert_sink.with_load_order(earlier.withColumn("landed", F.lit(1)), "landed")
            .unionByName(upsert_sink.with_load_order(later.withColumn("landed", F.lit(2)), "landed")).drop("landed"))
    table = scratch_path(spark, "flights-upsert")
    upsert_sink.initial_load(first, table, stored=True)
    upsert_sink.upsert_months(spark, table, load, stored=True)
    return read_layer(spark, table, FLIGHTS).drop(PARTITION_KEY)


@register("stream_daily_load")
def stream_daily_load(spark, sf_dir):
    # Land the flights in two versions, the earlier one first, drain them with
    # an availableNow stream that merges every micro-batch into the
    # month-partitioned table; the later version must stay.
    f = flows.typed(spark, sf_dir).flights
    landing = scratch_path(spark, "landing")
    for version, rows in enumerate((f.where("dep_hour < 6").withColumn("dep_delay", F.lit(-1).cast("bigint")), f)):
        with freed_shuffles(spark):
            rows.write.mode("append").parquet(f"{landing}/version={version}")
    table = scratch_path(spark, "flights-streamed")
    run_daily_load(spark, landing, table, FLIGHTS)
    layer = read_layer(spark, table, FLIGHTS)
    return layer.groupBy(PARTITION_KEY).agg(F.count(F.lit(1)).alias("rows"), F.sum("dep_delay").alias("delay"))


@register("dictionary_export")
def dictionary_export(spark, sf_dir):
    # The data dictionary (column -> Spark SQL type) of the combined table and
    # the three marts, from their plans, with the rows each column has.
    combined = flows.combined(spark, sf_dir)
    outputs = {
        "complete_data": combined,
        "operating_carrier_stats": marts.carrier_daily(combined, sort=False),
        "departure_airport_stats": marts.departure_airport(combined, sort=False),
        "state_stats": marts.state_monthly(combined, sort=False),
    }
    rows = [(name, col, typ) for name, df in outputs.items()
            for col, typ in schema_dictionary(df).items()]
    names = spark.createDataFrame(rows, "dataset string, column string, data_type string")
    filled = None
    for name, df in outputs.items():
        counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
        long = counts.unpivot([], df.columns, "column", "filled_rows").withColumn("dataset", F.lit(name))
        filled = long if filled is None else filled.unionByName(long)
    return names.join(filled, ["dataset", "column"]).select("dataset", "column", "data_type", "filled_rows")


@register("incremental_refresh")
def incremental_refresh(spark, sf_dir):
    # The file pipeline end to end: land raw files, build the lake without
    # January, then the daily refresh brings January and re-sends part of
    # February; the published carrier mart must equal a full build.
    from flightlake.plans.pipeline import Layout, land_raw_inputs, run, run_incremental

    raw, out = scratch_path(spark, "raw"), scratch_path(spark, "lake")
    land_raw_inputs(spark, sf_dir, raw, flights=False)
    rf = fixtures.raw_flights(spark, sf_dir)
    month = F.substring("FL_DATE", 6, 2)
    _land_csv(rf.where(month != "01"), Layout(raw, out).raw("flights"))
    daily = scratch_path(spark, "daily")
    _land_csv(rf.where((month == "01") | ((month == "02") & (F.col("DEP_HOUR") < 6))), daily)
    run(spark, raw, out)
    run_incremental(spark, raw, out, daily)
    return (spark.read.schema(CARRIER_DAILY).option("header", True)
            .csv(Layout(raw, out).layer("marts", "operating_carrier_stats")))


@register("clustered_year_at_airport")
def clustered_year_at_airport(spark, sf_dir):
    """Flights of the first 365 days from the first airport, read from all flights laid along a
    space-filling curve over day and origin: only files whose ranges meet both are opened."""
    flights = _stored_flights(spark, sf_dir)
    path = scratch_path(spark, "clustered")
    clustering.write_clustered(flights, path, ["fl_date", "origin"], file_rows=2_000)
    first = spark.read.parquet(f"{path}/{clustering.MANIFEST}").agg(F.min("low_fl_date").alias("day"), F.min("low_origin").alias("at")).first()
    day = first["day"]
    bounds = {"fl_date": (day, day + timedelta(days=364) if day else None), "origin": (first["at"], first["at"])}
    return clustering.read_clustered(spark, path, flights.schema, bounds)


@register("layer_size_audit")
def layer_size_audit(spark, sf_dir):
    # Rows and columns of the raw layer (CSV text) and the typed layer
    # (Parquet), both read back (bytes on storage are in Run.sizes).
    raw = fixtures.raw_flights(spark, sf_dir)
    raw_path, typed_path = scratch_path(spark, "raw-csv"), scratch_path(spark, "typed-parquet")
    raw.write.mode("overwrite").option("header", True).option("compression", "gzip").csv(raw_path)
    landed = read_csv_table(spark, raw_path, RAW_FLIGHTS)
    write_partitioned(with_partition_key(transform_flights(landed)), typed_path)
    layer = read_layer(spark, typed_path, FLIGHTS).drop(PARTITION_KEY)
    count = F.count(F.lit(1))
    before = landed.agg(count.alias("raw_rows"), F.lit(len(landed.columns)).cast("bigint").alias("raw_columns"))
    after = layer.agg(count.alias("typed_rows"), F.lit(len(layer.columns)).cast("bigint").alias("typed_columns"))
    one = F.lit(1)   # two one-row aggregates side by side
    return (before.withColumn("__k", one).join(after.withColumn("__k", one), "__k").drop("__k"))


@register("flights_typed_reordered")
def flights_typed_reordered(spark, sf_dir):
    # The raw file with its columns in another order and some that nobody asked for.
    raw = fixtures.raw_flights(spark, sf_dir)
    shuffled = [F.col(f"`{c}`") for c in sorted(raw.columns, reverse=True)]
    path = scratch_path(spark, "raw-reordered")
    (raw.select(F.lit("x").alias("REMARK"), *shuffled[:7], F.lit(1).alias("SOURCE ROW"), *shuffled[7:])
     .write.option("header", True).option("compression", "gzip").csv(path))
    return transform_flights(read_csv_table(spark, path, RAW_FLIGHTS))


@register("airports_extra_columns")
def airports_extra_columns(spark, sf_dir):
    # Extra airport columns are kept and checked for NULLs like the others.
    raw = fixtures.raw_inputs(spark, sf_dir).airports
    path = scratch_path(spark, "airports-extra")
    code = F.col("AIRPORT_STATE_CODE")
    (raw.select(F.when(code == "AS", F.lit(None)).otherwise(F.lower(code)).alias("TIME ZONE"), *reversed(raw.columns))
     .write.option("header", True).csv(path))
    landed = transform_airports(read_csv_table(spark, path, RAW_AIRPORTS, keep_extra=True))
    return _profile_with_duplicates(landed.withColumnRenamed("time zone", "time_zone"))


# ------------------------------------------------------ lake on snapshots

def _land_csv(rows, path):
    """Raw flights as text, compressed; the joins that make them leave no shuffle files behind."""
    with freed_shuffles(rows.sparkSession):
        rows.write.mode("overwrite").option("header", True).option("compression", "gzip").csv(path)


#: Rows per file in the lakes of these queries: files of a few days each, so that refreshes rewrite only a part.
LAKE_FILE_ROWS = 50_000


def _landed(rows, day):
    return rows.select("*", F.lit(f"2024-01-{day:02d} 00:00:00").cast("timestamp").alias("landed"), F.lit(f"day{day}").alias("landed_file"))


def _refreshed_lake(spark, sf_dir):
    """A lake after a build and two refreshes that arrive in the wrong order.

    The build lacks all Januaries and the 20th of each month, and sends early flights of each 7th to a place that no
    airport has, with another delay. The load of day 3 brings January and the right flights of the 7th; then that of
    day 2 brings the 20ths and stale rows of January, which must not replace newer ones.
    """
    f = _stored_flights(spark, sf_dir)
    day, january = F.dayofmonth("fl_date"), F.month("fl_date") == 1
    seventh = (day == 7) & (F.col("dep_hour") < 6) & ~january
    twentieth = (day == 20) & ~january
    raw, root = scratch_path(spark, "raw"), scratch_path(spark, "lake")
    land_raw_inputs(spark, sf_dir, raw, flights=False)
    first = f.where(~january & ~twentieth).withColumns({
        "destination": F.when(seventh, "NOWHERE").otherwise(F.col("destination")),
        "dep_delay": F.when(seventh, F.lit(-77).cast("bigint")).otherwise(F.col("dep_delay"))})
    stale = f.where(january & (F.col("dep_hour") < 12)).withColumn("dep_delay", F.lit(-5).cast("bigint"))
    lake.build(spark, raw, root, _landed(first, 1), LAKE_FILE_ROWS)
    lake.refresh(spark, raw, root, _landed(f.where(january | seventh), 3), file_rows=LAKE_FILE_ROWS)
    lake.refresh(spark, raw, root, _landed(f.where(twentieth).unionByName(stale), 2), file_rows=LAKE_FILE_ROWS)
    return lake.open_lake(spark, root)


@register("lake_refresh_flights")
def lake_refresh_flights(spark, sf_dir):
    return _refreshed_lake(spark, sf_dir).read("flights").select(*FLIGHTS.fieldNames())


@register("lake_stored_duplicates")
def lake_stored_duplicates(spark, sf_dir):
    # A load of flights that are stored already (hour 0) and of the same with another distance, against the filters of all flights.
    flights = _stored_flights(spark, sf_dir)
    store = lake.open_lake(spark, scratch_path(spark, "lake"))
    change = store.change()
    rows = lake.with_partition_key(flights).select("*", F.lit(None).cast("timestamp").alias("landed"), F.lit("first").alias("landed_file"))
    change.replace("flights", rows, sizes=lake.day_counts(flights))
    lake.keep_filters(change, None)
    change.commit()
    again = flights.where("dep_hour = 0")
    found = lake.stored_duplicates(store, again.unionByName(again.withColumn("distance", F.col("distance") + 1)))
    return lake.with_partition_key(found).groupBy(PARTITION_KEY).agg(F.sum("copies").alias("stored_rows"))


@register("lake_refresh_carriers")
def lake_refresh_carriers(spark, sf_dir):
    # The carrier mart, kept from the stored histogram of the touched days only.
    return _refreshed_lake(spark, sf_dir).read("carrier_daily")


@register("lake_published_airports")
def lake_published_airports(spark, sf_dir):
    # The airport mart as published (CSV), read back. It is kept from signed route counts: connections to the place that
    # the refresh corrects must end.
    out = scratch_path(spark, "published")
    lake.export_marts(_refreshed_lake(spark, sf_dir), out)
    return spark.read.schema(DEPARTURE_AIRPORT).option("header", True).csv(f"{out}/departure_airport_stats")


@register("lake_published_states")
def lake_published_states(spark, sf_dir):
    out = scratch_path(spark, "published")
    lake.export_marts(_refreshed_lake(spark, sf_dir), out)
    return spark.read.schema(STATE_MONTHLY).option("header", True).csv(f"{out}/state_stats")


@register("lake_stream_daily")
def lake_stream_daily(spark, sf_dir):
    # The whole daily load from landed CSV files: a lake without January, then a stream that finds January twice, the
    # right version second.
    raw, root, landing = scratch_path(spark, "raw"), scratch_path(spark, "lake"), scratch_path(spark, "landing")
    land_raw_inputs(spark, sf_dir, raw, flights=False)
    rf = fixtures.raw_flights(spark, sf_dir)
    january = F.substring("FL_DATE", 6, 2) == "01"
    _land_csv(rf.where(~january), Layout(raw, root).raw("flights"))
    lake.build(spark, raw, root, file_rows=LAKE_FILE_ROWS)
    for name, rows in (("a", rf.withColumn("DEP_DELAY", F.lit(99).cast("bigint"))), ("b", rf)):
        _land_csv(rows.where(january), f"{landing}/{name}")
    run_daily_lake(spark, landing, raw, root, file_rows=LAKE_FILE_ROWS)
    return lake.open_lake(spark, root).read("combined").drop(PARTITION_KEY)


@register("carrier_month_quantiles")
def carrier_month_quantiles(spark, sf_dir):
    # Exact quartiles per month and carrier, merged from histograms of days.
    values = stats.histogram(flows.combined(spark, sf_dir), lake.CARRIER_DAY, marts.CARRIER_MEASURES)
    return stats.quantiles_from_histogram(values.withColumn("month", first_of_month("fl_date")), ["month", "op_unique_carrier"],
                                          list(marts.CARRIER_MEASURES), [0.25, 0.5, 0.75])


def queries() -> dict[str, Query]:
    return dict(_REGISTRY)
