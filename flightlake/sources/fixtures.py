"""Flight-shaped inputs derived from the driver's star-schema tables.

The flight tables are not shipped with the data, so each raw input is
mapped onto the TPC-H-style tables: a line item is a flight, the supplier's
nation is the origin airport, the customer's nation the destination, a
region is a state, customers per region are its population, a part brand
is an operating carrier. Everything is a DataFrame plan over the parquet
tables, so the work grows with the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.operators.joins import sized_broadcast

# Fixed values of the fixture lookups (status code -> text).
CANCELLATION_CODES = [(0, "Not Cancelled"), (1, "Reason 1"), (2, "Reason 2")]
WEATHER_CODES = [(1, "w1"), (2, "w2"), (3, "w3"), (4, "w4"), (5, "w5")]
# The region left without population, so unmatched keys occur.
REGION_WITHOUT_POPULATION = "ASIA"
# Marketing carriers are drawn from 30 brand numbers; only 25 exist.
MARKETING_BRANDS = 30


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; its schema is read from the file footer once per path."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _s(c: Column) -> Column:
    return c.cast("string")


def _two(c: Column) -> Column:
    return F.lpad(_s(c), 2, "0")


def raw_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw flights with the 40 upper-case columns and raw types."""
    # what a line item gives is computed before the joins: past the broadcast bound its rows are shuffled, and these are the narrowest
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate",
        F.when(F.col("l_returnflag") == "R", F.lit(None).cast("bigint"))
         .otherwise(F.col("l_quantity").cast("bigint") - 10).alias("delay"),
        F.floor(F.col("l_extendedprice") / 100).cast("bigint").alias("air_time"),
        F.when(F.col("l_returnflag") == "N", 0).when(F.col("l_returnflag") == "A", 1).otherwise(2).alias("status"),
        F.coalesce(F.col("l_linestatus") == "O", F.lit(False)).alias("high"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    # every side is broadcast behind a check of its files; the nations, which are always few, join after all that may be shuffled
    dest_nation = sized_broadcast(nation.select(F.col("n_nationkey").alias("dest_key"),
                                            F.col("n_name").alias("dest_name")))
    orig_nation = sized_broadcast(nation.select(F.col("n_nationkey").alias("s_nationkey"),
                                            F.col("n_name").alias("origin_name")))
    cust = sized_broadcast(customer)
    dest = orders.join(cust, orders.o_custkey == cust.c_custkey).select(
        F.col("o_orderkey"), F.col("c_nationkey").alias("dest_key"), "c_mktsegment")
    dest = sized_broadcast(dest)
    orig = supplier.join(orig_nation, "s_nationkey").select(
        "s_suppkey", "origin_name", F.col("s_nationkey").alias("origin_key"))
    orig = sized_broadcast(orig)
    part = sized_broadcast(part)

    f = (li.join(dest, li.l_orderkey == dest.o_orderkey).drop("o_orderkey")
           .join(part, li.l_partkey == part.p_partkey).drop("p_partkey")
           .join(orig, li.l_suppkey == orig.s_suppkey)
           .join(dest_nation, "dest_key"))

    ln = F.col("l_linenumber")
    ok = F.col("l_orderkey")
    day = F.date_format("l_shipdate", "yyyy-MM-dd")
    hour = _two(ok % 24)
    psize = F.col("p_size")
    cols = {
        "FL_DATE": day,
        "DEP_HOUR": (ok % 24).cast("bigint"),
        "MKT_UNIQUE_CARRIER": F.concat(F.lit("Brand#"), _s(F.col("l_suppkey") % MARKETING_BRANDS + 1)),
        "MKT_CARRIER_FL_NUM": F.col("l_partkey").cast("bigint"),
        "OP_UNIQUE_CARRIER": F.col("p_brand"),
        "OP_CARRIER_FL_NUM": ok.cast("bigint"),
        "TAIL_NUM": F.concat(F.lit("N"), _s(F.col("l_suppkey"))),
        "ORIGIN": F.col("origin_name"),
        "DEST": F.col("dest_name"),
        "DEP_TIME": F.concat(day, F.lit(" "), hour, F.lit(":"), _two(ln * 7 % 60), F.lit(":00")),
        "CRS_DEP_TIME": F.concat(day, F.lit(" "), hour, F.lit(":00:00")),
        "TAXI_OUT": (ln + 5).cast("bigint"),
        "DEP_DELAY": F.col("delay"),
        "AIR_TIME": F.col("air_time"),
        "DISTANCE": (psize * 50).cast("bigint"),
        "CANCELLED": F.col("status").cast("bigint"),
        "LATITUDE": (F.col("origin_key") * 7 - 85).cast("double"),
        "LONGITUDE": (F.col("origin_key") * 14 - 170).cast("double"),
        "ELEVATION": (F.col("origin_key") * 100).cast("bigint"),
        "MESONET_STATION": F.concat(F.lit("K"), F.substring("origin_name", 1, 3)),
        "YEAR_OF_MANUFACTURE": (F.col("l_partkey") % 40 + 1980).cast("bigint"),
        "MANUFACTURER": F.col("c_mktsegment"),
        "ICAO TYPE": F.concat(F.lit("T"), _s(psize)),
        "RANGE": F.when(psize < 17, "Short").when(psize < 34, "Medium").otherwise("Long"),
        "WIDTH": F.when(psize % 2 == 0, "Narrow").otherwise("Wide"),
        "WIND_DIR": (ok % 36 * 10).cast("double"),
        "WIND_SPD": (ln * 3).cast("double"),
        "WIND_GUST": F.when(ln > 3, F.lit(None).cast("double")).otherwise((ln * 5).cast("double")),
        "VISIBILITY": (10 - ln).cast("double"),
        "TEMPERATURE": (F.col("dest_key") - 5).cast("double"),
        "DEW_POINT": (F.col("origin_key") - 10).cast("double"),
        "REL_HUMIDITY": (F.col("l_partkey") % 100).cast("double"),
        "ALTIMETER": (ln + 2990).cast("double") / 100,
        "LOWEST_CLOUD_LAYER": (ln * 1000).cast("double"),
        "N_CLOUD_LAYER": (ln % 4).cast("double"),
        "LOW_LEVEL_CLOUD": (ln % 2).cast("double"),
        "MID_LEVEL_CLOUD": (ok % 2).cast("double"),
        "HIGH_LEVEL_CLOUD": F.when(F.col("high"), 1.0).otherwise(0.0),
        "CLOUD_COVER": (ln % 4).cast("double") / 4,
        "ACTIVE_WEATHER": ln.cast("double"),
    }
    return f.select(*[c.alias(n) for n, c in cols.items()])


def raw_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Airports: one per nation, located in its region (the 'state')."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    j = nation.join(sized_broadcast(region), nation.n_regionkey == region.r_regionkey)
    return j.select(
        F.col("n_name").alias("AIRPORT"),
        F.concat(F.col("n_name"), F.lit(" City")).alias("DISPLAY_AIRPORT_CITY_NAME_FULL"),
        F.col("r_name").alias("AIRPORT_STATE_NAME"),
        F.substring("r_name", 1, 2).alias("AIRPORT_STATE_CODE"),
        (F.col("n_nationkey") * 7 - 85).cast("double").alias("LATITUDE"),
        (F.col("n_nationkey") * 14 - 170).cast("double").alias("LONGITUDE"),
        F.substring("n_name", 1, 3).alias("FAA"),
    )


def raw_carriers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Carrier codes: the distinct part brands."""
    brands = table(spark, sf_dir, "part").select("p_brand").distinct()
    return brands.select(F.col("p_brand").alias("CODE"),
                         F.concat(F.lit("Carrier "), F.col("p_brand")).alias("DESCRIPTION"))


def _literal_rows(spark: SparkSession, rows: list[tuple[int, str]], key: str, value: str) -> DataFrame:
    """A few code rows as a plan literal, so that the planner knows their size."""
    entries = [F.struct(F.lit(k).cast("bigint").alias(key), F.lit(v).alias(value)) for k, v in rows]
    return spark.range(1).select(F.inline(F.array(*entries)))


def raw_cancellation_codes(spark: SparkSession) -> DataFrame:
    return _literal_rows(spark, CANCELLATION_CODES, "STATUS", "CANCELLATION_REASON")


def raw_weather_codes(spark: SparkSession) -> DataFrame:
    return _literal_rows(spark, WEATHER_CODES, "STATUS", "WEATHER_DESCRIPTION")


def population_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Census-style records (all strings, header names) per region.

    Population is the number of customers in the region; one region is left
    out. Both spellings of the update month occur.
    """
    customer = table(spark, sf_dir, "customer").select("c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region")
    per_nation = customer.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("n"))
    per_region = (per_nation.join(sized_broadcast(nation), per_nation.c_nationkey == nation.n_nationkey)
                  .groupBy("n_regionkey").agg(F.sum("n").alias("pop")))
    j = (per_region.join(sized_broadcast(region), per_region.n_regionkey == region.r_regionkey)
         .where(F.col("r_name") != REGION_WITHOUT_POPULATION))
    code = _two(F.col("r_regionkey"))
    return j.select(
        F.col("r_name").alias("NAME"),
        F.when(F.col("r_regionkey") % 2 == 0, F.lit("Dec. 21, 2021"))
         .otherwise(F.lit("December. 21, 2021")).alias("LASTUPDATE"),
        code.alias("STATE"),
        _s(F.col("pop")).alias("POP_2021"),
        code.alias("state"),
    )


def census_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A census-style response (JSON array of arrays, header first) as one
    text row, built from :func:`population_records`.

    The response format is one document with one record per state, so this
    gathers at most one small record per region into a single row.
    """
    from flightlake.schemas import CENSUS_HEADER

    # Rename by position first: the header holds both STATE and state.
    n = len(CENSUS_HEADER)
    recs = population_records(spark, sf_dir).toDF(*[f"c{i}" for i in range(n)])
    rows = recs.select(F.array(*[F.col(f"c{i}") for i in range(n)]).alias("r"))
    body = rows.agg(F.sort_array(F.collect_list("r")).alias("rs"))
    header = F.array(*[F.lit(h) for h in CENSUS_HEADER])
    return body.select(F.to_json(F.concat(F.array(header), F.col("rs"))).alias("value"))


@dataclass
class RawInputs:
    flights: DataFrame
    airports: DataFrame
    population: DataFrame
    carriers: DataFrame
    cancellation_codes: DataFrame
    weather_codes: DataFrame


def raw_inputs(spark: SparkSession, sf_dir: str) -> RawInputs:
    return RawInputs(
        flights=raw_flights(spark, sf_dir),
        airports=raw_airports(spark, sf_dir),
        population=population_records(spark, sf_dir),
        carriers=raw_carriers(spark, sf_dir),
        cancellation_codes=raw_cancellation_codes(spark),
        weather_codes=raw_weather_codes(spark),
    )
