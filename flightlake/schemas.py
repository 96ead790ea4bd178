"""Explicit schemas for every layer; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, B = T.StringType(), T.LongType(), T.DoubleType(), T.BooleanType()


def _struct(fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# Raw flights, in file order. Numbers that are cast later (cloud flags,
# active weather) arrive as doubles; dates and datetimes arrive as text.
RAW_FLIGHT_FIELDS = [
    ("FL_DATE", S), ("DEP_HOUR", L), ("MKT_UNIQUE_CARRIER", S),
    ("MKT_CARRIER_FL_NUM", L), ("OP_UNIQUE_CARRIER", S), ("OP_CARRIER_FL_NUM", L),
    ("TAIL_NUM", S), ("ORIGIN", S), ("DEST", S), ("DEP_TIME", S), ("CRS_DEP_TIME", S),
    ("TAXI_OUT", L), ("DEP_DELAY", L), ("AIR_TIME", L), ("DISTANCE", L), ("CANCELLED", L),
    ("LATITUDE", D), ("LONGITUDE", D), ("ELEVATION", L), ("MESONET_STATION", S),
    ("YEAR_OF_MANUFACTURE", L), ("MANUFACTURER", S), ("ICAO TYPE", S), ("RANGE", S),
    ("WIDTH", S), ("WIND_DIR", D), ("WIND_SPD", D), ("WIND_GUST", D), ("VISIBILITY", D),
    ("TEMPERATURE", D), ("DEW_POINT", D), ("REL_HUMIDITY", D), ("ALTIMETER", D),
    ("LOWEST_CLOUD_LAYER", D), ("N_CLOUD_LAYER", D), ("LOW_LEVEL_CLOUD", D),
    ("MID_LEVEL_CLOUD", D), ("HIGH_LEVEL_CLOUD", D), ("CLOUD_COVER", D),
    ("ACTIVE_WEATHER", D),
]
RAW_FLIGHTS = _struct(RAW_FLIGHT_FIELDS)

RAW_AIRPORTS = _struct([
    ("AIRPORT", S), ("DISPLAY_AIRPORT_CITY_NAME_FULL", S), ("AIRPORT_STATE_NAME", S),
    ("AIRPORT_STATE_CODE", S), ("LATITUDE", D), ("LONGITUDE", D), ("FAA", S),
])
RAW_CARRIERS = _struct([("CODE", S), ("DESCRIPTION", S)])
RAW_WEATHER_CODES = _struct([("STATUS", L), ("WEATHER_DESCRIPTION", S)])
RAW_CANCELLATION_CODES = _struct([("STATUS", L), ("CANCELLATION_REASON", S)])

# Census response: the header record, in order, and the typed result.
CENSUS_HEADER = ["NAME", "LASTUPDATE", "STATE", "POP_2021", "state"]
POPULATION = _struct([("name", S), ("last_update_date", T.DateType()),
                      ("state", S), ("population", L)])

# Typed flights (and the first 40 columns of the combined table).
FLIGHTS = _struct([
    ("fl_date", T.DateType()), ("dep_hour", L), ("mkt_unique_carrier", S),
    ("mkt_carrier_fl_num", S), ("op_unique_carrier", S), ("op_carrier_fl_num", S),
    ("tail_num", S), ("origin", S), ("destination", S),
    ("dep_time", T.TimestampNTZType()), ("crs_dep_time", T.TimestampNTZType()),
    ("taxi_out", L), ("dep_delay", L), ("air_time", L), ("distance", L), ("cancelled", L),
    ("latitude", D), ("longitude", D), ("elevation", L), ("mesonet_station", S),
    ("year_of_manufacture", L), ("manufacturer", S), ("range", S), ("width", S),
    ("wind_dir", D), ("wind_spd", D), ("wind_gust", D), ("visibility", D),
    ("temperature", D), ("dew_point", D), ("rel_humidity", D), ("altimeter", D),
    ("lowest_cloud_layer", D), ("n_cloud_layer", D), ("low_level_cloud", B),
    ("mid_level_cloud", B), ("high_level_cloud", B), ("cloud_cover", D),
    ("active_weather", L), ("icao_type", S),
])

ENRICHMENT = _struct([
    ("origin_state_name", S), ("origin_state_code", S),
    ("destination_state_name", S), ("destination_state_code", S),
    ("origin_state_population", L), ("destination_state_population", L),
    ("cancellation_reason", S), ("weather_description", S),
    ("mkt_carrier_name", S), ("op_carrier_name", S),
])
COMBINED = T.StructType(FLIGHTS.fields + ENRICHMENT.fields)

CARRIER_DAILY = _struct([
    ("fl_date", T.DateType()), ("op_unique_carrier", S),
    ("total_departure_delay", L), ("avg_departure_delay", D), ("median_departure_delay", D),
    ("total_airtime", L), ("avg_airtime", D), ("median_airtime", D),
    ("total_distance", L), ("avg_distance", D), ("median_distance", D),
])
DEPARTURE_AIRPORT = _struct([
    ("origin", S), ("count_connections", L), ("count_departures", L), ("count_arrivals", L),
])
STATE_MONTHLY = _struct([
    ("month", T.DateType()), ("origin_state_name", S), ("origin_state_code", S),
    ("count_departures", L), ("count_unique_airports", L),
    ("count_unique_operating_carriers", L), ("count_citizens", L),
    ("airports_per_million_citizens", D), ("departures_per_million_citizens", D),
])

# Typed flights with the time and file in which each row landed: the later one wins at every merge.
LANDED = _struct([("landed", T.TimestampType()), ("landed_file", S)])
FLIGHTS_LANDED = T.StructType(FLIGHTS.fields + LANDED.fields)
AIRPORTS = _struct([("airport", S), ("airport_state_name", S), ("airport_state_code", S), ("latitude", D), ("longitude", D)])
# How often each value of a measure occurs per day and carrier; flights per route.
CARRIER_VALUES = _struct([("fl_date", T.DateType()), ("op_unique_carrier", S), ("m", T.ByteType()), ("v", L), ("c", L)])
ROUTES = _struct([("year_month", S), ("origin", S), ("destination", S), ("op_unique_carrier", S),
                  ("origin_state_name", S), ("origin_state_code", S), ("flights", L), ("origin_state_population", L)])
ROUTE_TOTALS = _struct([("origin", S), ("destination", S), ("flights", L)])

# Flight key used by incremental loads (last load wins).
FLIGHT_KEY = ["fl_date", "op_unique_carrier", "op_carrier_fl_num", "origin", "crs_dep_time"]

# Columns a flight row must carry (checked non-null per month).
FLIGHT_REQUIRED = ["fl_date", "origin", "destination", "op_unique_carrier", "mkt_unique_carrier"]
