"""DuckDB SQL that computes each registered query independently.

The fixture views are spelled out once (raw flights with raw types, then
typed flights, lookups, combined) and each query adds its final SELECT.
"""

from __future__ import annotations

RAW = r"""
raw_flights AS (
 SELECT
  strftime(l_shipdate, '%Y-%m-%d') AS "FL_DATE",
  CAST(l_orderkey % 24 AS BIGINT) AS "DEP_HOUR",
  concat('Brand#', CAST(l_suppkey % 30 + 1 AS VARCHAR)) AS "MKT_UNIQUE_CARRIER",
  CAST(l_partkey AS BIGINT) AS "MKT_CARRIER_FL_NUM",
  p_brand AS "OP_UNIQUE_CARRIER",
  CAST(l_orderkey AS BIGINT) AS "OP_CARRIER_FL_NUM",
  concat('N', CAST(l_suppkey AS VARCHAR)) AS "TAIL_NUM",
  sn.n_name AS "ORIGIN",
  cn.n_name AS "DEST",
  concat(strftime(l_shipdate, '%Y-%m-%d'), ' ', lpad(CAST(l_orderkey % 24 AS VARCHAR), 2, '0'), ':',
         lpad(CAST(l_linenumber * 7 % 60 AS VARCHAR), 2, '0'), ':00') AS "DEP_TIME",
  concat(strftime(l_shipdate, '%Y-%m-%d'), ' ', lpad(CAST(l_orderkey % 24 AS VARCHAR), 2, '0'), ':00:00') AS "CRS_DEP_TIME",
  CAST(l_linenumber + 5 AS BIGINT) AS "TAXI_OUT",
  CASE WHEN l_returnflag = 'R' THEN NULL ELSE CAST(l_quantity AS BIGINT) - 10 END AS "DEP_DELAY",
  CAST(floor(l_extendedprice / 100) AS BIGINT) AS "AIR_TIME",
  CAST(p_size * 50 AS BIGINT) AS "DISTANCE",
  CAST(CASE WHEN l_returnflag = 'N' THEN 0 WHEN l_returnflag = 'A' THEN 1 ELSE 2 END AS BIGINT) AS "CANCELLED",
  CAST(sn.n_nationkey * 7 - 85 AS DOUBLE) AS "LATITUDE",
  CAST(sn.n_nationkey * 14 - 170 AS DOUBLE) AS "LONGITUDE",
  CAST(sn.n_nationkey * 100 AS BIGINT) AS "ELEVATION",
  concat('K', substr(sn.n_name, 1, 3)) AS "MESONET_STATION",
  CAST(l_partkey % 40 + 1980 AS BIGINT) AS "YEAR_OF_MANUFACTURE",
  c_mktsegment AS "MANUFACTURER",
  concat('T', CAST(p_size AS VARCHAR)) AS "ICAO TYPE",
  CASE WHEN p_size < 17 THEN 'Short' WHEN p_size < 34 THEN 'Medium' ELSE 'Long' END AS "RANGE",
  CASE WHEN p_size % 2 = 0 THEN 'Narrow' ELSE 'Wide' END AS "WIDTH",
  CAST(l_orderkey % 36 * 10 AS DOUBLE) AS "WIND_DIR",
  CAST(l_linenumber * 3 AS DOUBLE) AS "WIND_SPD",
  CASE WHEN l_linenumber > 3 THEN NULL ELSE CAST(l_linenumber * 5 AS DOUBLE) END AS "WIND_GUST",
  CAST(10 - l_linenumber AS DOUBLE) AS "VISIBILITY",
  CAST(cn.n_nationkey - 5 AS DOUBLE) AS "TEMPERATURE",
  CAST(sn.n_nationkey - 10 AS DOUBLE) AS "DEW_POINT",
  CAST(l_partkey % 100 AS DOUBLE) AS "REL_HUMIDITY",
  CAST(l_linenumber + 2990 AS DOUBLE) / 100 AS "ALTIMETER",
  CAST(l_linenumber * 1000 AS DOUBLE) AS "LOWEST_CLOUD_LAYER",
  CAST(l_linenumber % 4 AS DOUBLE) AS "N_CLOUD_LAYER",
  CAST(l_linenumber % 2 AS DOUBLE) AS "LOW_LEVEL_CLOUD",
  CAST(l_orderkey % 2 AS DOUBLE) AS "MID_LEVEL_CLOUD",
  CASE WHEN l_linestatus = 'O' THEN 1.0 ELSE 0.0 END AS "HIGH_LEVEL_CLOUD",
  CAST(l_linenumber % 4 AS DOUBLE) / 4 AS "CLOUD_COVER",
  CAST(l_linenumber AS DOUBLE) AS "ACTIVE_WEATHER"
 FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN part ON l_partkey = p_partkey
  JOIN nation sn ON s_nationkey = sn.n_nationkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey
)"""

TYPED = r"""
flights AS (
 SELECT
  CAST("FL_DATE" AS DATE) AS fl_date, "DEP_HOUR" AS dep_hour,
  "MKT_UNIQUE_CARRIER" AS mkt_unique_carrier,
  CASE WHEN length(CAST("MKT_CARRIER_FL_NUM" AS VARCHAR)) < 4
       THEN lpad(CAST("MKT_CARRIER_FL_NUM" AS VARCHAR), 4, '0')
       ELSE CAST("MKT_CARRIER_FL_NUM" AS VARCHAR) END AS mkt_carrier_fl_num,
  "OP_UNIQUE_CARRIER" AS op_unique_carrier,
  CASE WHEN length(CAST("OP_CARRIER_FL_NUM" AS VARCHAR)) < 4
       THEN lpad(CAST("OP_CARRIER_FL_NUM" AS VARCHAR), 4, '0')
       ELSE CAST("OP_CARRIER_FL_NUM" AS VARCHAR) END AS op_carrier_fl_num,
  "TAIL_NUM" AS tail_num, "ORIGIN" AS origin, "DEST" AS destination,
  CAST("DEP_TIME" AS TIMESTAMP) AS dep_time, CAST("CRS_DEP_TIME" AS TIMESTAMP) AS crs_dep_time,
  "TAXI_OUT" AS taxi_out, "DEP_DELAY" AS dep_delay, "AIR_TIME" AS air_time,
  "DISTANCE" AS distance, "CANCELLED" AS cancelled,
  "LATITUDE" AS latitude, "LONGITUDE" AS longitude, "ELEVATION" AS elevation,
  "MESONET_STATION" AS mesonet_station, "YEAR_OF_MANUFACTURE" AS year_of_manufacture,
  "MANUFACTURER" AS manufacturer, "RANGE" AS "range", "WIDTH" AS width,
  "WIND_DIR" AS wind_dir, "WIND_SPD" AS wind_spd, "WIND_GUST" AS wind_gust,
  "VISIBILITY" AS visibility, "TEMPERATURE" AS temperature, "DEW_POINT" AS dew_point,
  "REL_HUMIDITY" AS rel_humidity, "ALTIMETER" AS altimeter,
  "LOWEST_CLOUD_LAYER" AS lowest_cloud_layer, "N_CLOUD_LAYER" AS n_cloud_layer,
  "LOW_LEVEL_CLOUD" <> 0 AS low_level_cloud, "MID_LEVEL_CLOUD" <> 0 AS mid_level_cloud,
  "HIGH_LEVEL_CLOUD" <> 0 AS high_level_cloud, "CLOUD_COVER" AS cloud_cover,
  CAST(trunc("ACTIVE_WEATHER") AS BIGINT) AS active_weather,
  "ICAO TYPE" AS icao_type
 FROM raw_flights
),
airports AS (
 SELECT n_name AS airport, r_name AS airport_state_name, substr(r_name, 1, 2) AS airport_state_code,
  CAST(n_nationkey * 7 - 85 AS DOUBLE) AS latitude, CAST(n_nationkey * 14 - 170 AS DOUBLE) AS longitude
 FROM nation JOIN region ON n_regionkey = r_regionkey
),
population AS (
 SELECT r_name AS name, DATE '2021-12-21' AS last_update_date,
  lpad(CAST(r_regionkey AS VARCHAR), 2, '0') AS state, CAST(count(*) AS BIGINT) AS population
 FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
 WHERE r_name <> 'ASIA' GROUP BY r_name, r_regionkey
),
carriers AS (SELECT DISTINCT p_brand AS code, concat('Carrier ', p_brand) AS description FROM part),
cancellation_codes AS (SELECT * FROM (VALUES (0, 'Not Cancelled'), (1, 'Reason 1'), (2, 'Reason 2')) t(status, cancellation_reason)),
weather_codes AS (SELECT * FROM (VALUES (1, 'w1'), (2, 'w2'), (3, 'w3'), (4, 'w4'), (5, 'w5')) t(status, weather_description)),
combined AS (
 SELECT f.*,
  o.airport_state_name AS origin_state_name, o.airport_state_code AS origin_state_code,
  e.airport_state_name AS destination_state_name, e.airport_state_code AS destination_state_code,
  po.population AS origin_state_population, pd.population AS destination_state_population,
  cc.cancellation_reason, w.weather_description,
  m.description AS mkt_carrier_name, op.description AS op_carrier_name
 FROM flights f
  LEFT JOIN airports o ON f.origin = o.airport
  LEFT JOIN airports e ON f.destination = e.airport
  LEFT JOIN population po ON o.airport_state_name = po.name
  LEFT JOIN population pd ON e.airport_state_name = pd.name
  LEFT JOIN cancellation_codes cc ON f.cancelled = cc.status
  LEFT JOIN weather_codes w ON f.active_weather = w.status
  LEFT JOIN carriers m ON f.mkt_unique_carrier = m.code
  LEFT JOIN carriers op ON f.op_unique_carrier = op.code
)"""


def with_views(select: str) -> str:
    body = select.strip()
    if body.startswith(","):
        # extra CTEs: ", name AS (...)\nSELECT ..."
        return "WITH" + RAW + "," + TYPED + body
    return "WITH" + RAW + "," + TYPED + "\n" + body


_Q: dict[str, str] = {}


def q(name: str, select: str) -> None:
    _Q[name] = with_views(select)


q("combined_wide", "SELECT * FROM combined")

q("join_hybrid_all", "SELECT * FROM combined")

q("flights_typed", "SELECT * FROM flights")

q("clustered_year_at_airport", """
SELECT * FROM flights WHERE origin = (SELECT min(origin) FROM flights)
 AND fl_date <= (SELECT min(fl_date) FROM flights) + INTERVAL 364 DAY""")

q("carrier_daily", """
SELECT fl_date, op_unique_carrier,
 CAST(sum(dep_delay) AS BIGINT) AS total_departure_delay, avg(dep_delay) AS avg_departure_delay,
 CAST(median(dep_delay) AS DOUBLE) AS median_departure_delay,
 CAST(sum(air_time) AS BIGINT) AS total_airtime, avg(air_time) AS avg_airtime,
 CAST(median(air_time) AS DOUBLE) AS median_airtime,
 CAST(sum(distance) AS BIGINT) AS total_distance, avg(distance) AS avg_distance,
 CAST(median(distance) AS DOUBLE) AS median_distance
FROM combined GROUP BY fl_date, op_unique_carrier ORDER BY fl_date, op_unique_carrier""")

q("departure_airport", """
SELECT d.origin, d.count_connections, d.count_departures, a.count_arrivals
FROM (SELECT origin, CAST(count(DISTINCT destination) AS BIGINT) AS count_connections,
             CAST(count(*) AS BIGINT) AS count_departures FROM combined GROUP BY origin) d
JOIN (SELECT destination, CAST(count(*) AS BIGINT) AS count_arrivals FROM combined GROUP BY destination) a
  ON d.origin = a.destination
ORDER BY count_connections DESC, origin""")

_Q["departure_airport_via_routes"] = _Q["departure_airport"]
_Q["incremental_refresh"] = _Q["carrier_daily"]

q("state_monthly", """
SELECT month, origin_state_name, origin_state_code, count_departures, count_unique_airports,
 count_unique_operating_carriers, count_citizens,
 CASE WHEN count_citizens = 0 THEN NULL ELSE CAST(1000000 * count_unique_airports AS DOUBLE) / count_citizens END
   AS airports_per_million_citizens,
 CASE WHEN count_citizens = 0 THEN NULL ELSE CAST(1000000 * count_departures AS DOUBLE) / count_citizens END
   AS departures_per_million_citizens
FROM (SELECT CAST(date_trunc('month', fl_date) AS DATE) AS month, origin_state_name, origin_state_code,
        CAST(count(*) AS BIGINT) AS count_departures,
        CAST(count(DISTINCT origin) AS BIGINT) AS count_unique_airports,
        CAST(count(DISTINCT op_unique_carrier) AS BIGINT) AS count_unique_operating_carriers,
        min(origin_state_population) AS count_citizens
      FROM combined GROUP BY 1, 2, 3) s
ORDER BY month, count_departures DESC, origin_state_name""")

_Q["state_monthly_via_routes"] = _Q["state_monthly"]

FID = "f.fl_date, f.op_carrier_fl_num, f.origin, f.destination"

q("join_origin_state", f"""
SELECT {FID}, a.airport_state_name AS origin_state_name, a.airport_state_code AS origin_state_code
FROM flights f LEFT JOIN airports a ON f.origin = a.airport""")

q("join_destination_state", f"""
SELECT {FID}, a.airport_state_name AS destination_state_name, a.airport_state_code AS destination_state_code
FROM flights f LEFT JOIN airports a ON f.destination = a.airport""")

q("join_population_both", """
SELECT fl_date, op_carrier_fl_num, origin, destination, origin_state_name, destination_state_name,
 origin_state_population, destination_state_population FROM combined""")

q("join_cancellation", f"""
SELECT {FID}, f.cancelled, c.cancellation_reason
FROM flights f LEFT JOIN cancellation_codes c ON f.cancelled = c.status""")

q("join_weather", f"""
SELECT {FID}, f.active_weather, w.weather_description
FROM flights f LEFT JOIN weather_codes w ON f.active_weather = w.status""")

q("join_carrier_roles", f"""
SELECT {FID}, f.mkt_unique_carrier, f.op_unique_carrier,
 m.description AS mkt_carrier_name, o.description AS op_carrier_name
FROM flights f LEFT JOIN carriers m ON f.mkt_unique_carrier = m.code
 LEFT JOIN carriers o ON f.op_unique_carrier = o.code""")

q("join_cardinality_guard", """
SELECT b.rows_before, a.rows_after, b.rows_before = a.rows_after AS counts_match
FROM (SELECT CAST(count(*) AS BIGINT) AS rows_before FROM flights) b,
     (SELECT CAST(count(*) AS BIGINT) AS rows_after FROM combined) a""")

q("airport_missing_arrivals", """
SELECT d.origin, d.count_connections, d.count_departures, a.count_arrivals
FROM (SELECT origin, CAST(count(DISTINCT destination) AS BIGINT) AS count_connections,
             CAST(count(*) AS BIGINT) AS count_departures
      FROM combined WHERE destination_state_name IS DISTINCT FROM 'EUROPE' GROUP BY origin) d
JOIN (SELECT destination, CAST(count(*) AS BIGINT) AS count_arrivals
      FROM combined WHERE destination_state_name IS DISTINCT FROM 'EUROPE' GROUP BY destination) a
  ON d.origin = a.destination""")

PAD = ("CASE WHEN length(CAST(flight_number AS VARCHAR)) < 4 THEN lpad(CAST(flight_number AS VARCHAR), 4, '0') "
       "ELSE CAST(flight_number AS VARCHAR) END")
q("zero_pad_flight_number", f"""
SELECT flight_number, {PAD} AS padded, CAST(length({PAD}) AS BIGINT) AS padded_length
FROM (SELECT "OP_CARRIER_FL_NUM" AS flight_number FROM raw_flights
      UNION SELECT "MKT_CARRIER_FL_NUM" FROM raw_flights) n""")

q("population_typed", "SELECT name, last_update_date, state, population FROM population ORDER BY name")
q("census_json_table", "SELECT name, last_update_date, state, population FROM population ORDER BY name")

MONTH_COUNTS = """
SELECT strftime(fl_date, '%Y_%m') AS year_month, CAST(count(*) AS BIGINT) AS rows
FROM flights GROUP BY 1"""
q("partition_month_counts", MONTH_COUNTS)
q("stream_daily_load", """
SELECT strftime(fl_date, '%Y_%m') AS year_month, CAST(count(*) AS BIGINT) AS rows, CAST(sum(dep_delay) AS BIGINT) AS delay
FROM flights GROUP BY 1""")

q("partition_year_month_counts", """
SELECT strftime(fl_date, '%Y') AS year, strftime(fl_date, '%m') AS month, CAST(count(*) AS BIGINT) AS rows
FROM flights GROUP BY 1, 2""")

q("monthly_concat", """
SELECT fl_date, op_unique_carrier,
 CAST(sum(dep_delay) AS BIGINT) AS total_departure_delay, avg(dep_delay) AS avg_departure_delay,
 CAST(median(dep_delay) AS DOUBLE) AS median_departure_delay,
 CAST(sum(air_time) AS BIGINT) AS total_airtime, avg(air_time) AS avg_airtime,
 CAST(median(air_time) AS DOUBLE) AS median_airtime,
 CAST(sum(distance) AS BIGINT) AS total_distance, avg(distance) AS avg_distance,
 CAST(median(distance) AS DOUBLE) AS median_distance
FROM combined GROUP BY fl_date, op_unique_carrier""")

REQ = ["fl_date", "origin", "destination", "op_unique_carrier", "mkt_unique_carrier"]
NULLS_REQ = ",\n ".join(f"CAST(count_if({c} IS NULL) AS BIGINT) AS null_{c}" for c in REQ)


def _flight_metrics(flights: str) -> str:
    return f"""
SELECT m.*, CAST(coalesce(d.duplicate_groups, 0) AS BIGINT) AS duplicate_groups,
 CAST(coalesce(d.surplus_rows, 0) AS BIGINT) AS surplus_rows
FROM (SELECT strftime(fl_date, '%Y_%m') AS year_month, CAST(count(*) AS BIGINT) AS rows,
        CAST(count_if(NOT (latitude BETWEEN -90 AND 90)) AS BIGINT) AS latitude_out_of_range,
        CAST(count_if(NOT (longitude BETWEEN -180 AND 180)) AS BIGINT) AS longitude_out_of_range,
        {NULLS_REQ}
      FROM {flights} GROUP BY 1) m
LEFT JOIN (SELECT year_month, count(*) AS duplicate_groups, sum(c - 1) AS surplus_rows
           FROM (SELECT strftime(fl_date, '%Y_%m') AS year_month, c
                 FROM (SELECT *, count(*) AS c FROM {flights} GROUP BY ALL HAVING count(*) > 1) x) y
           GROUP BY year_month) d
  ON m.year_month IS NOT DISTINCT FROM d.year_month"""


q("dq_flights_metrics", _flight_metrics("flights"))
BROKEN = """
(SELECT * REPLACE (CASE WHEN dep_hour = 1 THEN 90.5 ELSE latitude END AS latitude,
   CASE WHEN dep_hour = 2 THEN -180.5 ELSE longitude END AS longitude,
   CASE WHEN dep_hour = 3 THEN NULL ELSE destination END AS destination,
   CASE WHEN dep_hour = 4 THEN NULL ELSE fl_date END AS fl_date) FROM flights
 UNION ALL SELECT * FROM flights WHERE dep_hour = 5 UNION ALL SELECT * FROM flights WHERE dep_hour = 5)"""
q("dq_flights_violations", _flight_metrics(BROKEN))

AIRPORT_COLS = ["airport", "airport_state_name", "airport_state_code", "latitude", "longitude"]


def _airport_metrics(airports: str, columns: list[str]) -> str:
    nulls = ", ".join(f"CAST(count_if({c} IS NULL) AS BIGINT) AS null_{c}" for c in columns)
    return f"""
SELECT m.*, d.duplicate_groups, d.surplus_rows
FROM (SELECT CAST(count(*) AS BIGINT) AS rows,
        CAST(count_if(NOT (latitude BETWEEN -90 AND 90)) AS BIGINT) AS latitude_out_of_range,
        CAST(count_if(NOT (longitude BETWEEN -180 AND 180)) AS BIGINT) AS longitude_out_of_range,
        {nulls}
      FROM {airports}) m,
     (SELECT CAST(count(*) AS BIGINT) AS duplicate_groups, CAST(coalesce(sum(c - 1), 0) AS BIGINT) AS surplus_rows
      FROM (SELECT {", ".join(columns)}, count(*) AS c FROM {airports} GROUP BY ALL HAVING count(*) > 1) x) d"""


q("dq_airports_metrics", _airport_metrics("airports", AIRPORT_COLS))
q("dq_airports_violations", _airport_metrics("""
(SELECT * REPLACE (CASE WHEN airport_state_code = 'AF' THEN latitude - 100 ELSE latitude END AS latitude,
   CASE WHEN airport_state_code = 'EU' THEN longitude + 400 ELSE longitude END AS longitude,
   CASE WHEN airport_state_code = 'AS' THEN NULL ELSE airport_state_name END AS airport_state_name) FROM airports
 UNION ALL SELECT * FROM airports WHERE airport_state_code = 'AM')""", AIRPORT_COLS))
q("airports_extra_columns", _airport_metrics("""
(SELECT *, CASE WHEN airport_state_code <> 'AS' THEN lower(airport_state_code) END AS time_zone FROM airports)""",
                                             [*AIRPORT_COLS, "time_zone"]))

POP_COLS = ["name", "last_update_date", "state", "population"]
q("dq_population_metrics", f"""
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count_if(population < 0) AS BIGINT) AS negative_population,
 {", ".join(f"CAST(count_if({c} IS NULL) AS BIGINT) AS null_{c}" for c in POP_COLS)}
FROM population""")

q("dq_population_violations", f"""
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count_if(population < 0) AS BIGINT) AS negative_population,
 {", ".join(f"CAST(count_if({c} IS NULL) AS BIGINT) AS null_{c}" for c in POP_COLS)}
FROM (SELECT * REPLACE (CASE WHEN name = 'EUROPE' THEN -population ELSE population END AS population) FROM population)""")

q("dq_duplicates", """
SELECT year_month, CAST(count(*) AS BIGINT) AS duplicate_groups, CAST(sum(c - 1) AS BIGINT) AS surplus_rows
FROM (SELECT *, count(*) AS c
      FROM (SELECT *, strftime(fl_date, '%Y_%m') AS year_month FROM flights
            UNION ALL SELECT *, strftime(fl_date, '%Y_%m') AS year_month FROM flights WHERE dep_hour = 0) s
      GROUP BY ALL HAVING count(*) > 1) x
GROUP BY year_month""")

q("lake_stored_duplicates", """
SELECT year_month, CAST(sum(loaded) AS BIGINT) AS stored_rows
FROM (SELECT * EXCLUDE (stored, loaded), sum(stored) AS stored, sum(loaded) AS loaded
      FROM (SELECT *, strftime(fl_date, '%Y_%m') AS year_month, 1 AS stored, 0 AS loaded FROM flights
            UNION ALL SELECT *, strftime(fl_date, '%Y_%m') AS year_month, 0, 1 FROM flights WHERE dep_hour = 0
            UNION ALL SELECT * REPLACE (distance + 1 AS distance), strftime(fl_date, '%Y_%m') AS year_month, 0, 1 FROM flights WHERE dep_hour = 0) s
      GROUP BY ALL) x
WHERE stored > 0 AND loaded > 0
GROUP BY year_month""")

COMBINED_COLS = [
    "fl_date", "dep_hour", "mkt_unique_carrier", "mkt_carrier_fl_num", "op_unique_carrier",
    "op_carrier_fl_num", "tail_num", "origin", "destination", "dep_time", "crs_dep_time",
    "taxi_out", "dep_delay", "air_time", "distance", "cancelled", "latitude", "longitude",
    "elevation", "mesonet_station", "year_of_manufacture", "manufacturer", "range", "width",
    "wind_dir", "wind_spd", "wind_gust", "visibility", "temperature", "dew_point",
    "rel_humidity", "altimeter", "lowest_cloud_layer", "n_cloud_layer", "low_level_cloud",
    "mid_level_cloud", "high_level_cloud", "cloud_cover", "active_weather", "icao_type",
    "origin_state_name", "origin_state_code", "destination_state_name", "destination_state_code",
    "origin_state_population", "destination_state_population", "cancellation_reason",
    "weather_description", "mkt_carrier_name", "op_carrier_name",
]
q("null_profile_long", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", CAST(count(*) - count(\"{c}\") AS BIGINT) AS null_count FROM combined"
    for c in COMBINED_COLS))


def _most_delayed(by: str) -> str:
    return f"""
SELECT {by}, CAST(count(*) AS BIGINT) AS flights, CAST(count_if(dep_delay > 0) AS BIGINT) AS delayed_flights,
 CAST(coalesce(sum(CASE WHEN dep_delay > 0 THEN dep_delay END), 0) AS BIGINT) AS total_delay_minutes
FROM combined GROUP BY {by}
ORDER BY total_delay_minutes DESC, delayed_flights DESC, {by} LIMIT 10"""


q("top_delayed_airlines", _most_delayed("op_unique_carrier"))
q("top_delayed_airports", _most_delayed("origin"))

q("on_time_performance", """
SELECT op_unique_carrier, CAST(count(dep_delay) AS BIGINT) AS flights_with_delay,
 CAST(count_if(dep_delay IS NULL) AS BIGINT) AS flights_without_delay,
 CAST(count_if(dep_delay <= 15) AS BIGINT) AS on_time_flights,
 CASE WHEN count(dep_delay) = 0 THEN NULL
      ELSE CAST(count_if(dep_delay <= 15) AS DOUBLE) / CAST(count(dep_delay) AS DOUBLE) END AS on_time_ratio
FROM combined GROUP BY op_unique_carrier""")

q("busiest_airports_monthly", """
SELECT * FROM (
 SELECT month, origin, departures,
  row_number() OVER (PARTITION BY month ORDER BY departures DESC, origin) AS rank
 FROM (SELECT CAST(date_trunc('month', fl_date) AS DATE) AS month, origin, CAST(count(*) AS BIGINT) AS departures
       FROM combined GROUP BY 1, 2) p) r
WHERE rank <= 3""")

CANCEL_KEYS = {
    "month": "CAST(date_trunc('month', fl_date) AS DATE)",
    "airport": "origin",
    "airline": "op_unique_carrier",
}
for dim, expr in CANCEL_KEYS.items():
    q(f"cancellation_reasons_by_{dim}", f"""
SELECT {dim}, cancellation_reason, cancellations,
 row_number() OVER (PARTITION BY {dim} ORDER BY cancellations DESC, cancellation_reason NULLS LAST) AS rank
FROM (SELECT {expr} AS {dim}, cancellation_reason, CAST(count(*) AS BIGINT) AS cancellations
      FROM combined WHERE cancelled <> 0 GROUP BY 1, 2) p""")

q("cancellation_reasons_all", "SELECT dimension, value, cancellation_reason, cancellations,\n"
  " row_number() OVER (PARTITION BY dimension, value ORDER BY cancellations DESC,"
  " cancellation_reason NULLS LAST) AS rank\nFROM (" + "\n UNION ALL ".join(
      f"SELECT '{dim}' AS dimension, CAST({expr} AS VARCHAR) AS value, cancellation_reason,"
      f" CAST(count(*) AS BIGINT) AS cancellations FROM combined WHERE cancelled <> 0 GROUP BY 2, 3"
      for dim, expr in CANCEL_KEYS.items()) + ") p")

STATES = """states AS (
 SELECT origin_state_name, CAST(count(*) AS BIGINT) AS departures,
  CAST(count(DISTINCT origin) AS BIGINT) AS airports, min(origin_state_population) AS population
 FROM combined WHERE origin_state_name IS NOT NULL GROUP BY origin_state_name)"""

q("state_rank_population_vs_flights", f"""
, {STATES}
SELECT *, population_rank - departures_rank AS rank_gap FROM (
 SELECT origin_state_name, population, departures,
  row_number() OVER (ORDER BY population DESC NULLS LAST, origin_state_name) AS population_rank,
  row_number() OVER (ORDER BY departures DESC, origin_state_name) AS departures_rank
 FROM states) r""")

q("state_population_flight_correlation", f"""
, {STATES},
m AS (
 SELECT count(*) AS n, sum(CAST(population AS DECIMAL(38,0))) AS sx, sum(CAST(departures AS DECIMAL(38,0))) AS sy,
  sum(CAST(population AS DECIMAL(38,0)) * CAST(population AS DECIMAL(38,0))) AS sxx,
  sum(CAST(departures AS DECIMAL(38,0)) * CAST(departures AS DECIMAL(38,0))) AS syy,
  sum(CAST(population AS DECIMAL(38,0)) * CAST(departures AS DECIMAL(38,0))) AS sxy
 FROM states WHERE population IS NOT NULL AND departures IS NOT NULL),
p AS (
 SELECT n, CAST(CAST(n AS DECIMAL(38,0)) * sxy - sx * sy AS DOUBLE) AS num,
  sqrt(CAST(CAST(n AS DECIMAL(38,0)) * sxx - sx * sx AS DOUBLE)
       * CAST(CAST(n AS DECIMAL(38,0)) * syy - sy * sy AS DOUBLE)) AS den
 FROM m)
SELECT CAST(n AS BIGINT) AS states, CASE WHEN den > 0 THEN num / den END AS pearson_population_departures
FROM p""")

q("state_flights_per_thousand", f"""
, {STATES}
SELECT origin_state_name, departures, airports, population,
 CASE WHEN population = 0 THEN NULL ELSE CAST(1000 * departures AS DOUBLE) / population END
   AS departures_per_thousand_inhabitants,
 CASE WHEN population = 0 THEN NULL ELSE CAST(1000 * airports AS DOUBLE) / population END
   AS airports_per_thousand_inhabitants
FROM states""")

q("upsert_months", """
SELECT * FROM flights
UNION ALL SELECT * REPLACE (CAST(NULL AS DATE) AS fl_date) FROM flights WHERE dep_hour IN (1, 2)""")
q("flights_typed_reordered", "SELECT * FROM flights")
q("layer_size_audit", """
SELECT CAST(count(*) AS BIGINT) AS raw_rows, CAST(40 AS BIGINT) AS raw_columns,
 CAST(count(*) AS BIGINT) AS typed_rows, CAST(40 AS BIGINT) AS typed_columns
FROM flights""")


# Lake on snapshots: rows that a load brings stand once per flight key (the greatest row), the others as they are.
FLIGHT_KEY = ["fl_date", "op_unique_carrier", "op_carrier_fl_num", "origin", "crs_dep_time"]
LOADED = "month(fl_date) = 1 OR day(fl_date) = 20 OR (day(fl_date) = 7 AND dep_hour < 6)"


def lake_views(loaded: str, select: str) -> str:
    rest = ", ".join(f'"{c}" DESC NULLS LAST' for c in COMBINED_COLS[:40] if c not in FLIGHT_KEY)
    merged = f"""merged AS (
 SELECT * FROM flights WHERE NOT ({loaded})
 UNION ALL SELECT * FROM flights WHERE {loaded}
  QUALIFY row_number() OVER (PARTITION BY {", ".join(FLIGHT_KEY)} ORDER BY {rest}) = 1
),
"""
    typed = TYPED.replace("combined AS (", merged + "combined AS (").replace("FROM flights f\n", "FROM merged f\n")
    return "WITH" + RAW + "," + typed + "\n" + select


def _select_of(name: str) -> str:
    """The final SELECT of a registered query."""
    return _Q[name].removeprefix("WITH" + RAW + "," + TYPED).strip()


_Q["lake_refresh_flights"] = lake_views(LOADED, "SELECT * FROM merged")
_Q["lake_refresh_carriers"] = lake_views(LOADED, _select_of("carrier_daily"))
_Q["lake_published_airports"] = lake_views(LOADED, _select_of("departure_airport"))
_Q["lake_published_states"] = lake_views(LOADED, _select_of("state_monthly"))
_Q["lake_stream_daily"] = lake_views("month(fl_date) = 1", "SELECT * FROM combined")
q("carrier_month_quantiles", "\nUNION ALL\n".join(
    f"SELECT CAST(date_trunc('month', fl_date) AS DATE) AS month, op_unique_carrier, '{name}' AS measure, CAST({share} AS DOUBLE) AS share,\n"
    f" quantile_cont(CAST({column} AS DOUBLE), {share}) AS value\n"
    f"FROM combined WHERE {column} IS NOT NULL GROUP BY 1, 2"
    for name, column in (("departure_delay", "dep_delay"), ("airtime", "air_time"), ("distance", "distance"))
    for share in (0.25, 0.5, 0.75)))


# Data dictionary: DuckDB type names spelled the way Spark prints them.
SPARK_TYPE = ("CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' "
              "ELSE lower(column_type) END")
_Q["dictionary_export"] = "\nUNION ALL\n".join(
    f"SELECT '{ds}' AS dataset, d.column_name AS \"column\", {SPARK_TYPE} AS data_type, c.filled_rows "
    f"FROM (DESCRIBE {_Q[key]}) d JOIN (UNPIVOT (SELECT CAST(count(COLUMNS(*)) AS BIGINT) FROM ({_Q[key]})) "
    f"ON * INTO NAME column_name VALUE filled_rows) c USING (column_name)"
    for ds, key in [("complete_data", "combined_wide"), ("operating_carrier_stats", "carrier_daily"),
                    ("departure_airport_stats", "departure_airport"), ("state_stats", "state_monthly")])


def oracle_sql() -> dict[str, str]:
    return dict(_Q)
