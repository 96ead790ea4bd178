"""Typing of population (T1), airports and flights; golden schemas."""

import datetime as dt
import json
import os

from flightlake.operators.transform import (
    transform_airports,
    transform_flights,
    transform_population,
    with_partition_key,
)
from flightlake.schemas import CENSUS_HEADER, FLIGHTS, RAW_FLIGHTS
from flightlake.sources.files import read_census_json

CENSUS = ('[["NAME","LASTUPDATE","STATE","POP_2021","state"],'
          '["Ohio","Dec. 21, 2021","39","11780017","39"],'
          '["Alaska","December. 21, 2021","02","732673","02"]]')


def test_census_json_keeps_upper_state(spark, tmp_out):
    path = os.path.join(tmp_out, "census.json")
    with open(path, "w") as fh:
        fh.write(CENSUS)
    raw = read_census_json(spark, path)
    assert raw.columns == CENSUS_HEADER
    pop = transform_population(raw)
    assert pop.columns == ["name", "last_update_date", "state", "population"]
    rows = [tuple(r) for r in pop.collect()]
    # sorted by name; STATE kept although "state" was dropped (T1)
    assert rows == [("Alaska", dt.date(2021, 12, 21), "02", 732673),
                    ("Ohio", dt.date(2021, 12, 21), "39", 11780017)]
    assert dict(pop.dtypes)["population"] == "bigint"


def test_census_json_bad_header_raises(spark, tmp_out):
    path = os.path.join(tmp_out, "census.json")
    with open(path, "w") as fh:
        fh.write('[["NAME","X"],["Ohio","1"]]')
    import pytest
    with pytest.raises(Exception, match="unexpected census header"):
        read_census_json(spark, path).collect()


def test_transform_airports(spark):
    raw = spark.createDataFrame(
        [("JFK", "New York, NY", "New York", "NY", 40.6, -73.8, "JFK")],
        "AIRPORT string, DISPLAY_AIRPORT_CITY_NAME_FULL string, AIRPORT_STATE_NAME string, "
        "AIRPORT_STATE_CODE string, LATITUDE double, LONGITUDE double, FAA string")
    out = transform_airports(raw)
    assert out.columns == ["airport", "airport_state_name", "airport_state_code", "latitude", "longitude"]


def _raw_flight(**over):
    base = {f.name: None for f in RAW_FLIGHTS.fields}
    base.update({"FL_DATE": "2022-01-03", "MKT_CARRIER_FL_NUM": 7, "OP_CARRIER_FL_NUM": 12345,
                 "DEP_TIME": "2022-01-03 07:05:00", "CRS_DEP_TIME": "2022-01-03 07:00:00",
                 "LOW_LEVEL_CLOUD": 0.0, "MID_LEVEL_CLOUD": 1.0, "HIGH_LEVEL_CLOUD": None,
                 "ACTIVE_WEATHER": 3.0, "ICAO TYPE": "B738", "DEST": "LAX", "ORIGIN": "JFK"})
    base.update(over)
    return tuple(base[f.name] for f in RAW_FLIGHTS.fields)


def test_transform_flights_types_and_order(spark):
    raw = spark.createDataFrame([_raw_flight(), _raw_flight(ACTIVE_WEATHER=None)], RAW_FLIGHTS)
    out = transform_flights(raw)
    assert out.schema.simpleString() == FLIGHTS.simpleString()
    r = out.first()
    assert r["fl_date"] == dt.date(2022, 1, 3)
    assert r["mkt_carrier_fl_num"] == "0007" and r["op_carrier_fl_num"] == "12345"
    assert r["dep_time"] == dt.datetime(2022, 1, 3, 7, 5)
    assert (r["low_level_cloud"], r["mid_level_cloud"], r["high_level_cloud"]) == (False, True, None)
    assert r["active_weather"] == 3 and r["icao_type"] == "B738" and r["destination"] == "LAX"
    assert out.columns[-1] == "icao_type"


def test_golden_combined_dictionary_names():
    # Column order of the published complete-data dictionary.
    from flightlake.schemas import COMBINED
    assert len(COMBINED.fields) == 50
    assert COMBINED.fieldNames()[:3] == ["fl_date", "dep_hour", "mkt_unique_carrier"]
    assert COMBINED.fieldNames()[-4:] == ["cancellation_reason", "weather_description",
                                          "mkt_carrier_name", "op_carrier_name"]
    json.dumps(COMBINED.jsonValue())


def test_null_date_gets_null_partition(spark):
    # T9: a NULL fl_date has a NULL month key, kept as its own group.
    raw = spark.createDataFrame([_raw_flight(FL_DATE=None)], RAW_FLIGHTS)
    out = with_partition_key(transform_flights(raw))
    assert out.first()["year_month"] is None
