"""Typing and cleaning of the raw inputs (population, airports, flights)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.functions.columns import (
    census_date,
    normalise_names,
    numeric_to_bool,
    numeric_to_long,
    year_month_key,
    zero_pad,
)

PARTITION_KEY = "year_month"


def _drop_exact(df: DataFrame, name: str) -> DataFrame:
    """Drop the column spelled exactly ``name``, keeping case variants.

    ``DataFrame.drop`` matches case-insensitively and would also remove
    e.g. ``STATE`` when asked for ``state``; renaming by position first
    keeps the two apart.
    """
    tmp = "__dropped__"
    names = [tmp if c == name else c for c in df.columns]
    return df.toDF(*names).drop(tmp)


def transform_population(records: DataFrame) -> DataFrame:
    """Census records -> ``name, last_update_date, state, population``.

    Renames ``POP_2021``/``LASTUPDATE``, parses the update date, casts the
    population to bigint (bad digits raise), drops the geography column
    ``state`` (keeping ``STATE``), sorts by name and normalises names.
    """
    df = _drop_exact(records, "state")
    df = df.withColumnsRenamed({"POP_2021": "POPULATION", "LASTUPDATE": "LAST_UPDATE_DATE"})
    df = df.withColumns({
        "LAST_UPDATE_DATE": census_date("LAST_UPDATE_DATE"),
        "POPULATION": F.col("POPULATION").cast("bigint"),
    })
    return normalise_names(df.orderBy("NAME"))


def transform_airports(raw: DataFrame) -> DataFrame:
    """Drop the display name and FAA code, normalise column names."""
    return normalise_names(raw.drop("DISPLAY_AIRPORT_CITY_NAME_FULL", "FAA"))


def transform_flights(raw: DataFrame) -> DataFrame:
    """Type the raw flights.

    Dates and datetimes are parsed, flight numbers become 4-wide zero-padded
    text, cloud flags booleans, active weather bigint; ``DEST`` becomes
    ``DESTINATION`` and ``ICAO TYPE`` moves to the end as ``ICAO_TYPE``;
    then names are normalised. Columns keep their file order.
    """
    df = raw.withColumns({
        "FL_DATE": F.to_date("FL_DATE"),
        "MKT_CARRIER_FL_NUM": zero_pad("MKT_CARRIER_FL_NUM"),
        "OP_CARRIER_FL_NUM": zero_pad("OP_CARRIER_FL_NUM"),
        "DEP_TIME": F.to_timestamp_ntz("DEP_TIME"),
        "CRS_DEP_TIME": F.to_timestamp_ntz("CRS_DEP_TIME"),
        "LOW_LEVEL_CLOUD": numeric_to_bool("LOW_LEVEL_CLOUD"),
        "MID_LEVEL_CLOUD": numeric_to_bool("MID_LEVEL_CLOUD"),
        "HIGH_LEVEL_CLOUD": numeric_to_bool("HIGH_LEVEL_CLOUD"),
        "ACTIVE_WEATHER": numeric_to_long("ACTIVE_WEATHER"),
        "ICAO_TYPE": F.col("`ICAO TYPE`"),
    })
    df = df.withColumnRenamed("DEST", "DESTINATION").drop("ICAO TYPE")
    return normalise_names(df)


def with_partition_key(flights: DataFrame) -> DataFrame:
    """Append the ``year_month`` partition key (``YYYY_MM``) of ``fl_date``."""
    return flights.withColumn(PARTITION_KEY, year_month_key("fl_date"))
