"""Shared building blocks of the registered queries over the driver tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from flightlake.operators.enrich import Lookups, combine
from flightlake.operators.transform import (
    transform_airports,
    transform_flights,
    transform_population,
)
from flightlake.session import freed_shuffles, scratch_path
from flightlake.sources import fixtures


@dataclass
class Typed:
    flights: DataFrame
    lookups: Lookups


def typed(spark: SparkSession, sf_dir: str) -> Typed:
    raw = fixtures.raw_inputs(spark, sf_dir)
    return Typed(
        flights=transform_flights(raw.flights),
        lookups=Lookups(
            airports=transform_airports(raw.airports),
            population=transform_population(raw.population),
            cancellation_codes=raw.cancellation_codes,
            weather_codes=raw.weather_codes,
            carriers=raw.carriers,
        ),
    )


def stored(spark: SparkSession, rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written once to a scratch folder and read back, for queries that go through them several times."""
    path = scratch_path(spark, name)
    with freed_shuffles(spark):
        rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = typed(spark, sf_dir)
    return combine(t.flights, t.lookups)
