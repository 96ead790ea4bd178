"""Denormalise typed flights with airport, population, code and carrier lookups."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flightlake.operators.joins import assert_same_count, comparable, fits, hybrid_lookup_joins, lookup_join
from flightlake.schemas import ENRICHMENT


LOOKUP_NAMES = ("airports", "population", "cancellation_codes", "weather_codes", "carriers")


@dataclass
class Lookups:
    airports: DataFrame
    population: DataFrame
    cancellation_codes: DataFrame
    weather_codes: DataFrame
    carriers: DataFrame
    _small: dict | None = None

    def small(self) -> dict[str, bool]:
        """Per lookup: are its files small enough to broadcast it? (cached, no job)"""
        if self._small is None:
            self._small = {n: fits(getattr(self, n)) for n in LOOKUP_NAMES}
        return self._small

    def all_broadcast(self) -> bool:
        """True when every lookup join is map-side, so the fact keeps its
        partitioning (no shuffle anywhere in :func:`combine`)."""
        if "airport_states" not in self.small():
            self._small["airport_states"] = fits(airport_states(self))
        return all(self.small().values())


def airport_states(lk: Lookups) -> DataFrame:
    """Airport -> state name, code and population (lookup joined to lookup).

    Joining population to the airports once, instead of to every flight
    twice, gives the same rows: an airport without a state or a state
    without population yields NULLs, and a repeated state name fans out
    here exactly as it would on the flights (the guard still sees it).
    """
    return lookup_join(lk.airports.select("airport", "airport_state_name", "airport_state_code"),
                       lk.population, "airport_state_name", "name",
                       {"population": "airport_state_population"},
                       known_small=lk.small()["population"])


def combine(flights: DataFrame, lk: Lookups, stored: bool = False) -> DataFrame:
    """Enrich flights with states, populations, code texts and carrier names.

    Six left lookup joins (origin/destination airport-state, cancellation,
    weather, marketing/operating carrier); every lookup is size-checked and
    broadcast, so the fact table is never shuffled while they fit. Beyond
    the bound a lookup goes through a hybrid join: the rows of frequent keys by
    broadcast, the others by shuffle. ``stored``: flights are files, cheap to read
    again, so that only rows with some infrequent key are shuffled. Flight columns keep
    their order, followed by the ten enrichment columns.
    """
    small = lk.small()
    states = airport_states(lk)
    if "airport_states" not in small:
        small["airport_states"] = fits(states)   # the joined side is what is broadcast
    states_small = small["airport_states"]
    cols = {"airport_state_name": "_state_name", "airport_state_code": "_state_code",
            "airport_state_population": "_state_population"}
    joins = [
        (states, "origin", "airport", {k: "origin" + v for k, v in cols.items()}, states_small),
        (states, "destination", "airport", {k: "destination" + v for k, v in cols.items()}, states_small),
        (lk.cancellation_codes, "cancelled", "STATUS", {"CANCELLATION_REASON": "cancellation_reason"}, small["cancellation_codes"]),
        (lk.weather_codes, "active_weather", "STATUS", {"WEATHER_DESCRIPTION": "weather_description"}, small["weather_codes"]),
        (lk.carriers, "mkt_unique_carrier", "CODE", {"DESCRIPTION": "mkt_carrier_name"}, small["carriers"]),
        (lk.carriers, "op_unique_carrier", "CODE", {"DESCRIPTION": "op_carrier_name"}, small["carriers"]),
    ]
    beyond = [j for j in joins if stored and not j[4] and comparable(flights, j[1], j[0], j[2])]
    df = hybrid_lookup_joins(flights, [j[:4] for j in beyond]) if beyond else flights
    for lookup, left_on, right_on, columns, known_small in joins:
        if not any(left_on == j[1] for j in beyond):
            df = lookup_join(df, lookup, left_on, right_on, columns, known_small=known_small, keys_from=flights)
    return df.select(*flights.columns, *ENRICHMENT.fieldNames())


def guarded_counts(flights: DataFrame, combined: DataFrame) -> DataFrame:
    """One row: rows before and after enrichment, and whether they agree.

    Both counts come from one job over a union of the two (column-pruned)
    inputs, so no join is needed to put them side by side.
    """
    one, zero = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    marks = (flights.select(one.alias("b"), zero.alias("a"))
             .unionByName(combined.select(zero.alias("b"), one.alias("a"))))
    return (marks.agg(F.coalesce(F.sum("b"), zero).alias("rows_before"),
                      F.coalesce(F.sum("a"), zero).alias("rows_after"))
            .withColumn("counts_match", F.col("rows_before") == F.col("rows_after")))


def check_cardinality(flights: DataFrame, combined: DataFrame) -> None:
    """Raise when enrichment changed the number of rows (a lookup fanned out)."""
    row = guarded_counts(flights, combined).first()
    assert_same_count(row["rows_before"], row["rows_after"], "join")
