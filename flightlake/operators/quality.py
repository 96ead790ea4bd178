"""Fail-fast data-quality checks.

Each check is a distributed aggregate that returns a handful of metric rows
(one, or one per month for flights); only those rows reach the driver,
which raises :class:`DataQualityError` on the first violation. Order of
checks: empty -> latitude -> longitude -> duplicates -> nulls; flights are
checked month by month (earliest month first, a NULL month before all).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flightlake.operators.joins import sized_broadcast
from flightlake.sinks import row_filters

# Duplicate candidates (8-byte hashes) that may be broadcast.
BROADCAST_MAX_HASHES = 250_000
LAT_RANGE = (-90.0, 90.0)
LON_RANGE = (-180.0, 180.0)


class DataQualityError(ValueError):
    """A data-quality rule failed; ``check`` names the rule."""

    def __init__(self, check: str, detail: str):
        super().__init__(detail)
        self.check = check
        self.detail = detail


def _count_if(cond: Column) -> Column:
    return F.count_if(cond).cast("bigint")


def _outside(c: str, lo: float, hi: float) -> Column:
    # NULL is not a violation: NOT (NULL BETWEEN ..) is NULL, count_if skips it.
    return ~F.col(c).between(lo, hi)


def null_count_exprs(cols: Sequence[str]) -> list[Column]:
    return [_count_if(F.col(c).isNull()).alias(f"null_{c}") for c in cols]


def profile(df: DataFrame, null_cols: Sequence[str] = (), group: str | None = None,
            coords: bool = True) -> DataFrame:
    """Row count, coordinates out of range and per-column NULL counts.

    One aggregate job; grouped by ``group`` (NULL-safe: a NULL key is its
    own group) when given.
    """
    aggs = [F.count(F.lit(1)).alias("rows")]
    if coords:
        aggs += [_count_if(_outside("latitude", *LAT_RANGE)).alias("latitude_out_of_range"),
                 _count_if(_outside("longitude", *LON_RANGE)).alias("longitude_out_of_range")]
    aggs += null_count_exprs(null_cols)
    return df.groupBy(group).agg(*aggs) if group else df.agg(*aggs)


def duplicate_groups(df: DataFrame, cols: Sequence[str] | None = None,
                     group: str | None = None) -> DataFrame:
    """Whole-row duplicates, exact, shuffling 8-byte hashes instead of rows.

    1. hash every row to 64 bits and keep the hashes seen more than once
       (partial aggregation collapses even a hot hash map-side); their
       number is counted eagerly, and a clean table stops here;
    2. otherwise only the rows that may have such a hash are shuffled: full
       rows are grouped to confirm (hash collisions of distinct rows, and
       rows that came along, drop out here). Few hashes are broadcast for
       that; of more, a Bloom filter of bounded size is.
    ``df`` is read up to three times: give it as a stored table.
    Returns one row per duplicated row value: ``group`` key (if any),
    the row hash and ``copies`` (>= 2).
    """
    cols = list(cols or [c for c in df.columns if c != group])
    keyed = df.withColumn("__h", F.xxhash64(*cols))
    by = ([group] if group else []) + ["__h"]
    out_cols = by + ["copies"]
    # Candidates by hash alone: for mostly unique rows this shuffle carries
    # one (8-byte hash, count) pair per row and nothing else. The group is
    # restored in the confirmation below, which is exact.
    cand = keyed.groupBy("__h").count().where("count > 1").select("__h")
    n_cand = cand.count()
    if n_cand == 0:
        return keyed.select(*by, F.lit(0).cast("bigint").alias("copies")).limit(0)
    if n_cand <= BROADCAST_MAX_HASHES:
        hits = keyed.join(sized_broadcast(cand, known_small=True), "__h", "left_semi")
    else:
        blocks = row_filters.blocks_for(n_cand)
        hits = row_filters.passing(keyed, row_filters.filter_of(cand, blocks), blocks)
    full = by + [c for c in cols if c != group]
    return (hits.groupBy(*full).agg(F.count(F.lit(1)).alias("copies"))
            .where("copies > 1").select(*out_cols))


def duplicate_summary(df: DataFrame, cols: Sequence[str] | None = None,
                      group: str | None = None) -> DataFrame:
    """Per ``group``: number of duplicated row values and of surplus copies."""
    d = duplicate_groups(df, cols, group)
    aggs = [F.count(F.lit(1)).alias("duplicate_groups"),
            F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint").alias("surplus_rows")]
    return d.groupBy(group).agg(*aggs) if group else d.agg(*aggs)


def null_profile_long(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """NULL count per column as rows ``(column, null_count)``."""
    cols = list(cols or df.columns)
    wide = df.agg(*[_count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "null_count")


# ---------------------------------------------------------------- checks

def _first_failure(m: dict, null_cols: Sequence[str], dup: int, where: str) -> tuple[str, str] | None:
    if m["rows"] == 0:
        return "empty", f"no rows to check{where}"
    if m.get("latitude_out_of_range"):
        return "latitude", f"latitude rule (-90 to 90): {m['latitude_out_of_range']:,} rows break it{where}"
    if m.get("longitude_out_of_range"):
        return "longitude", f"longitude rule (-180 to 180): {m['longitude_out_of_range']:,} rows break it{where}"
    if dup:
        return "duplicates", f"uniqueness rule: {dup:,} surplus copies of rows{where}"
    nulls = {c: m[f"null_{c}"] for c in null_cols if m[f"null_{c}"]}
    if nulls:
        listed = ", ".join(f"{c}={n:,}" for c, n in nulls.items())
        return "nulls", f"required columns with NULLs{where}: {listed}"
    return None


def check_airports(airports: DataFrame) -> DataFrame:
    """Non-empty, coordinates in range, no duplicate rows, no NULL anywhere."""
    cols = airports.columns
    m = profile(airports, cols).first().asDict()
    early = _first_failure(m, [], 0, "")
    if early:
        raise DataQualityError(*early)
    dup = duplicate_summary(airports).first()["surplus_rows"] or 0
    fail = _first_failure(m, cols, dup, "")
    if fail:
        raise DataQualityError(*fail)
    return airports


def check_population(population: DataFrame) -> DataFrame:
    """No negative population."""
    if not population.where(F.col("population") < 0).isEmpty():
        raise DataQualityError("negative_population", "population rule (0 or more): some rows are below 0")
    return population


def flight_metrics(flights: DataFrame, key: str, required: Sequence[str]) -> DataFrame:
    """Per-month metrics for the flight checks, duplicates included."""
    prof = profile(flights, required, group=key)
    # Rename the right key: both sides come from the same input, so column
    # references by DataFrame would be ambiguous after the join.
    dup = duplicate_summary(flights, group=key).withColumnRenamed(key, "__dk")
    return (prof.join(dup, prof[key].eqNullSafe(F.col("__dk")), "left").drop("__dk")
            .withColumn("surplus_rows", F.coalesce("surplus_rows", F.lit(0).cast("bigint")))
            .withColumn("duplicate_groups", F.coalesce("duplicate_groups", F.lit(0).cast("bigint"))))


def check_flights(flights: DataFrame, key: str = "year_month",
                  required: Sequence[str] | None = None) -> DataFrame:
    """Generic checks and NULL checks of the key columns, per month.

    Raises for the earliest failing month with its first failing check; an
    input with no rows at all is an error too.
    """
    from flightlake.schemas import FLIGHT_REQUIRED

    required = list(required or FLIGHT_REQUIRED)
    rows = flight_metrics(flights, key, required).orderBy(F.asc_nulls_first(key)).collect()
    if not rows:
        raise DataQualityError("empty", "no rows to check: no month partitions")
    for r in rows:
        m = r.asDict()
        fail = _first_failure(m, required, m["surplus_rows"], f" in {m[key]} partition")
        if fail:
            raise DataQualityError(*fail)
    return flights
