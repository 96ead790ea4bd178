"""Answers to the analytic questions the outputs exist for.

Top-N lists keep their limit (it is the report); every ranking has a full
tie-break so results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flightlake.functions.columns import first_of_month, per_scale

# Defaults that are ours (the questions name none).
ON_TIME_THRESHOLD_MINUTES = 15
NOT_CANCELLED_CODE = 0
TOP_N = 10
BUSIEST_PER_MONTH = 3


def most_delayed(combined: DataFrame, by: str, n: int = TOP_N) -> DataFrame:
    """Carriers or airports ranked by total minutes of (positive) delay."""
    delay = F.col("dep_delay")
    out = combined.groupBy(by).agg(
        F.count(F.lit(1)).alias("flights"),
        F.count_if(delay > 0).cast("bigint").alias("delayed_flights"),
        F.coalesce(F.sum(F.when(delay > 0, delay)), F.lit(0)).cast("bigint").alias("total_delay_minutes"),
    )
    return out.orderBy(F.desc("total_delay_minutes"), F.desc("delayed_flights"), F.asc(by)).limit(n)


def on_time_performance(combined: DataFrame, threshold: int = ON_TIME_THRESHOLD_MINUTES) -> DataFrame:
    """Share of flights departing within ``threshold`` minutes, per operating
    carrier, over flights that have a delay value; flights without one are
    reported separately."""
    delay = F.col("dep_delay")
    out = combined.groupBy("op_unique_carrier").agg(
        F.count(delay).alias("flights_with_delay"),
        F.count_if(delay.isNull()).cast("bigint").alias("flights_without_delay"),
        F.count_if(delay <= threshold).cast("bigint").alias("on_time_flights"),
    )
    return out.withColumn("on_time_ratio",
                          F.try_divide(F.col("on_time_flights").cast("double"),
                                       F.col("flights_with_delay").cast("double")))


def busiest_airports(combined: DataFrame, n: int = BUSIEST_PER_MONTH) -> DataFrame:
    """Top ``n`` departure airports per month by departures."""
    per = (combined.withColumn("month", first_of_month("fl_date"))
           .groupBy("month", "origin").agg(F.count(F.lit(1)).alias("departures")))
    w = Window.partitionBy("month").orderBy(F.desc("departures"), F.asc("origin"))
    # Filter directly on row_number so the planner can cut each month's
    # window to its top n rows before the sort.
    top = per.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)
    return top.withColumn("rank", F.col("rank").cast("bigint"))


def cancellation_dimensions() -> dict:
    """Name -> key expression of the cancellation groupings."""
    return {
        "month": first_of_month("fl_date"),
        "airport": F.col("origin"),
        "airline": F.col("op_unique_carrier"),
    }


def cancellation_reasons(combined: DataFrame, dimension: str,
                         not_cancelled: int = NOT_CANCELLED_CODE) -> DataFrame:
    """Cancellations per (dimension value, reason), ranked within the value."""
    key = cancellation_dimensions()[dimension]
    per = (combined.where(F.col("cancelled") != not_cancelled)
           .groupBy(key.alias(dimension), "cancellation_reason")
           .agg(F.count(F.lit(1)).alias("cancellations")))
    w = Window.partitionBy(dimension).orderBy(F.desc("cancellations"),
                                              F.asc_nulls_last("cancellation_reason"))
    return per.withColumn("rank", F.row_number().over(w).cast("bigint"))


def cancellation_reasons_all(combined: DataFrame,
                             not_cancelled: int = NOT_CANCELLED_CODE) -> DataFrame:
    """All three groupings in one pass with GROUPING SETS.

    ``dimension`` names the grouping, ``value`` holds its key as text.
    """
    dims = cancellation_dimensions()
    names = list(dims)
    # Pre-aggregate to (month, airport, airline, reason) so the grouping-sets
    # expansion runs over that small set, not over every cancelled flight.
    base = (combined.where(F.col("cancelled") != not_cancelled)
            .groupBy(*[c.alias(n) for n, c in dims.items()], "cancellation_reason")
            .agg(F.count(F.lit(1)).alias("n")))
    sets = [[F.col(d), F.col("cancellation_reason")] for d in names]
    g = base.groupingSets(sets, *[F.col(d) for d in names], "cancellation_reason").agg(
        F.sum("n").cast("bigint").alias("cancellations"),
        F.grouping_id(*[F.col(d) for d in names], F.col("cancellation_reason")).alias("gid"))
    # grouping_id has one bit per grouping column (dimensions, then the
    # reason), set when the column is aggregated away.
    dim = F.lit(None).cast("string")
    val = F.lit(None).cast("string")
    full = ((1 << len(names)) - 1) << 1
    for i, d in enumerate(names):
        gid = full ^ (1 << (len(names) - i))
        dim = F.when(F.col("gid") == gid, F.lit(d)).otherwise(dim)
        val = F.when(F.col("gid") == gid, F.col(d).cast("string")).otherwise(val)
    long = g.select(dim.alias("dimension"), val.alias("value"), "cancellation_reason", "cancellations")
    w = Window.partitionBy("dimension", "value").orderBy(F.desc("cancellations"),
                                                         F.asc_nulls_last("cancellation_reason"))
    return long.withColumn("rank", F.row_number().over(w).cast("bigint"))


def state_departures(combined: DataFrame) -> DataFrame:
    """Departures, distinct airports and population per origin state."""
    return (combined.where(F.col("origin_state_name").isNotNull())
            .groupBy("origin_state_name")
            .agg(F.count(F.lit(1)).alias("departures"),
                 F.count_distinct("origin").alias("airports"),
                 F.min("origin_state_population").alias("population")))


def population_vs_flights(combined: DataFrame) -> DataFrame:
    """Rank of each state by population and by departures.

    The ranking window spans all states; it runs after aggregation, so it
    sees one row per state, never flight rows.
    """
    s = state_departures(combined)
    by_pop = Window.orderBy(F.desc_nulls_last("population"), F.asc("origin_state_name"))
    by_dep = Window.orderBy(F.desc("departures"), F.asc("origin_state_name"))
    return (s.withColumn("population_rank", F.row_number().over(by_pop).cast("bigint"))
             .withColumn("departures_rank", F.row_number().over(by_dep).cast("bigint"))
             .withColumn("rank_gap", F.col("population_rank") - F.col("departures_rank"))
             .select("origin_state_name", "population", "departures",
                     "population_rank", "departures_rank", "rank_gap"))


def exact_pearson(df: DataFrame, x: str, y: str, name: str) -> DataFrame:
    """Pearson correlation from exact integer moments (one row).

    ``n``, the sums, sums of squares and the cross sum are aggregated as
    DECIMAL(38,0), so they are exact and independent of partitioning; one
    fixed double expression then forms
    ``(n*Sxy - Sx*Sy) / sqrt((n*Sxx - Sx^2) * (n*Syy - Sy^2))``.
    The result is reproducible run to run (``corr`` merges floating moments
    in task order). NULL when either variable is constant.
    """
    d = "decimal(38,0)"
    xv, yv = F.col(x).cast(d), F.col(y).cast(d)
    m = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.sum(xv).alias("sx"), F.sum(yv).alias("sy"),
        F.sum(xv * xv).alias("sxx"), F.sum(yv * yv).alias("syy"), F.sum(xv * yv).alias("sxy"))
    n = F.col("n").cast(d)
    num = (n * F.col("sxy") - F.col("sx") * F.col("sy")).cast("double")
    den = F.sqrt((n * F.col("sxx") - F.col("sx") * F.col("sx")).cast("double")
                 * (n * F.col("syy") - F.col("sy") * F.col("sy")).cast("double"))
    r = F.when(den > 0, num / den)
    return m.select(F.col("n").alias("states"), r.alias(name))


def population_flight_correlation(combined: DataFrame) -> DataFrame:
    """Pearson correlation of state population and departures (one row)."""
    return exact_pearson(state_departures(combined), "population", "departures",
                         "pearson_population_departures")


def flights_per_inhabitants(combined: DataFrame, scale: int = 1_000) -> DataFrame:
    """Departures and airports per ``scale`` inhabitants for each state."""
    s = state_departures(combined)
    suffix = {1_000: "thousand", 1_000_000: "million"}.get(scale, str(scale))
    return s.withColumns({
        f"departures_per_{suffix}_inhabitants": per_scale("departures", "population", scale),
        f"airports_per_{suffix}_inhabitants": per_scale("airports", "population", scale),
    })
