"""Column expressions (all built-in Spark functions, no Python UDFs)."""

from flightlake.functions.columns import (
    census_date,
    first_of_month,
    normalise_name,
    normalise_names,
    numeric_to_bool,
    numeric_to_long,
    per_scale,
    year_month_key,
    zero_pad,
)

__all__ = [
    "census_date",
    "first_of_month",
    "normalise_name",
    "normalise_names",
    "numeric_to_bool",
    "numeric_to_long",
    "per_scale",
    "year_month_key",
    "zero_pad",
]
