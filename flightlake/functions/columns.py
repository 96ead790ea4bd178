"""Scalar column helpers.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so
it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalise_name(name: str) -> str:
    """Trim, lower-case and turn spaces into underscores."""
    return name.strip().lower().replace(" ", "_")


def normalise_names(df: DataFrame) -> DataFrame:
    """Rename every column positionally with :func:`normalise_name`.

    ``toDF`` renames by position, so names with spaces or that differ only
    by case are handled without ambiguity.
    """
    return df.toDF(*[normalise_name(c) for c in df.columns])


def zero_pad(c: str | Column, width: int = 4) -> Column:
    """Left-pad with zeros to ``width``; longer strings are kept whole.

    ``lpad`` alone would cut ``'12345'`` to ``'1234'``.
    """
    s = _col(c).cast("string")
    return F.when(F.length(s) < width, F.lpad(s, width, "0")).otherwise(s)


# The census LASTUPDATE format is "<month>. <day>, <year>",
# with the month written in full ("December") or abbreviated ("Dec").
CENSUS_DATE_PATTERNS = ("MMMM. d, yyyy", "MMM. d, yyyy")


def census_date(c: str | Column) -> Column:
    """Parse a census update date; a non-null value that fits no pattern raises."""
    src = _col(c)
    parsed = F.coalesce(*[F.try_to_date(src, p) for p in CENSUS_DATE_PATTERNS])
    return F.when(src.isNotNull() & parsed.isNull(),
                  F.raise_error(F.concat(F.lit("unparseable census date: "), src))
                  ).otherwise(parsed)


def numeric_to_bool(c: str | Column) -> Column:
    """0 -> false, any other number -> true, NULL stays NULL.

    The raw value is read as a number first: casting the string ``'0.0'``
    straight to boolean raises under ANSI.
    """
    return _col(c).cast("double").cast("boolean")


def numeric_to_long(c: str | Column) -> Column:
    """Number (possibly fractional, e.g. ``3.0``) to bigint, truncating."""
    return _col(c).cast("double").cast("bigint")


def year_month_key(date_col: str | Column) -> Column:
    """Partition key ``YYYY_MM`` of a date; NULL date gives a NULL key."""
    return F.date_format(_col(date_col), "yyyy_MM")


def first_of_month(date_col: str | Column) -> Column:
    """First day of the month, still a ``date``."""
    return F.trunc(_col(date_col), "MM")


def per_scale(count: str | Column, base: str | Column, scale: int) -> Column:
    """``scale * count / base`` as double; base 0 or NULL gives NULL.

    The product is bigint (64-bit), so it never wraps for real counts.
    """
    num = F.lit(scale).cast("bigint") * _col(count).cast("bigint")
    return F.try_divide(num.cast("double"), _col(base).cast("double"))
