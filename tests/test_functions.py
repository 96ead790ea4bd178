"""Column helpers: zero pad (T2), census dates (T3), casts, ratios (T4, T5)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

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


def test_normalise_name():
    assert normalise_name("  ICAO TYPE ") == "icao_type"
    assert normalise_name("FL_DATE") == "fl_date"


def test_normalise_names_positional(spark):
    df = spark.createDataFrame([(1, 2)], "`ICAO TYPE` int, `Dep Time` int")
    assert normalise_names(df).columns == ["icao_type", "dep_time"]


def test_zero_pad_keeps_long_values(spark):
    df = spark.createDataFrame([(7,), (1234,), (12345,), (None,)], "n bigint")
    got = [r[0] for r in df.select(zero_pad("n")).collect()]
    assert got == ["0007", "1234", "12345", None]


def test_census_date_both_spellings(spark):
    df = spark.createDataFrame([("Dec. 21, 2021",), ("December. 21, 2021",), ("Jul. 1, 2021",), (None,)], "s string")
    got = [r[0] for r in df.select(census_date("s")).collect()]
    assert got == [dt.date(2021, 12, 21), dt.date(2021, 12, 21), dt.date(2021, 7, 1), None]


def test_census_date_garbage_raises(spark):
    df = spark.createDataFrame([("21/12/2021",)], "s string")
    with pytest.raises(Exception, match="unparseable census date"):
        df.select(census_date("s")).collect()


def test_numeric_casts(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (None,), (3.0,)], "x double")
    got = df.select(numeric_to_bool("x").alias("b"), numeric_to_long("x").alias("l")).collect()
    assert [tuple(r) for r in got] == [(False, 0), (True, 1), (None, None), (True, 3)]


def test_month_helpers(spark):
    df = spark.createDataFrame([(dt.date(2022, 3, 17),), (None,)], "d date")
    got = df.select(year_month_key("d"), first_of_month("d")).collect()
    assert tuple(got[0]) == ("2022_03", dt.date(2022, 3, 1))
    assert tuple(got[1]) == (None, None)


def test_per_scale_no_wrap_and_zero(spark):
    # 5,000 * 1e6 overflows 32 bits; the result must be the true value (T4).
    df = spark.createDataFrame([(5000, 10), (3, 0), (3, None)], "c bigint, p bigint")
    got = [r[0] for r in df.select(per_scale("c", "p", 1_000_000)).collect()]
    assert got == [5e8, None, None]  # T5: divisor 0 -> NULL, no error


def test_ansi_is_on(spark):
    # Bad digits must fail loudly, as a strict cast does.
    df = spark.createDataFrame([("12x",)], "s string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(F.col("s").cast("bigint")).collect()


def test_size_shuffles_respects_user_setting(spark):
    from flightlake.session import INITIAL_PARTITIONS, size_shuffles

    prev = spark.conf.get(INITIAL_PARTITIONS, None)
    try:
        spark.conf.unset(INITIAL_PARTITIONS)
        assert size_shuffles(spark, 1024 ** 4) == 1024 ** 4 // (256 * 1024 ** 2)
        assert size_shuffles(spark, 10) is None           # already set: left alone
    finally:
        if prev is None:
            spark.conf.unset(INITIAL_PARTITIONS)
        else:
            spark.conf.set(INITIAL_PARTITIONS, prev)


def test_shuffle_partitions_follow_the_bytes_and_are_bounded():
    from flightlake.session import SHUFFLE_MAX_PARTITIONS, shuffle_partitions

    gib = 1024 ** 3
    assert shuffle_partitions(gib, 8) == 8
    assert shuffle_partitions(1024 * gib, 8) == 4096
    assert shuffle_partitions(100 * 1024 * gib, 8) == SHUFFLE_MAX_PARTITIONS
    assert shuffle_partitions(gib + 8 * 1024 * gib, 8) == SHUFFLE_MAX_PARTITIONS   # a small day into a large month


def test_sized_shuffles_is_scoped(spark):
    from flightlake.session import INITIAL_PARTITIONS, sized_shuffles

    prev = spark.conf.get(INITIAL_PARTITIONS, None)
    spark.conf.unset(INITIAL_PARTITIONS)
    try:
        with sized_shuffles(spark, 10 * 1024 ** 4) as n:
            assert spark.conf.get(INITIAL_PARTITIONS) == str(n)
        assert spark.conf.get(INITIAL_PARTITIONS, None) is None
    finally:
        if prev is not None:
            spark.conf.set(INITIAL_PARTITIONS, prev)
