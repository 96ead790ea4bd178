"""Hot keys: one group holding a third of all rows stays exact and spread."""

import datetime as dt

from pyspark.sql import functions as F

from flightlake.operators import joins, marts
from tests.reference import carrier_daily_direct
from flightlake.operators.quality import duplicate_summary
from flightlake.operators.stats import histogram

SCHEMA = ("fl_date date, op_unique_carrier string, dep_delay bigint, air_time bigint, "
          "distance bigint, origin string, destination string")


def skewed(spark, n=9000):
    d0 = dt.date(2022, 1, 1)
    rows = []
    for i in range(n):
        hot = i % 3 == 0                                   # a third of all rows
        rows.append((d0 if hot else d0 + dt.timedelta(days=i % 40),
                     "HOT" if hot else f"C{i % 17}",
                     None if i % 11 == 0 else (i * 7) % 181 - 30,
                     (i * 13) % 400, (i * 5) % 2500, f"A{i % 9}", f"A{(i + 1) % 9}"))
    return spark.createDataFrame(rows, SCHEMA).repartition(8)


def test_hot_group_medians_exact(spark):
    df = skewed(spark)
    a = marts.carrier_daily(df, sort=False)
    b = carrier_daily_direct(df).select(*a.columns)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    hot = a.where(F.col("op_unique_carrier") == "HOT").first()
    assert hot is not None and hot["total_distance"] == sum((i * 5) % 2500 for i in range(0, 9000, 3))


def test_hot_group_histogram_is_spread(spark):
    prev = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        h = histogram(skewed(spark), ["fl_date", "op_unique_carrier"], marts.CARRIER_MEASURES)
        parts = (h.where(F.col("op_unique_carrier") == "HOT")
                 .select(F.spark_partition_id().alias("p")).distinct().count())
        assert parts > 1                                   # not funnelled into one reducer
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", prev)


def test_hot_copy_group_duplicates(spark):
    base = skewed(spark, 3000)
    hot_row = base.orderBy(*base.columns).limit(1)         # deterministic choice
    copies = (hot_row.select("*", F.explode(F.sequence(F.lit(1), F.lit(1024))).alias("k"))
              .drop("k"))                                  # 1024 copies of one row
    df = base.unionByName(copies)
    r = duplicate_summary(df).first()
    expected_extra = base.groupBy(*base.columns).count().where("count > 1").agg(
        F.coalesce(F.sum(F.col("count") - 1), F.lit(0))).first()[0]
    assert r["surplus_rows"] == 1024 + expected_extra


def lookup_case(spark):
    """Half of the rows hold one key, a tenth none; keys that the lookup lacks, repeats, or holds as NULL."""
    fact = spark.range(40_000).select("id", F.when(F.col("id") % 2 == 0, "HOT").when(F.col("id") % 10 == 1, None)
                                      .when(F.col("id") % 10 == 3, "LOST").when(F.col("id") % 50 == 5, "TWICE")
                                      .otherwise(F.concat(F.lit("k"), F.col("id") % 3000)).alias("k"))
    rows = [("HOT", "hot"), ("TWICE", "a"), ("TWICE", "b"), (None, "none"), *[(f"k{i}", f"n{i}") for i in range(0, 3000, 3)]]
    return fact, spark.createDataFrame(rows, "code string, name string")


def test_hybrid_join_equals_plain_join(spark):
    fact, lookup = lookup_case(spark)
    plain = joins.lookup_join(fact, lookup, "k", "code", {"name": "name"}, known_small=True)
    for most, fraction in ((4096, 1.0), (2, 1.0), (4096, 0.01), (1, 1e-9)):  # the last: no frequent key known
        a = joins.hybrid_lookup_join(fact, lookup, "k", "code", {"name": "name"}, most=most, fraction=fraction)
        assert a.columns == plain.columns
        assert a.exceptAll(plain).isEmpty() and plain.exceptAll(a).isEmpty()
    empty = joins.hybrid_lookup_join(fact.limit(0), lookup.limit(0), "k", "code", {"name": "name"})
    assert empty.isEmpty()


def test_hybrid_join_has_no_hot_task(spark):
    fact, lookup = lookup_case(spark)
    held = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        def most(df):
            sizes = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
            return max(sizes) / (sum(sizes) / 8)
        plain = joins.lookup_join(fact, lookup, "k", "code", {"name": "name"}, known_small=False)
        hybrid = joins.hybrid_lookup_join(fact, lookup, "k", "code", {"name": "name"}, fraction=0.1)
        assert most(plain) > 4          # half of the rows in one of eight tasks
        assert most(hybrid) < 2
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)


def test_hybrid_join_only_beyond_the_bound(spark):
    fact, lookup = lookup_case(spark)
    near = joins.lookup_join(fact, lookup, "k", "code", {"name": "name"}, known_small=True, keys_from=fact)
    far = joins.lookup_join(fact, lookup, "k", "code", {"name": "name"}, known_small=False, keys_from=fact)
    assert "spread" not in near._jdf.queryExecution().toString()
    assert "spread" in far._jdf.queryExecution().toString()
    assert near.exceptAll(far).isEmpty() and far.exceptAll(near).isEmpty()
