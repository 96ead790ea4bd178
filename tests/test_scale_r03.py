"""Figures that grew faster than the input: what is shuffled, written and run twice."""

import glob

import pytest
from pyspark.sql import functions as F

from flightlake.operators import joins, quality
from flightlake.plans import catalog
from flightlake.sinks import clustering, row_filters
from flightlake.sinks.snapshots import Lake, Layer
from pyspark.sql import types as T

from tests.conftest import SF_SMALL


@pytest.fixture
def no_small_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan_of(df):
    return df._jdf.queryExecution().sparkPlan().toString()


def test_many_duplicate_hashes_shuffle_no_other_rows(spark, no_small_joins, monkeypatch):
    monkeypatch.setattr(quality, "BROADCAST_MAX_HASHES", 3)
    rows = spark.range(2000).select("id", F.when(F.col("id") % 7 != 0, F.col("id") % 5).alias("v"), (F.col("id") % 3).alias("g"))
    twice = rows.unionByName(rows.where("id % 10 = 0")).unionByName(rows.where("id % 20 = 0"))
    found = quality.duplicate_groups(twice, group="g")
    assert "SortMergeJoin" not in plan_of(found) and "BroadcastHashJoin" in plan_of(found)
    got = found.groupBy("copies").count().collect()
    assert {r["copies"]: r["count"] for r in got} == {2: 100, 3: 100}
    per = {r["g"]: (r["duplicate_groups"], r["surplus_rows"]) for r in quality.duplicate_summary(twice, group="g").collect()}
    assert sum(n for n, _ in per.values()) == 200 and sum(n for _, n in per.values()) == 300


def test_filter_passes_all_members_and_few_others(spark):
    hashes = spark.range(5000).select(F.xxhash64("id").alias("__h"))
    blocks = row_filters.blocks_for(5000)
    rows = spark.range(50_000).select("id", F.xxhash64("id").alias("__h"))
    passed = row_filters.passing(rows, row_filters.filter_of(hashes, blocks), blocks)
    assert passed.columns == ["id", "__h"]
    assert passed.where("id < 5000").count() == 5000 and passed.count() < 5500
    assert row_filters.blocks_for(10 ** 9) == row_filters.MOST_BLOCKS and row_filters.blocks_for(0) == 1


def test_stored_rows_are_filtered_before_the_comparison(spark, no_small_joins):
    stored = spark.range(3000).select((F.col("id") % 4).alias("k"), "id", F.when(F.col("id") % 3 != 0, F.lit("x")).alias("v"))
    load = stored.where("id % 30 = 0").unionByName(stored.where("id % 30 = 0")).unionByName(stored.where("id = 7").withColumn("v", F.lit("y")))
    found = load.select("k", F.xxhash64(*load.columns).alias("__h")).distinct()
    out = row_filters.confirmed(load, found, stored, "k", load.columns)
    assert "BroadcastHashJoin" in plan_of(out)
    assert out.count() == 100 and out.where("copies <> 2").isEmpty()


def test_hybrid_joins_at_once_equal_plain_joins(spark):
    fact = spark.range(3000).select(
        "id", F.when(F.col("id") % 11 != 0, F.col("id") % 40).alias("a"), F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("b"))
    one = spark.range(30).select(F.col("id").alias("k"), F.concat(F.lit("one"), "id").alias("name"))
    two = spark.range(2500).select(F.when(F.col("id") == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("n"))
    twice = two.unionByName(two.where("n = 5"))
    out = joins.hybrid_lookup_joins(fact, [(one, "a", "k", {"name": "a_name"}), (twice, "b", "k", {"n": "b_n"})], most=3, fraction=0.5)
    want = joins.lookup_join(joins.lookup_join(fact, one, "a", "k", {"name": "a_name"}), twice, "b", "k", {"n": "b_n"})
    assert out.columns == want.columns
    assert out.exceptAll(want).isEmpty() and want.exceptAll(out).isEmpty()


def test_many_clustered_files_from_few_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(clustering, "MOST_TASKS", 4)
    path = str(tmp_path / "many")
    df = spark.range(8000).select("id", F.expr("date_add(DATE'2022-01-01', cast(pmod(xxhash64(id, 1), 60) as int))").alias("day"),
                                  F.when(F.col("id") % 9 != 0, F.pmod(F.xxhash64("id", F.lit(2)), F.lit(50))).alias("at"))
    manifest = clustering.write_clustered(df, path, ["day", "at"], file_rows=100)
    names = {f.rsplit("/", 1)[1].split("-")[1] for f in glob.glob(f"{path}/part-*")}
    assert len(names) <= 4 and manifest.count() >= 80 and manifest.agg(F.max("rows")).first()[0] <= 100
    bounds = {"at": (7, 8)}
    got, want = clustering.read_clustered(spark, path, df.schema, bounds), df.where("at between 7 and 8")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert clustering.meeting(manifest, bounds).count() <= 0.4 * manifest.count()


def test_a_layer_is_made_once(spark, tmp_path):
    made = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def noted(x):
        made.add(1)
        return x

    layer = Layer("numbers", T.StructType([T.StructField("day", T.StringType()), T.StructField("n", T.LongType())]), "day", ("n",))
    change = Lake(spark, str(tmp_path / "lake"), [layer]).change()
    rows = spark.range(50).select((noted("id") % 5).cast("string").alias("day"), F.col("id").alias("n"))
    assert change.replace("numbers", rows).rows == 50
    change.commit()
    assert made.value == 50


@pytest.mark.parametrize("query", ["layer_size_audit", "flights_typed_reordered"])
def test_raw_text_is_compressed(spark, tmp_path, monkeypatch, query):
    monkeypatch.setattr(catalog, "scratch_path", lambda _spark, name: str(tmp_path / name))
    assert catalog.queries()[query](spark, SF_SMALL).count()
    raw = [f for f in glob.glob(f"{tmp_path}/raw-*/part-*")]
    assert raw and all(f.endswith(".csv.gz") for f in raw)
