"""Disk that a step holds: shuffles end with it, wide rows are shuffled in waves, raw text is compressed."""

import glob
import os
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flightlake.plans import catalog, flows, lake
from flightlake.sinks import clustering, upsert, writers
from flightlake.sinks.snapshots import Change, Lake, Layer
from flightlake.sources.files import read_layer

from tests.conftest import SF_SMALL


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def freed(spark, before):
    """No shuffle file since ``before`` is left; they are deleted in the background."""
    until = time.time() + 10
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    return not shuffle_files(spark) - before


def writes(pattern):
    """Number of writes that files come from."""
    return len({os.path.basename(f)[11:47] for f in glob.glob(pattern)})


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.fixture
def small_waves(monkeypatch):
    monkeypatch.setattr(writers, "WAVE_ROWS", 100)
    monkeypatch.setattr(writers, "WAVE_BYTES", 0)


@pytest.fixture(scope="module")
def flights(spark):
    return flows.stored(spark, flows.typed(spark, SF_SMALL).flights.where("fl_date < '1995-04-01'"), "some-flights")


def test_stored_rows_leave_no_shuffle_files(spark):
    before = shuffle_files(spark)
    rows = flows.stored(spark, spark.range(50_000).repartition(3, "id"), "numbers")
    assert freed(spark, before)
    assert rows.count() == 50_000


def test_month_waves_are_whole_and_small(spark, small_waves):
    rows = spark.range(1000).select("id", F.when(F.col("id") < 150, F.lit(None)).when(F.col("id") < 600, "hot").otherwise(F.concat(F.lit("m"), F.col("id") % 12)).alias("k"))
    pieces = writers.month_waves(rows, "k")
    sizes = [p.count() for p in pieces]
    assert sum(sizes) == 1000 and len(sizes) >= 10 and max(sizes) <= 130
    all_ids = [r.id for p in pieces for r in p.collect()]
    assert sorted(all_ids) == list(range(1000))
    assert len(writers.month_waves(rows.limit(90), "k")) == 1


def test_partitioned_write_in_waves(spark, flights, small_waves, tmp_path):
    keyed = lake.with_partition_key(flights.unionByName(flights.where("dep_hour = 3").withColumn("fl_date", F.lit(None).cast("date"))))
    n, before = keyed.count(), shuffle_files(spark)
    for _ in range(2):   # the second replaces the first
        assert writers.write_partitioned(keyed, str(tmp_path / "t")) == n
    assert freed(spark, before)
    assert same(read_layer(spark, str(tmp_path / "t"), flights.schema).select(*keyed.columns), keyed)
    assert writes(f"{tmp_path}/t/*/part-*") > 1


@pytest.mark.parametrize("stored", [True, False])
def test_upsert_in_waves(spark, flights, small_waves, tmp_path, monkeypatch, stored):
    undated = flights.where("dep_hour = 2").withColumn("fl_date", F.lit(None).cast("date"))
    old = flights.withColumn("dep_delay", F.lit(-1).cast("bigint"))
    load = (upsert.with_load_order(old.withColumn("landed", F.lit(1)), "landed")
            .unionByName(upsert.with_load_order(flights.unionByName(undated).withColumn("landed", F.lit(2)), "landed")).drop("landed"))
    load = flows.stored(spark, load, "load")
    schema = flights.schema
    upsert.initial_load(old, str(tmp_path / "waves"), stored=stored)
    upsert.upsert_months(spark, str(tmp_path / "waves"), load, stored=stored)
    monkeypatch.undo()
    upsert.initial_load(old, str(tmp_path / "one"))
    upsert.upsert_months(spark, str(tmp_path / "one"), load)
    assert same(read_layer(spark, str(tmp_path / "waves"), schema), read_layer(spark, str(tmp_path / "one"), schema))


def test_curve_in_pieces(spark, small_waves, tmp_path):
    df = flows.stored(spark, spark.range(900).select("id", F.expr("date_add(DATE'2022-01-01', cast(pmod(xxhash64(id, 1), 60) as int))").alias("day"),
                      F.when(F.col("id") % 9 != 0, F.pmod(F.xxhash64("id", F.lit(2)), F.lit(50))).alias("at")), "curve-rows")
    before = shuffle_files(spark)
    manifest = clustering.write_clustered(df, str(tmp_path / "c"), ["day", "at"], file_rows=30)
    assert freed(spark, before)
    assert writes(f"{tmp_path}/c/part-*") == 9
    assert manifest.agg(F.sum("rows")).first()[0] == 900 and manifest.agg(F.max("rows")).first()[0] <= 90
    assert same(clustering.read_clustered(spark, str(tmp_path / "c"), df.schema, {"at": (7, 8)}), df.where("at between 7 and 8"))
    one = spark.range(500).select(F.lit(1).alias("day"), F.lit("x").alias("at"))   # a single value
    clustering.write_clustered(one, str(tmp_path / "one"), ["day"], file_rows=50)
    assert clustering.read_clustered(spark, str(tmp_path / "one"), one.schema, {"day": (1, 1)}).count() == 500


def test_layer_is_written_in_waves(spark, small_waves, tmp_path, monkeypatch):
    layer = Layer("numbers", T.StructType([T.StructField("day", T.StringType()), T.StructField("n", T.LongType())]), "day", ("n",))
    store = Lake(spark, str(tmp_path / "lake"), [layer], 20)
    dealt, real = [], Change._dealt
    monkeypatch.setattr(Change, "_dealt", lambda self, *a: dealt.append(real(self, *a)) or dealt[-1])
    rows = spark.range(900).select(F.when(F.col("id") % 3 != 0, (F.col("id") % 40).cast("string")).alias("day"), F.col("id").alias("n"))
    before = shuffle_files(spark)
    change = store.change()
    assert change.replace("numbers", rows).rows == 900 and len(dealt[0]) >= 8
    change.commit()
    assert freed(spark, before)
    assert same(store.read("numbers"), rows)
    assert store.files("numbers").agg(F.max("rows")).first()[0] <= 40
    hot = spark.range(300).select(F.lit("7").alias("day"), F.lit(5).cast("long").alias("n"))   # all in one file, the other waves are empty
    change = store.change()
    assert change.replace("numbers", hot, ["7"]).rows == 300
    change.commit()
    assert same(store.read("numbers"), rows.where("day is null or day <> '7'").unionByName(hot))


def test_a_build_shuffles_no_combined_rows(spark, flights, small_waves, tmp_path, monkeypatch):
    dealt, real = [], Change._dealt
    monkeypatch.setattr(Change, "_dealt", lambda self, layer, *a: dealt.append(layer.name) or real(self, layer, *a))
    raw, root = str(tmp_path / "raw"), str(tmp_path / "lake")
    catalog.land_raw_inputs(spark, SF_SMALL, raw, flights=False)
    lake.build(spark, raw, root, catalog._landed(flights, 1), 40)
    assert "flights" in dealt and "combined" not in dealt
    opened = lake.open_lake(spark, root)
    ranges = {name: sorted(map(tuple, opened.files(name).select("low", "high", "rows").collect())) for name in ("flights", "combined")}
    assert ranges["flights"] == ranges["combined"] and len(ranges["flights"]) > 3
    assert opened.read("combined").count() == flights.count()


@pytest.mark.parametrize("query", ["lake_stream_daily", "incremental_refresh"])
def test_landed_text_is_compressed(spark, tmp_path, monkeypatch, query):
    monkeypatch.setattr(catalog, "scratch_path", lambda _spark, name: str(tmp_path / name))
    assert catalog.queries()[query](spark, SF_SMALL).count()
    raw = [f for d in ("raw/flights", "landing/*", "daily") for f in glob.glob(f"{tmp_path}/{d}/part-*")]
    assert len(raw) >= 2 and all(f.endswith(".csv.gz") for f in raw)


def test_upsert_query_makes_flights_once(spark, tmp_path, monkeypatch):
    made, real = [], flows.stored
    monkeypatch.setattr(flows, "stored", lambda s, rows, name: made.append(name) or real(s, rows, name))
    assert catalog.queries()["upsert_months"](spark, SF_SMALL).count()
    assert made == ["flights"]
