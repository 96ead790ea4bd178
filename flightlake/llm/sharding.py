"""Size-balanced shards by sampled splitters.

Rows are ordered by the key ``(crc32 of the text, id, size)``, so equal texts stand together. A
size-weighted sample of keys gives quantile boundaries; records are range-partitioned by them, and
ranges that hold far more rows than the mean (short texts, empty ones) are subdivided at the quantiles of a sample
that weighs rows alike. Range totals (a table as long as the number of ranges) give each range its offset; a window inside the range gives each record its
position, and ``position * shards / total`` its shard. The samples only decide how the work is
dealt out, and may cut a group of equal texts anywhere: positions are exact, and start and size of the groups at the edges of ranges are added up
over all ranges, so the result does not depend on them.

Equal texts share a shard as long as their group is no larger than the largest record or 0.2 % of a
shard; larger groups are cut by position, otherwise sizes could not be near equal.

Defined results: a null text has size 1 and crc 0; null ids come first within equal texts; repeated
rows take consecutive places; an empty table gives an empty result; other columns are ignored. One
record larger than a shard makes that shard larger (a record is never split).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import columns, written

#: Rows aimed at per range, and the least number of ranges.
RANGE_ROWS = 250_000
LEAST_RANGES = 64
#: Sampled keys per range.
SAMPLES = 32
#: Ranges with more than so many times the mean rows are subdivided.
OVERFULL = 2
#: Bits of a key behind the crc, and at most so many of them for telling repeated rows apart.
PLACE_BITS = 31
SALT_BITS = 8
#: A group of equal texts up to shard size / GROUP_PART stays together.
GROUP_PART = 500
LAW = "bytes"


def _position(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at most ``key``: first among every k-th, then among k."""
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    coarse = F.array(*[F.lit(b) for b in bounds[::step]])
    fine = F.array(*[F.array(*[F.lit(b) for b in bounds[i: i + step]]) for i in range(0, len(bounds), step)])
    block = F.size(F.filter(coarse, lambda b: b <= key))
    inner = F.when(block > 0, F.size(F.filter(F.get(fine, block - 1), lambda b: b <= key))).otherwise(0)
    return F.when(block > 0, (block - 1) * step + inner).otherwise(0)


def shard_by_size(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row of ``docs``."""
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    rows = columns(docs, F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                   F.crc32(text).alias("text_crc32"), F.monotonically_increasing_id().alias("salt"))
    rows = written(spark, rows, "records")
    total, count, largest, low, high = rows.agg(
        F.sum("size"), F.count("*"), F.max("size"), F.min("doc_id"), F.max("doc_id")).first()
    total, largest, low, high = total or 0, largest or 0, low or 0, high or 0
    rows = rows.withColumn("key", _key(low, high))

    ranges = max(LEAST_RANGES, -(-count // RANGE_ROWS))
    rows = rows.withColumn("range", _position(F.col("key"), _splitters(rows, ranges, total, F.col("size"))))
    rows = _subdivided(rows, _splitters(rows, ranges, count, F.lit(1)), count / ranges)

    sums = rows.groupBy("range", "part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"),
                                             F.min("text_crc32").alias("first_crc"), F.max("text_crc32").alias("last_crc"))
    before = Window.orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("range", "part", "first_crc", "last_crc", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("bytes_before"),
                          F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"))
    # one row per range: as many as `ranges` and their subdivisions, a few thousand per 10**9 records
    rows = rows.join(F.broadcast(offsets), ["range", "part"])

    ordered = Window.partitionBy("range", "part").orderBy("text_crc32", "doc_id", "size", "key")
    running = ordered.rowsBetween(Window.unboundedPreceding, -1)
    group = Window.partitionBy("range", "part", "text_crc32")
    rows = rows.select("doc_id", "size", "text_crc32", "range", "part", F.col("text_crc32").isin(F.col("first_crc"), F.col("last_crc")).alias("edge"),
                       (F.col("bytes_before") + F.coalesce(F.sum("size").over(running), F.lit(0))).alias("start"),
                       (F.col("rows_before") + F.row_number().over(ordered) - 1).alias("row"))
    rows = written(spark, rows.withColumns({"group_start": F.min("start").over(group), "group_size": F.sum("size").over(group)}), "positions")
    # groups that may go on in another range: at most two per range
    over_all = rows.where("edge").groupBy("text_crc32").agg(F.min("start").alias("whole_start"), F.sum("size").alias("whole_size"))
    rows = rows.join(F.broadcast(over_all), "text_crc32", "left").withColumns({
        "group_start": F.coalesce("whole_start", "group_start"), "group_size": F.coalesce("whole_size", "group_size")})
    whole = F.col("group_size") <= max(largest, total // (shards * GROUP_PART))
    twice_middle = F.when(whole, 2 * F.col("group_start") + F.col("group_size")).otherwise(2 * F.col("start") + F.col("size"))
    shard = F.least(F.floor(twice_middle * shards / F.lit(max(1, 2 * total))), F.lit(shards - 1)).cast("int")
    placed = written(spark, rows.select("doc_id", "size", "text_crc32", shard.alias("shard"), "row"), "placed")

    firsts = placed.groupBy("shard").agg(F.min("row").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select(  # `shards` rows
        "doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", (F.col("row") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))


def _key(low: int, high: int) -> Column:
    """A long in the order of the rows: crc, then the id as far as bits allow. Spare bits tell repeated rows apart."""
    width = (high - low + 1).bit_length()
    spare = min(SALT_BITS, max(0, PLACE_BITS - width))
    place = F.coalesce(F.shiftright(F.col("doc_id") - F.lit(low) + 1, max(0, width - PLACE_BITS)), F.lit(0))
    return F.col("text_crc32") * F.lit(1 << PLACE_BITS) + F.shiftleft(place, spare) + F.pmod("salt", F.lit(1 << spare))


def _splitters(rows: DataFrame, ranges: int, total: int, weight: Column) -> list[int]:
    """Quantile boundaries of a weighted key sample: a record is drawn as often as its weight tells, large ones several times."""
    if not total:
        return []
    uniform = F.pmod(F.xxhash64("key", "salt"), F.lit(1 << 30)) / F.lit(1 << 30)
    draws = F.floor(weight * F.lit(ranges * SAMPLES / total) + uniform).cast("long")
    sample = rows.select("key", draws.alias("draws")).where("draws > 0")
    sample = sample.select(F.explode(F.array_repeat("key", F.col("draws").cast("int"))).alias("key"))  # some ranges * SAMPLES keys
    drawn = sample.agg(F.sort_array(F.collect_list("key")).alias("keys"))  # exact: percentile functions round longs to doubles
    at = F.transform(F.sequence(F.lit(1), F.lit(ranges - 1)), lambda i: F.get("keys", F.floor(i * F.size("keys") / ranges).cast("int")))
    return sorted({b for b in drawn.where(F.size("keys") > 0).select(at).head(1)[0][0]}) if not sample.isEmpty() else []


def _subdivided(rows: DataFrame, bounds: list[int], mean: float) -> DataFrame:
    """``part`` within the range: 0, or in an overfull range the place of the key among the quantiles of rows."""
    counts = rows.groupBy("range").agg(F.count("*").alias("n"))
    over = counts.where(F.col("n") > OVERFULL * mean).select("range", F.lit(True).alias("over"))  # at most 1 / OVERFULL of the ranges
    rows = rows.join(F.broadcast(over), "range", "left")
    return rows.withColumn("part", F.when(F.col("over"), _position(F.col("key"), bounds)).otherwise(0).cast("int")).drop("over")
