"""Join helpers: size-checked broadcast and lookup (dimension) joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only when the files behind it hold at most this many
# bytes. Lookups here are narrow (a key plus one to three short strings);
# Parquet and CSV grow a few times in memory, so the bound keeps a broadcast
# to some 64 MB per executor.
BROADCAST_MAX_FILE_BYTES = 16 * 1024 * 1024


def source_bytes(df: DataFrame) -> int:
    """Bytes of all sources behind ``df``, from file metadata: the leaves of
    its optimized plan. No job runs. Unlike the plan's own estimate, which
    multiplies the sides of a join, it bounds a lookup joined to lookups on
    unique keys (repeated keys are caught by the cardinality guard)."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))


def fits(df: DataFrame, max_bytes: int | None = None) -> bool:
    """True when the sources behind ``df`` are small enough to broadcast it."""
    return source_bytes(df) <= (BROADCAST_MAX_FILE_BYTES if max_bytes is None else max_bytes)


def sized_broadcast(df: DataFrame, known_small: bool | None = None) -> DataFrame:
    """Hint a broadcast only for a side whose size is checked.

    Beyond the bound the side is returned unhinted: the planner uses a
    shuffle join, and AQE may still switch to broadcast from runtime sizes
    or split skewed partitions.
    """
    small = fits(df) if known_small is None else known_small
    return F.broadcast(df) if small else df


def lookup_join(fact: DataFrame, lookup: DataFrame, left_on: str, right_on: str,
                columns: dict[str, str], how: str = "left",
                known_small: bool | None = None, keys_from: DataFrame | None = None) -> DataFrame:
    """Join ``fact`` to a lookup and append ``columns`` (source -> new name).

    The lookup key is dropped after the join (the fact keeps its own key),
    and only the named lookup columns travel, so a wide lookup never widens
    the broadcast. ``keys_from``, a table with the fact's keys, lets a left join to a
    lookup beyond the broadcast bound go through :func:`hybrid_lookup_join`.
    """
    if keys_from is not None and how == "left" and comparable(fact, left_on, lookup, right_on):
        small = fits(lookup) if known_small is None else known_small
        if not small:
            return hybrid_lookup_join(fact, lookup, left_on, right_on, columns, keys_from)
    key = f"__lk_{right_on}"
    side = lookup.select(F.col(right_on).alias(key),
                         *[F.col(src).alias(dst) for src, dst in columns.items()])
    side = sized_broadcast(side, known_small)
    return fact.join(side, fact[left_on] == side[key], how).drop(key)


#: Frequent fact keys that a hybrid join answers from a broadcast, at most, and the share of fact rows sampled to find them.
HOT_KEYS = 4096
HOT_SAMPLE = 0.01


def heavy_keys(fact: DataFrame, key: str, most: int = HOT_KEYS, fraction: float = HOT_SAMPLE) -> DataFrame:
    """The (at most ``most``) most frequent non-NULL values of ``key`` in a sample of the rows, as ``hot_key``.

    Lazy, one pass over one column; the counts are merged on the map side.
    """
    seen = fact.select(F.col(key).alias("hot_key")).where(F.col("hot_key").isNotNull()).sample(fraction, seed=17)
    counted = seen.groupBy("hot_key").agg(F.count(F.lit(1)).alias("n"))
    return counted.orderBy(F.desc("n"), "hot_key").limit(most).select("hot_key")


def comparable(fact: DataFrame, left_on: str, lookup: DataFrame, right_on: str) -> bool:
    """Does the lookup key have the fact key's type, or an integer type for a double?"""
    kind, other = fact.schema[left_on].dataType, lookup.schema[right_on].dataType
    return kind == other or (isinstance(kind, T.DoubleType) and isinstance(other, T.IntegralType))


def hybrid_lookup_join(fact: DataFrame, lookup: DataFrame, left_on: str, right_on: str, columns: dict[str, str],
                       keys_from: DataFrame | None = None, most: int = HOT_KEYS, fraction: float = HOT_SAMPLE) -> DataFrame:
    """:func:`lookup_join` (left) for a lookup that is too large to broadcast, with frequent or NULL fact keys.

    The lookup's rows of the frequent keys are broadcast: at most ``most`` rows, since a key that
    repeats in the lookup is left to the shuffle. All other keys go through a shuffle join. Rows that the broadcast has answered,
    and rows with a NULL key, take part in that shuffle under a hash of the whole row, which
    matches nothing, so no partition collects them. The frequent keys are sampled from ``keys_from`` (the fact
    itself; name the table behind it when ``fact`` is a join already, which would run twice). A sample that misses a
    frequent key costs balance, never rows. An integer lookup key may meet a double.
    """
    known, cold = _hot_and_cold(fact, lookup, left_on, right_on, columns, fact if keys_from is None else keys_from, most, fraction)
    near = fact.join(F.broadcast(known), fact[left_on] == known["__hot"], "left")
    out = near.withColumn("__place", _place(fact, left_on, "__hot")).join(cold, F.col("__place") == F.col("__at"), "left")
    return out.select(*[fact[c] for c in fact.columns], *[
        F.when(F.col("__hot").isNotNull(), F.col(f"__hot_row.{dst}")).otherwise(F.col(f"__cold_row.{dst}")).alias(dst)
        for dst in columns.values()])


def hybrid_lookup_joins(fact: DataFrame, joins: Sequence[tuple[DataFrame, str, str, dict[str, str]]],
                        most: int = HOT_KEYS, fraction: float = HOT_SAMPLE) -> DataFrame:
    """:func:`hybrid_lookup_join` to several lookups: ``(lookup, left_on, right_on, columns)`` each.

    Rows that the broadcasts answer in every lookup are shuffled nowhere; the others go through one shuffle
    join per lookup. ``fact`` is read for each of the two and for the sample of each key: give it as a stored table.
    """
    near, settled, sides = fact, F.lit(True), []
    for i, (lookup, left_on, right_on, columns) in enumerate(joins):
        known, cold = _hot_and_cold(fact, lookup, left_on, right_on, columns, fact, most, fraction)
        near = near.join(F.broadcast(known.toDF(f"__hot{i}", f"__hot_row{i}")), F.col(left_on) == F.col(f"__hot{i}"), "left")
        settled = settled & (F.col(f"__hot{i}").isNotNull() | F.col(left_on).isNull())
        sides.append((i, left_on, list(columns.values()), cold.toDF(f"__at{i}", f"__cold_row{i}")))
    answered = near.where(settled).select(*fact.columns, *[
        F.col(f"__hot_row{i}.{dst}").alias(dst) for i, _, names, _ in sides for dst in names])
    rest = near.where(~settled)
    for i, left_on, _, cold in sides:
        rest = rest.withColumn(f"__place{i}", _place(fact, left_on, f"__hot{i}")).join(cold, F.col(f"__place{i}") == F.col(f"__at{i}"), "left")
    return answered.unionByName(rest.select(*fact.columns, *[
        F.when(F.col(f"__hot{i}").isNotNull(), F.col(f"__hot_row{i}.{dst}")).otherwise(F.col(f"__cold_row{i}.{dst}")).alias(dst)
        for i, _, names, _ in sides for dst in names]))


def _place(fact: DataFrame, left_on: str, hot: str) -> Column:
    """Where a row goes in the shuffle: under its key, or under a hash of the row if that is answered or NULL."""
    settled = F.col(hot).isNotNull() | F.col(left_on).isNull()
    return F.struct(F.when(~settled, F.col(left_on)).alias("k"), F.when(settled, F.xxhash64(*fact.columns)).alias("spread"))


def _hot_and_cold(fact: DataFrame, lookup: DataFrame, left_on: str, right_on: str, columns: dict[str, str],
                  keys_from: DataFrame, most: int, fraction: float) -> tuple[DataFrame, DataFrame]:
    """The lookup's rows of frequent keys (``__hot, __hot_row``), and all of them by place in the shuffle (``__at, __cold_row``)."""
    kind = fact.schema[left_on].dataType
    if not comparable(fact, left_on, lookup, right_on):
        raise TypeError(f"{right_on} does not fit into the type of {left_on} ({kind.simpleString()}): cast one of them")
    side = lookup.select(F.col(right_on).cast(kind).alias("__key"), F.struct(
        *[F.col(src).alias(dst) for src, dst in columns.items()]).alias("__row"))
    hot = heavy_keys(keys_from, left_on, most, fraction)
    # one aggregate over lookup rows and marks: a marked key without a lookup row is answered too, with NULLs
    marked = side.select("__key", "__row", F.lit(1).alias("n"), F.lit(False).alias("hot")).unionByName(
        hot.select(F.col("hot_key").alias("__key"), F.lit(None).cast(side.schema["__row"].dataType).alias("__row"),
                   F.lit(0).alias("n"), F.lit(True).alias("hot")))
    known = marked.groupBy("__key").agg(F.max("hot").alias("hot"), F.sum("n").alias("n"),
                                        F.first("__row", ignorenulls=True).alias("__hot_row"))
    known = known.where(F.col("hot") & (F.col("n") <= 1)).select(F.col("__key").alias("__hot"), "__hot_row")
    cold = side.where(F.col("__key").isNotNull()).select(
        F.struct(F.col("__key").alias("k"), F.lit(None).cast("long").alias("spread")).alias("__at"), F.col("__row").alias("__cold_row"))
    return known, cold


def null_safe_keys(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   prefix: str = "__r_") -> tuple[DataFrame, Column]:
    """Rename ``right``'s key columns and build a NULL-safe equality on them.

    Plain ``join(.., on=keys)`` never matches a NULL key; with ``<=>`` a NULL
    matches a NULL, which set-like operations (replace by key, confirm a
    candidate) need. ``<=>`` keys still plan as hash/sort-merge join keys.
    """
    r = right.select(*[F.col(k).alias(prefix + k) for k in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[prefix + k])
        cond = c if cond is None else cond & c
    return r, cond


def assert_same_count(before: int, after: int, what: str = "join") -> None:
    """Join cardinality guard: a lookup join must neither add nor lose rows."""
    if before != after:
        raise AssertionError(
            f"{what} changed the number of rows: {before:,} went in, {after:,} came out")
