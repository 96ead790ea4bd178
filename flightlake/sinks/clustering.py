"""Files clustered along a space-filling curve over several columns, and scans that skip files on any of them.

Sorting files by one column lets a filter on that column skip files, and no other. Here each clustering column is cut into
``2 ** bits`` buckets at its own quantiles, the bits of the buckets are interleaved (a Z-order curve), and files hold
consecutive pieces of the curve, so each file is narrow in every column. A manifest beside the files gives their rows, bytes and the
range of each column; :func:`read_clustered` opens only files whose ranges meet the filter. The quantiles come from a bounded
sample and decide only where rows lie, never what is read. A cell of the curve with many rows is
spread over several files by a hash of the row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.session import exists, freed_shuffles, remove_path, scratch_path
from flightlake.sinks.writers import waves_of

#: Rows aimed at per file; bits of the curve per column; rows sampled for the quantiles.
FILE_ROWS = 2_000_000
BITS = 6
#: Tasks that write, from which on each writes several files; rows per task from which on there are more tasks.
MOST_TASKS, TASK_ROWS = 1_000, 2_000_000
SAMPLE_ROWS = 10_000
MANIFEST = "_files"

Bounds = Mapping[str, tuple[object, object]]


def quantile_bounds(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> dict[str, list]:
    """Per column, at most ``2 ** bits - 1`` values that cut a sample of ``SAMPLE_ROWS`` rows into equal parts."""
    sample = df.select(*columns).orderBy(F.xxhash64(*df.columns)).limit(SAMPLE_ROWS).collect()  # SAMPLE_ROWS rows
    out = {}
    for c in columns:
        values = sorted(r[c] for r in sample if r[c] is not None)
        parts = 1 << bits
        out[c] = sorted({values[i * len(values) // parts] for i in range(1, parts)}) if values else []
    return out


def curve(df: DataFrame, bounds: Mapping[str, Sequence], bits: int = BITS) -> Column:
    """Place on the Z-order curve: the interleaved bits of each column's bucket (NULL: the first)."""
    bits_of = []
    for j, (c, cuts) in enumerate(bounds.items()):
        if not cuts:
            continue
        kind = df.schema[c].dataType
        bucket = reduce(add, [F.when(F.lit(v).cast(kind) <= F.col(c), F.lit(1)).otherwise(F.lit(0)) for v in cuts]).cast("long")  # a NULL passes no cut
        bits_of += [F.shiftleft(F.shiftright(bucket, i).bitwiseAND(F.lit(1).cast("long")), i * len(bounds) + j) for i in range(bits)]
    return reduce(add, bits_of, F.lit(0).cast("long"))


def write_clustered(df: DataFrame, path: str, columns: Sequence[str], file_rows: int = FILE_ROWS, bits: int = BITS) -> DataFrame:
    """Write ``df`` to ``path`` along the curve over ``columns``; returns the manifest.

    ``df`` is read three times (count and sample; places; rows): give it as a stored table. Of very many files each task
    writes a piece of the curve, file after file, so that the shuffle has a bounded number of partitions. Very many rows
    (:func:`~flightlake.sinks.writers.waves_of`) are first dealt to long pieces of the curve in a scratch copy, without a shuffle, and then
    shuffled piece by piece.
    """
    if not 0 < bits * len(columns) < 63:
        raise ValueError("bits of all columns together must be 1 to 62")
    with freed_shuffles(df.sparkSession):
        return _write_clustered(df, path, columns, file_rows, bits)


def _write_clustered(df: DataFrame, path: str, columns: Sequence[str], file_rows: int, bits: int) -> DataFrame:
    n = df.count()
    files = max(1, -(-n // file_rows))
    tasks = min(files, max(MOST_TASKS, -(-n // TASK_ROWS)))
    placed = df.withColumn("__z", curve(df, quantile_bounds(df, columns, bits), bits)).withColumn("__spread", F.xxhash64(*df.columns))
    along = ["__z"] if tasks < files else []  # files of one task follow the curve too
    waves, scratch = waves_of(n), None
    try:
        if waves > 1:
            scratch = scratch_path(df.sparkSession, "curve")
            placed.withColumn("__piece", _piece(placed, waves)).write.partitionBy("__piece").parquet(scratch)
        for i in range(waves):
            at, piece = f"{scratch}/__piece={i}", placed
            if scratch and not exists(df.sparkSession, at):
                continue
            if scratch:
                piece = df.sparkSession.read.schema(placed.schema).parquet(at)
            laid = piece.repartitionByRange(-(-tasks // waves), "__z", "__spread").sortWithinPartitions(*along, *columns)
            laid.drop("__z", "__spread").write.mode("append" if scratch else "errorifexists").option("maxRecordsPerFile", file_rows if along else 0).parquet(path)
            if scratch:
                remove_path(df.sparkSession, at)
    finally:
        if scratch:
            remove_path(df.sparkSession, scratch)
    manifest = _ranges(df.sparkSession, path, df, columns)
    manifest.coalesce(1).write.parquet(f"{path}/{MANIFEST}")
    return df.sparkSession.read.schema(manifest.schema).parquet(f"{path}/{MANIFEST}")


def _piece(placed: DataFrame, pieces: int) -> Column:
    """Number of the piece of the curve that a row lies in; pieces have about equal rows, by the quantiles of a bounded sample."""
    sample = sorted(tuple(r) for r in placed.select("__z", "__spread").orderBy(F.xxhash64("__spread")).limit(SAMPLE_ROWS).collect())  # SAMPLE_ROWS rows
    cuts = [sample[i * len(sample) // pieces] for i in range(1, pieces)]
    z, spread = F.col("__z"), F.col("__spread")
    return reduce(add, [F.when((z > a) | ((z == a) & (spread >= b)), 1).otherwise(0) for a, b in cuts])


def _ranges(spark: SparkSession, path: str, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    rows = spark.read.schema(df.schema).parquet(path)
    found = rows.select(F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_size").alias("bytes"), *columns)
    return found.groupBy("file", "bytes").agg(
        F.count(F.lit(1)).alias("rows"), *[f(c).alias(f"{name}_{c}") for c in columns for name, f in (("low", F.min), ("high", F.max))])


def meeting(manifest: DataFrame, bounds: Bounds) -> DataFrame:
    """The files that may hold a row with every column of ``bounds`` between its two values (None: open)."""
    tests = [F.lit(True)]
    for c, (low, high) in bounds.items():
        tests += [F.col(f"high_{c}") >= F.lit(low)] if low is not None else []
        tests += [F.col(f"low_{c}") <= F.lit(high)] if high is not None else []
        tests += [F.col(f"low_{c}").isNotNull()]
    return manifest.where(reduce(and_, tests))


def read_clustered(spark: SparkSession, path: str, schema, bounds: Bounds) -> DataFrame:
    """The rows within ``bounds`` (both ends included; rows with a NULL there never are), from files that may hold some.

    Columns that the files are not clustered by filter rows only.
    """
    manifest = spark.read.parquet(f"{path}/{MANIFEST}")
    known = {c: b for c, b in bounds.items() if f"low_{c}" in manifest.columns}
    names = [r["file"] for r in meeting(manifest, known).select("file").collect()]  # one per file that is read
    rows = spark.read.schema(schema).parquet(*[f"{path}/{n}" for n in names]) if names else spark.createDataFrame([], schema)
    for c, (low, high) in bounds.items():
        rows = rows.where(F.col(c).isNotNull())
        rows = rows.where(F.col(c) >= F.lit(low)) if low is not None else rows
        rows = rows.where(F.col(c) <= F.lit(high)) if high is not None else rows
    return rows
