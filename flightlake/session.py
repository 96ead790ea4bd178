"""Session construction and the shared scratch location."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", app: str = "flightlake") -> SparkSession:
    """A local session with the settings the library relies on.

    On a cluster the session comes from the platform. AQE (on by default)
    is the setting that matters there; the code does not depend on the
    session time zone (dates and ``timestamp_ntz`` only), and dynamic
    partition overwrite is requested per write where months are swapped.
    """
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    return spark


def configure(spark: SparkSession) -> SparkSession:
    """Hook for a caller's session; changes no session-wide setting.

    Nothing here relies on the session time zone, and partition overwrite
    mode is chosen per write (static for full rebuilds, dynamic for month
    swaps), so a host application's session keeps its own behaviour.
    """
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``, as a URI.

    Read from the session. Only when nothing is configured and the master is
    one local process (tests, a laptop) a local folder is created; on a
    cluster a folder of one machine would lose data, so it raises there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        return current
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("spark.checkpoint.dir is not set: staging needs a folder that driver and executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="flightlake-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path (with its scheme) under the shared folder for a written layer."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a staging copy through the Hadoop file system."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


# Target bytes read per initial shuffle partition (AQE merges small ones
# afterwards, but it cannot split an aggregation's partitions), and the most
# partitions: map outputs grow with maps x reducers, so very large shuffles
# get larger partitions instead of more.
SHUFFLE_TARGET_BYTES = 256 * 1024 * 1024
SHUFFLE_MAX_PARTITIONS = 20_000
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def shuffle_partitions(input_bytes: int, parallelism: int, target_bytes: int = SHUFFLE_TARGET_BYTES) -> int:
    """About one partition per ``target_bytes``, at least one per core, at most ``SHUFFLE_MAX_PARTITIONS``."""
    return max(parallelism, min(SHUFFLE_MAX_PARTITIONS, -(-int(input_bytes) // target_bytes)))


def size_shuffles(spark: SparkSession, input_bytes: int,
                  target_bytes: int = SHUFFLE_TARGET_BYTES) -> int | None:
    """Set AQE's initial shuffle partition count from the bytes a run reads.

    Respects a value the user already set; returns the count set, or None.
    """
    if spark.conf.get(INITIAL_PARTITIONS, None):
        return None
    n = shuffle_partitions(input_bytes, spark.sparkContext.defaultParallelism, target_bytes)
    spark.conf.set(INITIAL_PARTITIONS, str(n))
    return n


@contextlib.contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int):
    """:func:`size_shuffles` and :func:`freed_shuffles` for the duration of one run, then restored, so
    a host application's session keeps its own setting afterwards."""
    n = size_shuffles(spark, input_bytes)
    try:
        with freed_shuffles(spark):
            yield n
    finally:
        if n is not None:
            spark.conf.unset(INITIAL_PARTITIONS)


FREED_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession):
    """The shuffle files of each job are deleted when it ends; otherwise they lie until the driver's
    garbage collector finds them, so that the disk holds those of all steps of a run at once."""
    if spark.conf.get(FREED_SHUFFLES, "false") == "true":
        yield
        return
    spark.conf.set(FREED_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREED_SHUFFLES)


@contextlib.contextmanager
def file_per_task(spark: SparkSession):
    """Reads planned here put each file into a task of its own (a very large one into several)."""
    cost, most = "spark.sql.files.openCostInBytes", "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(cost)
    spark.conf.set(cost, spark.conf.get(most))
    try:
        yield
    finally:
        spark.conf.set(cost, before)
