"""Helpers shared by the operators: tables, shared scratch, shipping the package to executors."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_PACKAGE = __name__.split(".")[0]
#: Narrow rows (ids, keys, labels) that may be broadcast; beyond it they are shuffled.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table, through Spark's reader only (the path may be in any store)."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def columns(df: DataFrame, *names: str) -> DataFrame:
    """Only the columns an operator needs: extra columns with clashing names never meet its own."""
    return df.select(*names)


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Set here only for a local master without one."""
    given = spark.conf.get("spark.checkpoint.dir", None)
    if given:
        return given.rstrip("/")
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="llm-shared-"))
    return sc.getCheckpointDir().rstrip("/")


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: lineage ends there, and a
    lost executor costs a re-read, not a recomputation. ``release`` removes the folders."""
    path = f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _SCRATCH.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def beside(df: DataFrame, rows: int | None = None) -> DataFrame:
    """A narrow side of a join: broadcast while it is small, else left to be shuffled. ``rows``: how many it has at
    most, if that is known; else ``df`` should read a written table, where counting is cheap."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= BROADCAST_ROWS else df


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``written`` returned, once all that was computed from them is written too."""
    for df in tables:
        if df._scratch in _SCRATCH:
            _SCRATCH.remove(df._scratch)
            _delete(df.sparkSession, df._scratch)


def _delete(spark: SparkSession, where: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_SCRATCH: list[str] = []


def release(spark: SparkSession) -> None:
    """Delete the scratch tables of this application (once their results have been written)."""
    while _SCRATCH:
        _delete(spark, _SCRATCH.pop())


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application, as ``--py-files`` would."""
    sc = spark.sparkContext
    if getattr(sc, "_llm_shipped", False):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    base = os.path.join(tempfile.mkdtemp(prefix="llm-ship-"), f"{_PACKAGE}_llm")
    stage = tempfile.mkdtemp(prefix="llm-stage-")
    shutil.copytree(root, os.path.join(stage, _PACKAGE), ignore=shutil.ignore_patterns("__pycache__"))
    sc.addPyFile(shutil.make_archive(base, "zip", stage))
    sc._llm_shipped = True
