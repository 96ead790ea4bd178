"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import beside, discard, written


def components(edges: DataFrame, rounds: int = 200) -> DataFrame:
    """``(node, label)``, a written table, for every node of ``edges(a, b)``, which should read written tables; label =
    smallest node of its component.

    Each round a node takes the smallest label among itself and its neighbours and then its label's
    label; the edges then join labels instead of nodes, and those within one label go, so a star is done after
    one round and each round works on what is left of the last. The smallest node of a component is its own
    label in every round. Rounds' labels are put together at the end, last to first. All is written to the
    shared folder; no edge or label reaches the driver, only how many there are. Hot nodes: edges are joined to a
    one-row-per-node side (splittable, or broadcast while it is small) and minima are combined map-side."""
    spark = edges.sparkSession
    left, steps, scratch = edges.select("a", "b"), [], []
    for _ in range(rounds):
        many = left.count()
        if steps and not many:
            break
        ends = left.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.col("b").alias("near")),
                                             F.struct(F.col("b").alias("node"), F.col("a").alias("near")))).alias("e")).select("e.*")
        least = written(spark, ends.groupBy("node").agg(F.min("near").alias("near")).select("node", F.least("node", "near").alias("label")), "least")
        steps.append((least, 2 * many))
        between = _followed(_followed(left.toDF("a2", "b2"), least, "a2", 2 * many), least, "b2", 2 * many).where("a2 <> b2")
        left = written(spark, between.select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct(), "edges")
        scratch += [least, left]
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    found = None
    for least, nodes in reversed(steps):
        whole = _one_step(least, least, "label", nodes)
        found = whole if found is None else _one_step(whole, found, "label", further)
        further = nodes
    found = written(spark, found, "labels")
    discard(*scratch)
    return found


def _one_step(rows: DataFrame, labels: DataFrame, column: str, nodes: int) -> DataFrame:
    """``column`` replaced by its label, if it has one."""
    side = beside(labels.select(F.col("node").alias(column), F.col("label").alias("_next")), nodes)
    names = rows.columns
    return rows.join(side, column, "left").withColumn(column, F.coalesce("_next", column)).select(*names)


def _followed(rows: DataFrame, labels: DataFrame, column: str, nodes: int) -> DataFrame:
    """``column`` replaced by its label's label."""
    return _one_step(_one_step(rows, labels, column, nodes), labels, column, nodes)
