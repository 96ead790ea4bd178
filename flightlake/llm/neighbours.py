"""Approximate nearest neighbours: a robust-pruned directed graph per shard, searched by beam.

Vectors are dealt at random to shards of about ``SHARD_ROWS``. In each shard a graph is built batch by
batch: a greedy search from the entry point proposes neighbours, relaxed distance pruning
(``ALPHA``) keeps edges in diverse directions, and back edges are pruned the same way. The shards' graphs
are written to the shared folder, one row each, and stay where they are: queries come to them in blocks of
about ``QUERY_BYTES``, each broadcast to one pass over the graphs. A beam search returns the shard's nearest for
every query, and the best over all shards are kept. No shuffle carries points once the index is written.

Equal vectors enter the graph once, with their ``k + 1`` smallest ids (no query can see further: ties go
to smaller ids, and a query skips only itself), so copies cannot fill up a graph's edges. Distances are
computed in double precision on the original vectors.

Defined results: vectors that are null, empty, zero or hold a null or non-finite component take no part,
neither do null ids; vectors of different lengths are never compared; a repeated id is one candidate, at
its nearest vector, and each of its rows asks; fewer candidates than ``k`` give all of them; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import columns, ship, written

SHARD_ROWS = 4096
DEGREE, BEAM_BUILD, BEAM_SEARCH, ALPHA = 24, 48, 96, 1.2
#: Open points expanded at a time; points inserted, or searched, at a time; bytes of queries sent to the shards at a time.
EXPANDED, BATCH = 4, 64
QUERY_BYTES = 64 << 20


class Graph:
    """A robust-pruned graph over the rows of ``points``; unused edges are -1. Many points are searched, or pruned, at once."""

    def __init__(self, points: np.ndarray, edges: np.ndarray, entry: int):
        self.points, self.edges, self.entry = points, edges, entry
        self.norms = (points * points).sum(axis=1)

    def search(self, asked: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Beam search from the entry, for each row of ``asked``: ids and squared distances of the ``beam``
        nearest, nearest first, and of all that were expanded on the way (absent: -1 at infinity)."""
        rows = len(asked)
        seen = np.zeros((rows, len(self.points)), bool)
        seen[:, self.entry] = True
        ids, far = np.full((rows, beam), -1), np.full((rows, beam), np.inf)
        ids[:, 0], far[:, 0] = self.entry, ((self.points[self.entry] - asked) ** 2).sum(axis=1)
        open_ = ids >= 0
        passed, passed_far = [], []
        while True:
            live = np.flatnonzero(open_.any(axis=1))
            if not len(live):
                break
            here, here_far, here_open = ids[live], far[live], open_[live]
            step = here_open & (np.cumsum(here_open, axis=1) <= EXPANDED)  # the nearest few that are still open
            at = np.argsort(~step, axis=1, kind="stable")[:, :EXPANDED]
            chosen = np.where(np.take_along_axis(step, at, 1), np.take_along_axis(here, at, 1), -1)
            for kept, values, none in ((passed, chosen, -1), (passed_far, np.where(chosen >= 0, np.take_along_axis(here_far, at, 1), np.inf), np.inf)):
                whole = np.full((rows, EXPANDED), none)
                whole[live] = values
                kept.append(whole)
            near = np.where(chosen[:, :, None] >= 0, self.edges[chosen], -1).reshape(len(live), -1)
            near.sort(axis=1)
            new = near >= 0
            new[:, 1:] &= near[:, 1:] != near[:, :-1]
            new &= ~seen[live[:, None], near]
            r, c = np.nonzero(new)
            found = near[r, c]
            seen[live[r], found] = True
            more = np.full(near.shape, np.inf)
            gap = self.points[found] - asked[live[r]]
            more[r, c] = np.einsum("ij,ij->i", gap, gap)
            every, every_far = np.hstack([here, np.where(new, near, -1)]), np.hstack([here_far, more])
            every_open = np.hstack([here_open & ~step, new])
            order = np.argsort(every_far, axis=1, kind="stable")[:, :beam]
            ids[live], far[live], open_[live] = (np.take_along_axis(x, order, 1) for x in (every, every_far, every_open))
        return ids, far, np.hstack(passed), np.hstack(passed_far)

    def prune(self, own: np.ndarray, ids: np.ndarray, far: np.ndarray) -> np.ndarray:
        """Robust pruning, for each row: the nearest candidate stays and removes those it is ``ALPHA`` times closer to than
        ``own`` is, until ``DEGREE`` stay."""
        far = np.where((ids < 0) | (ids == own[:, None]), np.inf, far)
        order = np.argsort(far, axis=1, kind="stable")
        ids, far = np.take_along_axis(ids, order, 1), np.take_along_axis(far, order, 1)
        points, norms = self.points[ids], self.norms[ids]
        between = norms[:, :, None] + norms[:, None, :] - 2 * (points @ points.transpose(0, 2, 1))
        alive, kept = np.isfinite(far), np.full((len(ids), DEGREE), -1)
        rows = np.arange(len(ids))
        for i in range(DEGREE):
            if not alive.any():
                break
            first = alive.argmax(axis=1)
            some = alive[rows, first]
            kept[some, i] = ids[rows, first][some]
            alive &= ALPHA * ALPHA * between[rows, first] > far
            alive[rows, first] = False
        return kept

    def distances(self, own: np.ndarray, ids: np.ndarray) -> np.ndarray:
        gap = self.points[ids] - self.points[own][:, None, :]
        return np.einsum("ijk,ijk->ij", gap, gap)


def _batches(n: int) -> Iterator[tuple[int, int]]:
    """Ranges of 1 to n - 1 that double up to ``BATCH``: a batch is never larger than what stands."""
    at = 1
    while at < n:
        end = min(n, at + min(at, BATCH))
        yield at, end
        at = end


def build(points: np.ndarray) -> Graph:
    """The graph of a bounded shard: from the medoid on, points are inserted batch by batch. Each is searched in the
    graph so far; what it meets on the way and the rest of its batch are its candidates."""
    n = len(points)
    entry = int(((points - points.mean(axis=0)) ** 2).sum(axis=1).argmin())
    order = np.random.default_rng(n).permutation(n)
    order = np.concatenate(([entry], order[order != entry]))
    graph = Graph(points, np.full((n, 2 * DEGREE), -1), entry)  # rows are pruned to DEGREE when they are full
    used = np.zeros(n, np.int64)

    def back(own: np.ndarray, other: np.ndarray) -> None:
        """Edges from ``own`` (sorted) to ``other``."""
        who, first, count = np.unique(own, return_index=True, return_counts=True)
        place = np.arange(len(own)) - np.repeat(first, count)
        more = np.full((len(who), count.max()), -1)
        more[np.repeat(np.arange(len(who)), count), place] = other
        fits = used[who] + count <= 2 * DEGREE
        easy = np.repeat(fits, count)
        graph.edges[own[easy], used[own[easy]] + place[easy]] = other[easy]
        used[who[fits]] += count[fits]
        full = np.flatnonzero(~fits)
        for a in range(0, len(full), BATCH):
            part = full[a: a + BATCH]
            ids = np.hstack([graph.edges[who[part]], more[part]])
            settle(who[part], graph.prune(who[part], ids, graph.distances(who[part], ids)))

    def settle(own: np.ndarray, kept: np.ndarray) -> None:
        graph.edges[own] = -1
        graph.edges[own, :DEGREE] = kept
        used[own] = (kept >= 0).sum(axis=1)

    for a, b in _batches(n):
        own = order[a:b]
        ids, far, passed, passed_far = graph.search(points[own], BEAM_BUILD)
        passed = np.where((passed[:, :, None] == ids[:, None, :]).any(axis=2), -1, passed)  # still in the beam: once is enough
        mates = np.broadcast_to(own, (len(own), len(own)))
        ids = np.hstack([ids, passed, mates])
        far = np.hstack([far, np.where(passed >= 0, passed_far, np.inf), graph.distances(own, mates)])
        nearest = np.argsort(far, axis=1, kind="stable")[:, : 2 * BEAM_BUILD]
        kept = graph.prune(own, np.take_along_axis(ids, nearest, 1), np.take_along_axis(far, nearest, 1))
        settle(own, kept)
        from_, to = np.nonzero(kept >= 0)
        target, source = kept[from_, to], own[from_]
        by = np.argsort(target, kind="stable")
        if len(by):
            back(target[by], source[by])
    wide = np.flatnonzero(used > DEGREE)
    for a in range(0, len(wide), BATCH):
        part = wide[a: a + BATCH]
        settle(part, graph.prune(part, graph.edges[part], graph.distances(part, graph.edges[part])))
    return Graph(points, graph.edges[:, :DEGREE].copy(), entry)


def _usable(vector: Column) -> Column:
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return vector.isNotNull() & (F.size(vector) > 0) & good & F.exists(vector, lambda x: x != 0)


def _stack(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), np.float64)


def _shard_graph(table: pa.Table) -> pa.Table:
    table = table.sort_by("first_id")
    points = _stack(table["vector"])
    graph = build(points)
    ids = table["ids"].to_pylist()
    return pa.table({
        "dims": pa.array([points.shape[1]], pa.int32()), "points": pa.array([points.tobytes()], pa.binary()),
        "edges": pa.array([graph.edges.astype(np.int32).tobytes()], pa.binary()), "entry": pa.array([graph.entry], pa.int32()),
        "ids": pa.array([[x for row in ids for x in row]], pa.list_(pa.int64())),
        "counts": pa.array([[len(row) for row in ids]], pa.list_(pa.int32()))})


def build_index(vectors: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard: points, edges, entry point and the ids of every point. ``vectors(id, vector)`` is usable."""
    spark = vectors.sparkSession
    ship(spark)
    places = F.array_sort(F.collect_set("id"))
    # copies of one vector: the k + 1 smallest ids, kept small on the map side too
    ranked = vectors.distinct().withColumn("place", F.row_number().over(Window.partitionBy("vector").orderBy("id")))
    points = ranked.where(F.col("place") <= k + 1).groupBy("vector").agg(places.alias("ids")).withColumn("first_id", F.col("ids")[0])
    points = written(spark, points.withColumn("dims", F.size("vector")), "points")
    sizes = {r["dims"]: r["count"] for r in points.groupBy("dims").count().collect()}  # one row per vector length
    shards = F.lit(1)
    for dims, n in sizes.items():
        shards = F.when(F.col("dims") == dims, F.lit(-(-n // shard_rows))).otherwise(shards)
    dealt = points.withColumn("shard", F.pmod(F.xxhash64("first_id"), shards))
    built = dealt.groupBy("dims", "shard").applyInArrow(
        _shard_graph, "dims int, points binary, edges binary, entry int, ids array<bigint>, counts array<int>")
    return written(spark, built, "graphs")


def _query_blocks(queries: DataFrame) -> Iterator[dict[int, tuple[np.ndarray, np.ndarray]]]:
    """The queries in blocks of about ``QUERY_BYTES``: by vector length, ids and vectors."""
    size = queries.agg(F.sum(F.size("vector").cast("long") * 8)).first()[0] or 0
    parts = -(-size // QUERY_BYTES)
    for part in range(parts):
        mine = queries.where(F.pmod(F.xxhash64("id", "vector"), F.lit(parts)) == part) if parts > 1 else queries
        rows = mine.orderBy("id").collect()  # a block of the queries: bounded by QUERY_BYTES
        block = {}
        for dims in {len(r["vector"]) for r in rows}:
            own = [r for r in rows if len(r["vector"]) == dims]
            block[dims] = np.array([r["id"] for r in own]), np.array([r["vector"] for r in own], np.float64)
        yield block


def search(index: DataFrame, queries: DataFrame, k: int, beam: int = BEAM_SEARCH) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest ids other than the query's own. ``queries(id, vector)`` is a stored table."""
    spark, beam = index.sparkSession, max(beam, k + 1)
    schema = "query_id long, vec_id long, score double"
    near = None
    for block in _query_blocks(queries):
        sent = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    if row["dims"] not in sent.value:
                        continue
                    asked_ids, asked = sent.value[row["dims"]]
                    points = np.frombuffer(row["points"], np.float64).reshape(-1, row["dims"])
                    graph = Graph(points, np.frombuffer(row["edges"], np.int32).reshape(len(points), DEGREE), row["entry"])
                    ids, ends = np.array(row["ids"]), np.cumsum(row["counts"])
                    out = []
                    for a in range(0, len(asked), BATCH):
                        found, far, _, _ = graph.search(asked[a: a + BATCH], beam)
                        for own, hits, dists in zip(asked_ids[a: a + BATCH].tolist(), found, np.sqrt(far)):
                            near = [(d, i) for p, d in zip(hits.tolist(), dists.tolist()) if p >= 0
                                    for i in ids[ends[p] - row["counts"][p]: ends[p]].tolist() if i != own]
                            out += [(own, i, d) for d, i in sorted(near)[:k]]
                    cols = list(zip(*out)) if out else ([], [], [])
                    yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.float64())],
                                                     names=["query_id", "vec_id", "score"])

        part = index.mapInArrow(run, schema)
        near = part if near is None else near.union(part)
    near = spark.createDataFrame([], schema) if near is None else near
    near = near.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return near.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(embeddings: DataFrame, asked: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest rows of every row that ``asked`` (a condition on ``id``) selects."""
    spark = embeddings.sparkSession
    rows = columns(embeddings, F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & _usable(F.col("vector")))
    queries = written(spark, rows.where(asked).distinct(), "asked")
    return search(build_index(rows, k), queries, k)
