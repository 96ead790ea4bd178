"""Near-duplicate classes by a chosen-path set similarity join.

A document's set holds its distinct word shingles. Equal sets collapse first (one *node* per
distinct set), so copies never meet as pairs. Every node gets ``WIDTH`` minwise values. In each of
``TREES`` independent trees a tree node picks one or two of those coordinates (``1 / similarity``
on average) and sends a set on to the child named by the coordinate's minwise token. Similar sets
follow a common path with high probability, others part quickly. Children with at most ``LEAF``
sets are compared exhaustively; larger ones branch again.

Before a level is compared, every set of a child is linked to one pivot of the child, confirmed on full sets: the one
that shares the most tokens in all trees, which in a group of near copies is the text they came from. From then on only pairs
across components matter, so a group of near copies costs its size, not its square. Children of at most ``LEAF`` sets are
compared in a task: minwise agreement within ``SLACK`` of the threshold (four standard deviations) tells the sets that
may link across components, and an inverted index over their full sets the exact similarities; at most a spanning set of links leaves
the task. Larger children with few sets outside their main component compare those with all others, dealt out in parts; the rest
branch on, and what is still large after ``DEPTH`` levels is compared in blocks, so no case is dropped.

Defined results: a null, empty or white-space text has an empty set and links with nothing; a text
with fewer words than the shingle size is one shingle; a null id stays null (its row links, but names
no class; a class with no id at all has a null component and is kept); repeated rows, ties and equal
texts fall in one class named by the smallest id; an empty table gives an empty result; other columns
are ignored. Very long texts are hashed in blocks, whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import hashing
from .common import BROADCAST_ROWS, beside, columns, discard, ship, written
from .graph import components

SHINGLE = 5
THRESHOLD = (75, 100)
WIDTH = 128
TREES = 10
LEAF = 4096
#: Shingles of the sets that one task compares, at most (but for two sets).
LEAF_ITEMS = 4_000_000
DEPTH = 6
#: Bytes of full sets, and rows with sketches, that may be broadcast; beyond it they are shuffled.
BROADCAST_BYTES, BROADCAST_SKETCHES = 16_000_000, 40_000
SLACK = 4 * (0.75 * 0.25 / WIDTH) ** 0.5
_RNG = np.random.default_rng(75)
_MUL = _RNG.integers(0, 2**32, WIDTH, dtype=np.uint64).astype(np.uint32) | np.uint32(1)
_XOR = _RNG.integers(0, 2**32, WIDTH, dtype=np.uint64).astype(np.uint32)
_WIDE_MUL = _RNG.integers(0, 2**63, WIDTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sketch(shingles: np.ndarray) -> np.ndarray:
    """``WIDTH`` minwise values of a non-empty set, 16 bits each."""
    high = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(WIDTH, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(high), 8192):
        np.minimum(least, ((high[None, at: at + 8192] ^ _XOR[:, None]) * _MUL[:, None]).min(axis=1), out=least)
    return (least ^ (least >> np.uint32(16))).astype(np.uint16)


def _choices(path: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The coordinates that the tree nodes ``path`` branch on: a first, a second, and whether the second is used."""
    first = (_tags(path, 1) % np.uint64(WIDTH)).astype(np.int64)
    second = (_tags(path, 2) % np.uint64(WIDTH)).astype(np.int64)
    return first, second, (_tags(path, 3) % np.uint64(3) == 0) & (first != second)


def roots(shingles: np.ndarray, trees: int) -> np.ndarray:
    """Children of the ``trees`` roots that a set goes to; their tokens are 64-bit minwise values, so that
    unrelated sets do not meet by chance however many there are."""
    tree = np.arange(trees, dtype=np.uint64)
    first, second, both = _choices(tree)
    tree, coordinate = np.concatenate([tree, tree[both]]), np.concatenate([first, second[both]])
    least = np.array([(shingles * _WIDE_MUL[c]).min() for c in coordinate])
    return hashing.mix(_tags(tree, 4) + least * np.uint64(0xD6E8FEB86659FD93) + coordinate.astype(np.uint64))


def _sets(column: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The shingle set of every row of a binary column."""
    for _, _, (_, _, h), counts in hashing.words_of_rows(column, hashing.SPACE):
        ends = np.cumsum(counts)
        for n, e in zip(counts, ends):
            yield hashing.distinct(hashing.shingles(h[e - n: e], size))


def _key(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _signatures(size: int, trees: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, n, sk, paths = [], [], [], []
            for s in _sets(batch.column(1), size):
                n.append(len(s))
                node.append(_key(s) if len(s) else None)
                sk.append(sketch(s).tobytes() if len(s) else None)
                paths.append(roots(s, trees).view(np.int64) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(node, pa.binary()), pa.array(n, pa.int64()), pa.array(sk, pa.binary()),
                 pa.array(paths, pa.list_(pa.int64()))], names=["doc_id", "text_key", "node", "n", "sketch", "paths"])
    return run


def _matrix(column: pa.Array) -> np.ndarray:
    _, offsets, data = column.buffers()
    first = np.frombuffer(offsets, np.int32)[column.offset]
    return np.frombuffer(data, np.uint16, len(column) * WIDTH, int(first)).reshape(-1, WIDTH)


def _tags(paths: np.ndarray, what: int) -> np.ndarray:
    return hashing.mix(paths * np.uint64(hashing.BASE) + np.uint64(what))


def _branch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Children of every row (path, id, sketch): ``(path, id)``."""
    for batch in batches:
        if not batch.num_rows:
            continue
        path, name, sk = batch.column(0).to_numpy().view(np.uint64), batch.column(1), _matrix(batch.column(2))
        rows = np.arange(batch.num_rows)
        first, second, both = _choices(path)
        for c, some in ((first, rows), (second[both], rows[both])):
            value = sk[some, c].astype(np.uint64) + (c.astype(np.uint64) << np.uint64(16))
            child = hashing.mix(_tags(path[some], 4) + value * np.uint64(0xD6E8FEB86659FD93))
            yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), name.take(pa.array(some))], names=["path", "id"])


def _agree(sk: np.ndarray, n: np.ndarray, i: np.ndarray, j: np.ndarray, part: float) -> np.ndarray:
    """Flags of the pairs that may reach the similarity ``part``."""
    small, large = np.minimum(n[i], n[j]), np.maximum(n[i], n[j])
    ok = small >= part * large - 1e-9
    at = np.flatnonzero(ok)
    for k in range(0, len(at), 4096):
        x = at[k: k + 4096]
        ok[x] = (sk[i[x]] == sk[j[x]]).mean(axis=1) >= part - SLACK
    return ok


def _by_group(work, names: list[str]):
    """Apply ``work`` to the rows of whole groups (rows come sorted by ``group``), a batch of groups at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            for columns_ in work(rows.combine_chunks()):
                yield pa.RecordBatch.from_arrays(columns_, names=names)

        open_rows = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch]) if open_rows is None else pa.concat_tables([open_rows, pa.Table.from_batches([batch])])
            group = rows["group"].to_numpy()
            cut = int(np.searchsorted(group, group[-1]))  # the last group may go on in the next batch
            if cut:
                yield from done(rows.slice(0, cut))
            open_rows = rows.slice(cut)
        if open_rows is not None and len(open_rows):
            yield from done(open_rows)
    return run


def _numbered(column: pa.ChunkedArray) -> np.ndarray:
    """Equal values as equal numbers."""
    return column.combine_chunks().dictionary_encode().indices.to_numpy()


def _open_sets(part: float):
    """Sets that may reach the similarity with a set of another component in their group: ``(group, node, label)``."""
    def work(table: pa.Table) -> Iterator[list]:
        group, label = table["group"].to_numpy(), _numbered(table["label"])
        n, sk = table["n"].to_numpy(), _matrix(table["sketch"].chunk(0))
        found = np.zeros(len(group), bool)
        for k in range(1, len(group)):
            i = np.flatnonzero(group[:-k] == group[k:])
            if not len(i):
                break
            i = i[label[i] != label[i + k]]
            i = i[_agree(sk, n, i, i + k, part)]
            found[i] = found[i + k] = True
        at = pa.array(np.flatnonzero(found))
        yield [table[c].chunk(0).take(at) for c in ("group", "node", "label")]
    return _by_group(work, ["group", "node", "label"])


def _linked(sets: list[np.ndarray], label: np.ndarray, least: int, scale: int) -> list[tuple[int, int]]:
    """Pairs that reach the similarity and join components, at most a spanning set of them. Exact: an inverted
    index counts what a set shares with all others; only sets outside the largest component ask it."""
    size = np.array([len(x) for x in sets])
    owner, start = np.repeat(np.arange(len(sets)), size), np.concatenate(([0], np.cumsum(size)))
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(code, kind="stable")
    posting, first = owner[order], np.concatenate(([0], np.cumsum(np.bincount(code))))
    root = list(range(len(sets)))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for head in np.unique(label):
        members = np.flatnonzero(label == head)
        for m in members[1:]:
            root[m] = members[0]
    main, links = np.bincount(label).argmax(), []
    for x in np.flatnonzero(label != main):
        c = code[start[x]: start[x + 1]]
        n = first[c + 1] - first[c]
        shared = np.bincount(posting[np.arange(n.sum()) + np.repeat(first[c] - (np.cumsum(n) - n), n)], minlength=len(sets))
        for y in np.flatnonzero(scale * shared >= least * (size[x] + size - shared)):
            p, q = top(int(x)), top(int(y))
            if p != q:
                root[p] = q
                links.append((int(x), int(y)))
    return links


def _links(threshold: tuple[int, int]):
    """Links across components among the full sets of each group."""
    def work(table: pa.Table) -> Iterator[list]:
        group, label, node = table["group"].to_numpy(), _numbered(table["label"]), table["node"].chunk(0)
        edge = np.concatenate(([0], np.flatnonzero(group[1:] != group[:-1]) + 1, [len(group)]))
        for a, b in zip(edge[:-1], edge[1:]):
            sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["items"].chunk(0).slice(a, b - a)]
            _, own = np.unique(label[a:b], return_inverse=True)
            pairs = np.array(_linked(sets, own, *threshold), np.int64).reshape(-1, 2) + a
            if len(pairs):
                yield [node.take(pa.array(pairs[:, 0])), node.take(pa.array(pairs[:, 1]))]
    return _by_group(work, ["x", "y"])


def _star_pairs(part: float):
    """Pairs of each row (node, n, sketch) with its group's pivot (three more columns)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            i = np.arange(batch.num_rows)
            sk = np.concatenate([_matrix(batch.column(2)), _matrix(batch.column(5))])
            n = np.concatenate([batch.column(1).to_numpy(), batch.column(4).to_numpy()])
            keep = pa.array(_agree(sk, n, i, i + batch.num_rows, part))
            yield pa.RecordBatch.from_arrays([batch.column(3).filter(keep), batch.column(0).filter(keep)], names=["a", "b"])
    return run


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _lookup(docs: DataFrame, reps: DataFrame, wanted: DataFrame, some: int, size: int) -> DataFrame:
    """``(node, items)`` with the full sets of the nodes ``wanted`` (``some`` rows), recomputed from one text each."""
    spark = docs.sparkSession
    wanted = wanted if some <= BROADCAST_ROWS else wanted.distinct()
    ids = written(spark, reps.join(beside(wanted, some), "node", "left_semi").select("doc_id", "node"), "wanted")
    some = ids.count()
    side = beside(ids.select("doc_id"), some)
    texts = docs.join(side, docs["doc_id"].eqNullSafe(side["doc_id"]), "left_semi")

    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(_sets(batch.column(1), size))
            yield pa.RecordBatch.from_arrays(
                [pa.array([_key(s) if len(s) else None for s in sets], pa.binary()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], names=["node", "items"])

    found = texts.mapInArrow(full, "node binary, items binary").join(beside(ids.select("node"), some), "node", "left_semi")
    sets = written(spark, found.groupBy("node").agg(F.first("items").alias("items")), "sets")
    discard(ids)
    return sets


def _confirm(docs: DataFrame, reps: DataFrame, pairs: DataFrame, size: int, threshold: tuple[int, int]) -> DataFrame:
    """The pairs whose full sets reach the similarity."""
    spark = docs.sparkSession
    pairs = written(spark, pairs, "candidates")
    some = pairs.count()
    sets = _lookup(docs, reps, pairs.select(F.col("a").alias("node")).union(pairs.select("b")), 2 * some, size)
    least, scale = threshold

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for p, q in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                s, t = np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64)
                both = len(s) + len(t) - len(hashing.distinct(np.concatenate([s, t])))
                good.append(scale * both >= least * (len(s) + len(t) - both))
            keep = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(keep), batch.column(1).filter(keep)], names=["a", "b"])

    heads = sets.join(beside(pairs.select(F.col("a").alias("node")), some), "node", "left_semi").select(F.col("node").alias("a"), F.col("items").alias("s"))
    if (heads.agg(F.sum(F.length("s"))).first()[0] or 0) <= BROADCAST_BYTES:
        heads = F.broadcast(heads)
    rows = sets.select(F.col("node").alias("b"), F.col("items").alias("t")).join(beside(pairs, some), "b").join(heads, "a")
    links = written(spark, rows.select("a", "b", "s", "t").mapInArrow(check, "a binary, b binary"), "links")
    discard(pairs, sets)
    return links


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    threshold: tuple[int, int] = THRESHOLD, trees: int = TREES, leaf: int = LEAF, depth: int = DEPTH) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``, and ``node``, which names the set,
    and ``text_key``, a hash of the text."""
    spark = docs.sparkSession
    ship(spark)
    part = threshold[0] / threshold[1]
    texts = columns(docs, F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"), F.xxhash64(text_col).alias("text_key"))
    rows = written(spark, texts.mapInArrow(
        _signatures(shingle, trees), "doc_id long, text_key long, node binary, n long, sketch binary, paths array<long>"), "signatures")
    reps = written(spark, rows.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("doc_id"), *[F.first(c).alias(c) for c in ("n", "sketch", "paths")]), "nodes")

    small, scratch = [], []
    labels = None  # of all sets that have a link so far
    # tree nodes hold short ids of sets; should two sets share one, both are compared, which costs only time
    short = reps.select(F.xxhash64("node").alias("id"), "node", "n", "sketch")
    frontier = reps.select(F.explode("paths").alias("path"), F.xxhash64("node").alias("id"))
    for level in range(depth):
        sizes = written(spark, frontier.groupBy("path").agg(F.count("*").alias("size")).where("size > 1"), "sizes")
        groups = sizes.count()
        grouped = written(spark, frontier.join(beside(sizes, groups), "path"), "level")  # ids only: sketches join what is compared
        labels = _joined(labels, _confirm(texts, reps, _stars(grouped, groups, short, part), shingle, threshold))
        held = written(spark, grouped.join(_labelled(short.select("id", "node", "n"), labels), "id").drop("id"), "held")
        of_label = held.groupBy("path", "label").agg(F.count("*").alias("own"), F.sum("n").alias("items"))
        main = of_label.groupBy("path").agg(F.max(F.struct("own", "label")).alias("main"), F.sum("items").alias("items"))
        main = written(spark, main.select("path", F.col("main.label").alias("main"), F.col("main.own").alias("own"), "items"), "main")
        mixed = held.join(beside(main, groups), "path").withColumn("others", F.col("size") - F.col("own")).where("others > 0")
        fits = (F.col("size") <= leaf) & ((F.col("items") <= LEAF_ITEMS) | (F.col("size") == 2))
        parts = F.greatest(F.ceil(F.col("size") / leaf), F.ceil(F.col("items") / LEAF_ITEMS)).cast("int")
        mixed = written(spark, mixed.select("path", "node", "label", "main", "size", "others", fits.alias("fits"), parts.alias("parts")), "mixed")
        discard(sizes, grouped, held, main)
        scratch.append(mixed)
        small.append(mixed.where("fits").select(F.col("path").alias("group"), "node"))
        few = F.col("others") <= leaf
        small.append(_against_others(mixed.where(~F.col("fits") & few)))
        large = mixed.where(~F.col("fits") & ~few)
        if large.isEmpty():
            break
        if level == depth - 1:
            small.append(_in_blocks(large))
            break
        frontier = large.select("path", "node").join(short, "node").select("path", "id", "sketch").mapInArrow(_branch, "path long, id long")
        frontier = written(spark, frontier, "frontier")
        scratch.append(frontier)

    labels = _joined(labels, _compared(texts, reps, _union(small).join(_labelled(reps.select("node", "n", "sketch"), labels), "node"), shingle, part, threshold))
    discard(*scratch)
    named = reps.select("node", "doc_id").join(beside(labels), "node", "left")
    least = written(spark, named.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("component_id")), "least")
    named = named.withColumn("label", F.coalesce("label", "node"))  # else all sets without a link would meet in one task
    classes = named.join(beside(least), "label", "left").select("node", F.coalesce("component_id", "doc_id").alias("component_id"))
    out = rows.select("doc_id", "text_key", "node", F.col("n").alias("n_shingles")).join(classes, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"), "node", "text_key")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, without all but one document of each class; of repeated rows (same
    id and text) one stays."""
    spark = docs.sparkSession
    classes = written(spark, near_duplicates(docs, id_col, text_col, **options).select("doc_id", "text_key", "kept"), "classes")
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text_col).alias("text_key"))

    def without(rows: DataFrame, keys: DataFrame) -> DataFrame:
        keys = beside(keys)
        return rows.join(keys, rows["doc_id"].eqNullSafe(keys["doc_id"]) & (rows["text_key"] == keys["text_key"]), "left_anti")

    gone = classes.where(~F.col("kept")).select("doc_id", "text_key").distinct()
    repeated = written(spark, classes.where("kept").groupBy("doc_id", "text_key").count().where("count > 1").drop("count"), "repeated")
    left = without(rows, gone)
    if repeated.isEmpty():
        return left.select("row.*")
    again = left.join(repeated, left["doc_id"].eqNullSafe(repeated["doc_id"]) & (left["text_key"] == repeated["text_key"]), "left_semi")
    return without(left, repeated).unionByName(again.dropDuplicates(["doc_id", "text_key"])).select("row.*")


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.union(f)
    return out


def _grouped(rows: DataFrame) -> DataFrame:
    """Rows of a group stand together."""
    return rows.repartition("group").sortWithinPartitions("group")


def _compared(docs: DataFrame, reps: DataFrame, rows: DataFrame, size: int, part: float, threshold: tuple[int, int]) -> DataFrame:
    """Links across components within groups: told by sketch which sets may have one, then by their full sets."""
    spark = docs.sparkSession
    rows = _grouped(rows.select("group", "node", "n", "sketch", "label"))
    open_ = written(spark, rows.mapInArrow(_open_sets(part), "group long, node binary, label binary"), "open")
    sets = _lookup(docs, reps, open_.select("node"), open_.count(), size)
    full = _grouped(open_.join(sets, "node").select("group", "node", "label", "items"))
    links = written(spark, _ordered(full.mapInArrow(_links(threshold), "x binary, y binary")), "links")
    discard(open_, sets)
    return links


def _joined(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """The labels after more links: components go on from those found before, not from all links again."""
    if labels is None:
        return components(links)
    if links.isEmpty():
        return labels
    after = components(labels.select(F.col("node").alias("a"), F.col("label").alias("b")).union(links.select("a", "b")))
    discard(labels)
    return after


def _labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(beside(labels), "node", "left").withColumn("label", F.coalesce("label", "node"))


def _stars(grouped: DataFrame, groups: int, short: DataFrame, part: float) -> DataFrame:
    """Every set of a group against the pivot of the group: the set that has most tokens in common with others.
    Groups of one origin have the same pivot, so their pairs are told apart before sketches are looked at."""
    score = F.sum("size").over(Window.partitionBy("id"))  # rows of an id: as many as the roots it goes to
    scored = grouped.select("path", F.struct(score.alias("score"), "id").alias("p"))
    pivot = written(grouped.sparkSession, scored.groupBy("path").agg(F.max("p").alias("p")).select("path", F.col("p.id").alias("pivot")), "pivots")
    # a pivot has the larger score, so no pair comes a second time the other way round
    heads = short.join(beside(pivot.select(F.col("pivot").alias("id")), groups), "id", "left_semi").toDF("pivot", "node0", "n0", "sketch0")
    heads = F.broadcast(heads) if groups <= BROADCAST_SKETCHES else heads
    pairs = grouped.join(beside(pivot, groups), "path").where("id <> pivot").select("id", "pivot").repartition("id").distinct()
    rows = pairs.join(short, "id").join(heads, "pivot")
    return rows.select("node", "n", "sketch", "node0", "n0", "sketch0").mapInArrow(_star_pairs(part), "a binary, b binary")


def _against_others(mixed: DataFrame) -> DataFrame:
    """Groups with a few sets outside their main component: those go to every part of the group."""
    own = F.pmod(F.xxhash64("node"), "parts").cast("int")
    where = F.when(F.col("label") == F.col("main"), F.array(own)).otherwise(F.sequence(F.lit(0), F.col("parts") - 1))
    return mixed.withColumn("part", F.explode(where)).select(F.xxhash64("path", "part").alias("group"), "node")


def _in_blocks(large: DataFrame) -> DataFrame:
    """Exact comparison, across components, of groups that stayed large: block against block."""
    rows = large.withColumn("blocks", F.col("parts") * 2)
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.select(F.xxhash64("path", F.least("mine", "other"), F.greatest("mine", "other")).alias("group"), "node")
