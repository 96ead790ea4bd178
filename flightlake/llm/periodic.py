"""Periodic runs in word sequences: enhanced suffix array with the branching-tandem test.

A *run* is a stretch of words with smallest period ``q`` and at least ``2 * q`` words that no neighbouring
word extends keeping that period. Texts are cut into words at white space and each word gets a number that
is its own per document, so suffixes of different documents share no first symbol and one suffix array
serves a block of documents. The array is sorted by prefix doubling; the ranks of every doubling give the LCP of
neighbours. LCP intervals come as pairs of parts split at one LCP entry (found by nearest smaller entries). For
every suffix ``i`` of the smaller part, ``ISA[i + depth]`` or ``ISA[i - depth]`` in the other part means a
branching tandem repeat: a square whose next word breaks the period, the right end of a run. Rotating it to the
left gives the whole run; squares at one end whose root repeats a shorter one belong to that run and are merged into it.

Each document is one row of work: a narrow ``mapInArrow``, no shuffle; memory of a task is that of one block of
documents (1 MiB of text), or of one longer document (some 20 numbers a word and one a word and doubling).

Defined results: a null or empty text, or one of white space, has 0 words, no runs and an empty collapsed
text; null ids stay null; repeated rows are answered each; an empty table gives an empty result; other
columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import hashing
from .common import columns, ship

#: Words a run has at least.
LEAST = 12
#: Candidates that are looked up at once.
STEP = 1 << 20
RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
RESULT = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary"


def suffix_array(s: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The sorted suffixes, and for each doubling ``t`` ranks that are equal where the first ``2**t`` symbols are."""
    n = len(s)
    sa = np.argsort(s, kind="stable")
    new = np.append(True, s[sa[1:]] != s[sa[:-1]])
    rank = np.empty(n, np.int64)
    rank[sa] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels, k = [rank.astype(np.int32)], 1
    while True:
        open_ = np.flatnonzero(~(new & np.append(new[1:], True)))
        if not len(open_):
            return sa, levels
        suffix = sa[open_]
        follow = suffix + k
        key = rank[suffix] * (n + 1) + np.where(follow < n, rank[np.minimum(follow, n - 1)] + 1, 0)
        order = np.argsort(key, kind="stable")
        suffix, key = suffix[order], key[order]
        sa[open_] = suffix
        new[open_] = np.append(True, key[1:] != key[:-1])
        rank[suffix] = np.maximum.accumulate(np.where(new[open_], open_, 0))
        levels.append(rank.astype(np.int32))
        k *= 2


def neighbour_lcp(sa: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """LCP of each suffix with the one before it; -1 at the ends, so that every interval is closed there."""
    n = len(sa)
    lcp = np.zeros(n + 1, np.int64)
    lcp[0] = lcp[n] = -1
    at = 1 + np.flatnonzero(levels[0][sa[1:]] == levels[0][sa[:-1]])
    x, y, shared = sa[at - 1], sa[at], np.zeros(len(at), np.int64)
    for t in reversed(range(len(levels))):
        a, b = x + shared, y + shared
        inside = np.maximum(a, b) < n
        same = inside & (levels[t][np.where(inside, a, 0)] == levels[t][np.where(inside, b, 0)])
        shared[same] += 1 << t
    lcp[at] = shared
    return lcp


def _nearest_before(lcp: np.ndarray, equal: bool) -> np.ndarray:
    """For each entry the last one before it that is smaller (or equal), by pointer jumping."""
    link = np.arange(len(lcp)) - 1
    go = np.flatnonzero(lcp > 0)
    while len(go):
        there = lcp[link[go]]
        go = go[there > lcp[go] if equal else there >= lcp[go]]
        link[go] = link[link[go]]
    return link


def branching_squares(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and root length of every square that the word after it does not continue."""
    n = len(s)
    if n < 2:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    sa, levels = suffix_array(s)
    lcp = neighbour_lcp(sa, levels)
    del levels
    isa = np.empty(n, np.int64)
    isa[sa] = np.arange(n)
    split = np.flatnonzero(lcp > 0)
    depth = lcp[split]
    low = _nearest_before(lcp, False)[split]
    high = (len(lcp) - 1 - _nearest_before(lcp[::-1], True)[::-1])[split] - 1
    left = split - low <= high - split + 1  # the smaller part is [low, split), else [split, high]
    first, size = np.where(left, low, split), np.where(left, split - low, high - split + 1)
    other, last = np.where(left, split, low), np.where(left, high, split - 1)
    starts, roots = [], []
    ends = np.cumsum(size)
    a = 0
    while a < len(split):
        b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + STEP, "right")))
        count = size[a:b]
        node = np.repeat(np.arange(a, b), count)
        member = sa[first[node] + np.arange(len(node)) - np.repeat(np.cumsum(count) - count, count)]
        for there in (member + depth[node], member - depth[node]):
            inside = (there >= 0) & (there < n)
            rank = isa[np.where(inside, there, 0)]
            hit = inside & (rank >= other[node]) & (rank <= last[node])
            starts.append(np.minimum(member, there)[hit])
            roots.append(depth[node][hit])
        a = b
    return (np.concatenate(starts), np.concatenate(roots)) if starts else (split, depth)


def _rotations(s: np.ndarray, start: np.ndarray, root: np.ndarray) -> np.ndarray:
    """How many words to the left of each square go on with its period."""
    reach = np.zeros(len(start), np.int64)
    go, width = np.arange(len(start)), 8
    while len(go):
        kept = []
        each = max(1, STEP // width)
        for part in (go[i: i + each] for i in range(0, len(go), each)):
            at = (start[part] - 1 - reach[part])[:, None] - np.arange(width)
            same = (at >= 0) & (s[np.maximum(at, 0)] == s[np.maximum(at + root[part][:, None], 0)])
            whole = same.all(axis=1)
            reach[part] += np.where(whole, width, same.argmin(axis=1))
            kept.append(part[whole])
        go, width = np.concatenate(kept), min(width * 4, STEP)
    return reach


def runs_of(s: np.ndarray, least: int = LEAST) -> np.ndarray:
    """Rows ``start, length, period`` of all runs of at least ``least`` symbols, by start, then period."""
    start, root = branching_squares(s)
    end = start + 2 * root
    order = np.lexsort((root, end))
    end, root, found = end[order], root[order], []
    while len(end):
        lead = np.append(True, end[1:] != end[:-1])
        e, q = end[lead], root[lead]
        length = 2 * q + _rotations(s, e - 2 * q, q)
        found.append(np.stack([e - length, length, q], axis=1))
        mine = np.cumsum(lead) - 1
        rest = ~lead & ~((root % q[mine] == 0) & (2 * root <= length[mine]))
        end, root = end[rest], root[rest]
    if not found:
        return np.empty((0, 3), np.int64)
    runs = np.concatenate(found)
    runs = runs[runs[:, 1] >= least]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _numbers(words: list[list[bytes]]) -> np.ndarray:
    """The words of all documents as numbers; documents have none in common."""
    parts, base = [], 0
    for row in words:
        seen: dict[bytes, int] = {}
        parts.append(np.fromiter((seen.setdefault(w, len(seen)) for w in row), np.int64, len(row)) + base)
        base += len(seen)
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def _block(ids: pa.Array, texts: list[np.ndarray], least: int) -> pa.RecordBatch:
    words = [t.tobytes().split() for t in texts]  # at the six ASCII white-space bytes
    first = np.cumsum([0] + [len(w) for w in words])
    runs = runs_of(_numbers(words), least)
    change = np.zeros(first[-1] + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    kept = np.cumsum(change) == 0
    doc = np.searchsorted(first, runs[:, 0], "right") - 1
    each = np.searchsorted(doc, np.arange(len(words) + 1))
    collapsed = []
    for i, row in enumerate(words):
        if each[i] < each[i + 1]:
            row = [row[k] for k in np.flatnonzero(kept[first[i]: first[i + 1]])]
        collapsed.append(b" ".join(row))
    values = pa.StructArray.from_arrays([pa.array(runs[:, 0] - first[doc]), pa.array(runs[:, 1]), pa.array(runs[:, 2])], fields=list(RUNS.value_type))
    return pa.RecordBatch.from_arrays([ids, pa.array(np.diff(first)), pa.ListArray.from_arrays(pa.array(each.astype(np.int32)), values, type=RUNS),
                                       pa.array(collapsed, pa.binary())], names=["doc_id", "n_words", "runs", "collapsed"])


def find_runs(docs: DataFrame, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document ``doc_id, n_words, runs, collapsed``: the runs by start, then period, and the text without the
    words that any run contains after its first period, joined by one space (UTF-8 bytes)."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = list(hashing.rows_of(batch.column(1)))
            for a, b in hashing.groups_of_rows(texts):
                yield _block(batch.column(0).slice(a, b - a), texts[a:b], least)

    rows = columns(docs, F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, RESULT)


def digest(found: DataFrame) -> DataFrame:
    """Counts, the longest run (ties: smallest start, then period) and hashes of what ``find_runs`` returns."""
    runs = F.col("runs")
    line = F.transform(runs, lambda r: F.concat(r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n")))
    longest = F.array_max(F.transform(runs, lambda r: F.struct(r.length.alias("length"), (-r.start).alias("start"), (-r.period).alias("period"))))
    return (found.withColumn("longest", longest).select(
        "doc_id", F.size(runs).cast("long").alias("n_runs"), (-F.col("longest.start")).alias("start"), F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.floor(F.col("longest.length") * 1000 / -F.col("longest.period")).alias("exponent_milli"),
        F.sha2(F.array_join(line, "").cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256")))


def with_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Input whose every tenth text repeats: with ``h = crc32(id)``, ``g = h // 10`` and ``n`` words, where ``h % 10 = 0``
    each word ``i >= a`` is word ``a + (i - a) % p`` of the text, ``a = g % n`` and ``p = 1 + (n - a) // (3 + g % 8)``."""
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    words = F.regexp_extract_all(text_col, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    rows = columns(docs, F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"),
                   F.floor(h / 10).alias("g"), F.when(h % 10 == 0, words).alias("words")).withColumn("n", F.size("words"))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    rows = rows.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))

    def source(i: Column) -> Column:
        return F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))

    told = F.array_join(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get(F.col("words"), source(i))), " ")
    return rows.select("doc_id", F.when(F.col("n") > 0, told).otherwise(F.col("text")).alias("text"))
