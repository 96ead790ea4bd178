"""Benchmark passages in documents, up to edits: CGK embedding, bit-sampling LSH, exact edit check.

Texts become sequences of word hashes. The CGK walk reads a window of words with a pointer that stays
or advances by a random bit drawn from the step and the word it stands on, and writes down the word at
every step; words inserted, dropped or replaced shift two walks against each other only until they
meet again, so few edits mean a small Hamming distance of what is written. A sampling function keeps a
few steps of one walk; equal samples propose a candidate. ``WALKS`` random walks with ``SAMPLES``
functions each are the repetitions that reach the target recall.

Windows have a size fit for the shortest item of a size class (``WINDOWS``: least words of an item, words of a window).
Every window of an item and every window of a document goes in, so a long item has as many chances as
it has windows. Item keys are looked up while the document's walk goes on: a window whose samples so far
fit no item ends there. A candidate names an item and the place in the document where it would start;
there the item's edit distance to the best passage is computed exactly. An item counts as found with at
most ``EDITS`` of its words edited.

Items of fewer than ``SEEDED`` words have too few windows for that at the limit of edits. They are also cut into
one run of words more than they may have edits: one run at least is left whole, and its exact match proposes the
item, so every passage of such an item within the limit is proposed. Items of fewer than ``LEAST_WORDS`` words are one
such run: they count as found only whole and unedited.

In scripts that are written without spaces (Han, kana, Thai, Lao, Burmese, Khmer) each character is a word.

The benchmark is the small side: it is read in blocks of at most ``BLOCK_ITEMS`` items, and each block is
searched in all documents, so nothing grows without bound on the driver or in a broadcast.

Defined results: null texts, and texts or items without a word, match nothing; a null
document id is reported as null; repeated documents and repeated items are each reported; empty tables give
an empty result; other columns are ignored. Very long texts are searched whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing
from .common import columns, ship

EDITS = 0.25
#: UTF-8 of a character of the scripts without spaces.
_UNSPACED = re.compile(rb"([\xe3-\xe9][\x80-\xbf]{2}|\xe0[\xb8-\xbb][\x80-\xbf]|\xe1[\x80-\x82\x9e\x9f][\x80-\xbf]|\xf0[\xa0-\xb3][\x80-\xbf]{2})")
#: Size classes: least words of an item, words of a window.
WINDOWS = ((12, 9), (6, 5))
LEAST_WORDS = 6
#: Items below this many words are also proposed by exact runs.
SEEDED = 20
WALKS, SAMPLES, STEPS_KEPT = 4, 3, 6
BLOCK_ITEMS = 20_000
#: Windows that are walked at a time.
CHUNK = 1 << 16
_BITMAP_BITS = 20
SCHEMA = "doc_id long, item_id long, edits int, item_words int, first_word long, last_word long"


_ODD = np.random.default_rng(4).integers(0, 2**63, (WALKS, 4 * max(w for _, w in WINDOWS)), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def slack_of(words: int) -> int:
    """Words that may be edited in an item."""
    return int(EDITS * words) if words >= LEAST_WORDS else 0


def _words(column: pa.Array) -> Iterator[tuple]:
    """:func:`hashing.words_of_rows`, with the characters of unspaced scripts set apart."""
    rows = list(hashing.rows_of(column))
    for i, r in enumerate(rows):  # other rows stay views on the batch
        if len(r) and r.max() >= 0xE0 and _UNSPACED.search(memoryview(r)):
            rows[i] = np.frombuffer(_UNSPACED.sub(rb" \1 ", memoryview(r)), np.uint8)
    return hashing.words_of_views(rows, hashing.SEPARATOR)


def _advance(step: int, words: np.ndarray, walk: int) -> np.ndarray:
    """The walk's random bit for the words it stands on."""
    return (words * _ODD[walk, step]) >> np.uint64(63)


def _plan(window: int, seed: int) -> np.ndarray:
    """For each walk and function, the steps that are kept: one from each equal part of the walk."""
    rng = np.random.default_rng(1000 * window + seed)
    part = 2 * window / STEPS_KEPT
    low = (np.arange(STEPS_KEPT) * part).astype(int)
    high = ((np.arange(STEPS_KEPT) + 1) * part).astype(int)
    return rng.integers(low, high, (WALKS, SAMPLES, STEPS_KEPT))


@dataclass(frozen=True)
class Keys:
    """One size class: for each (walk, function, samples so far) a bitmap of the items' prefixes, and
    for whole samples the sorted keys with item and word offset."""

    window: int
    plan: np.ndarray
    bitmaps: dict
    whole: dict


@dataclass(frozen=True)
class Index:
    items: list
    ids: list
    classes: list
    seeds: dict  # by words of a run: bitmap of keys, sorted keys with item and word offset


def _walk(words: np.ndarray, starts: np.ndarray, window: int, walk: int, plan: np.ndarray, alive):
    """Sample keys of the windows at ``starts``: yields ``(function, starts, keys)``. ``alive(function,
    samples, keys)`` flags prefixes worth going on with (None: all). ``words`` ends in padding."""
    kept = plan.shape[1]
    at, moved = starts, np.zeros(len(starts), np.int64)
    keys = np.full((len(plan), len(starts)), 0x1234567, np.uint64)
    live = np.ones((len(plan), len(starts)), bool)
    taken = [0] * len(plan)
    for step in range(int(plan.max()) + 1):
        here = words[at + moved]
        pruned = False
        for f in range(len(plan)):
            if taken[f] < kept and plan[f, taken[f]] == step:
                keys[f] = hashing.mix(keys[f] * np.uint64(hashing.BASE) + here)
                taken[f] += 1
                if alive is not None:
                    live[f] &= alive(f, taken[f], keys[f])
                    pruned = True
                if taken[f] == kept:
                    good = live[f]
                    yield f, at[good], keys[f][good]
                    live[f] = False
        if pruned or not live.any():
            some = live.any(axis=0)
            if not some.any():
                return
            if some.sum() < 0.7 * len(at):
                at, moved, here, keys, live = at[some], moved[some], here[some], keys[:, some], live[:, some]
        moved = np.minimum(moved + _advance(step, here, walk).astype(np.int64), window)


def _padded(words: np.ndarray, window: int) -> np.ndarray:
    return np.concatenate([words, np.zeros(window + 1, np.uint64)])


def _bits(keys: np.ndarray) -> np.ndarray:
    return (keys >> np.uint64(64 - _BITMAP_BITS)).astype(np.int64)


def _prefixes(found: dict):
    def note(walk: int):
        def alive(f: int, n: int, keys: np.ndarray) -> np.ndarray:
            found.setdefault((walk, f, n), []).append(keys.copy())
            return np.ones(len(keys), bool)
        return alive
    return note


def build_index(items: list[tuple[int, np.ndarray]]) -> Index:
    """Keys of all windows of the items (id, word hashes)."""
    classes = []
    for i, (least, window) in enumerate(WINDOWS):
        upper = WINDOWS[i - 1][0] if i else np.inf
        own = [k for k, (_, w) in enumerate(items) if max(least, LEAST_WORDS) <= len(w) < upper]
        if not own:
            continue
        plan, seen, whole = _plan(window, 0), {}, {}
        note = _prefixes(seen)
        for k in own:
            words = items[k][1]
            for walk in range(WALKS):
                starts = np.arange(len(words) - window + 1)
                for f, at, keys in _walk(_padded(words, window), starts, window, walk, plan[walk], note(walk)):
                    whole.setdefault((walk, f), []).append((keys, np.full(len(at), k), at))
        bitmaps = {}
        for name, keys in seen.items():
            flags = np.zeros(1 << _BITMAP_BITS, bool)
            flags[_bits(np.concatenate(keys))] = True
            bitmaps[name] = np.packbits(flags)
        tables = {}
        for name, parts in whole.items():
            keys, item, offset = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(keys, kind="stable")
            tables[name] = (keys[order], item[order], offset[order])
        classes.append(Keys(window, plan, bitmaps, tables))
    return Index([w for _, w in items], [i for i, _ in items], classes, _seeds(items))


def _seeds(items: list[tuple[int, np.ndarray]]) -> dict:
    """Runs of the items below ``SEEDED`` words, of which as many edits as they may have leave one whole."""
    runs: dict[int, list] = {}
    for k, (_, words) in enumerate(items):
        if 0 < len(words) < SEEDED:
            parts = slack_of(len(words)) + 1
            cuts = [i * len(words) // parts for i in range(parts + 1)]
            for a, b in zip(cuts, cuts[1:]):
                runs.setdefault(b - a, []).append((hashing.shingles(words[a:b], b - a)[0], k, a))
    out = {}
    for size, found in runs.items():
        keys, item, offset = np.array([f[0] for f in found], np.uint64), np.array([f[1] for f in found]), np.array([f[2] for f in found])
        order = np.argsort(keys, kind="stable")
        flags = np.zeros(1 << _BITMAP_BITS, bool)
        flags[_bits(keys)] = True
        out[size] = (np.packbits(flags), keys[order], item[order], offset[order])
    return out


def _candidates(words: np.ndarray, ends: np.ndarray, index: Index, unpacked: list) -> set[tuple[int, int]]:
    """(item, start in ``words``) proposed for a run of documents' words (each ended by padding)."""
    found: set[tuple[int, int]] = set()
    real = np.flatnonzero(words)
    for size, (bitmap, table, item, offset) in index.seeds.items():
        keys = hashing.shingles(words, size)
        starts = real[real < len(keys)]
        bits = _bits(keys[starts])
        starts = starts[(bitmap[bits >> 3] >> (7 - (bits & 7)).astype(np.uint8)) & 1 == 1]
        low, high = np.searchsorted(table, keys[starts], "left"), np.searchsorted(table, keys[starts], "right")
        hit = np.flatnonzero(high > low)
        for s, lo, hi in zip(starts[hit].tolist(), low[hit].tolist(), high[hit].tolist()):
            found.update(zip(item[lo:hi].tolist(), (s - offset[lo:hi]).tolist()))
    for keys_of, maps in zip(index.classes, unpacked):
        padded = _padded(words, keys_of.window)
        for a in range(0, len(real), CHUNK):
            starts = real[a: a + CHUNK]
            for walk in range(WALKS):
                def alive(f, n, keys, walk=walk, maps=maps):
                    return maps[walk, f, n][_bits(keys)]

                for f, at, keys in _walk(padded, starts, keys_of.window, walk, keys_of.plan[walk], alive):
                    if not len(at):
                        continue
                    table, item, offset = keys_of.whole[walk, f]
                    low, high = np.searchsorted(table, keys, "left"), np.searchsorted(table, keys, "right")
                    hit = np.flatnonzero(high > low)
                    for s, lo, hi in zip(at[hit].tolist(), low[hit].tolist(), high[hit].tolist()):
                        found.update(zip(item[lo:hi].tolist(), (s - offset[lo:hi]).tolist()))
    return found


def _shared(item: np.ndarray, text: np.ndarray) -> int:
    """How many of the item's words occur in the text."""
    there = np.sort(text)
    return int((there[np.minimum(np.searchsorted(there, item), len(there) - 1)] == item).sum())


def passage_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """Least word edits between the item and any passage of the text; the passage's start and end."""
    n, m = len(item), len(text)
    ramp = np.arange(m + 1)
    cost, begin = np.zeros(m + 1, np.int64), ramp.copy()
    for i in range(n):
        across = np.concatenate(([i + 1], cost[:-1] + (text != item[i])))
        down = cost + 1
        take = np.concatenate(([True], across[1:] <= down[1:]))
        best = np.where(take, across, down)
        start = np.where(take, np.concatenate(([0], begin[:-1])), begin)
        flat = (best - ramp) * (m + 2) + ramp  # an insertion costs one per word: carried along by a running least
        least = np.minimum.accumulate(flat)
        cost, begin = least // (m + 2) + ramp, start[least % (m + 2)]
    end = int(np.argmin(cost))
    return int(cost[end]), int(begin[end]), end


def _search(words: np.ndarray, counts: np.ndarray, index: Index, unpacked: list) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, item, edits, first word, last word) of the best passage of each found item, for rows whose words are concatenated."""
    gap = max((len(w) for w in index.items), default=0) + max((k.window for k in index.classes), default=0) + 1
    ends = np.cumsum(counts)
    begins = ends - counts
    at = begins + gap * np.arange(len(counts))
    spaced = np.zeros(int(ends[-1]) + gap * len(counts), np.uint64)
    row_of = np.repeat(np.arange(len(counts)), counts)
    spaced[np.arange(len(words)) + gap * row_of] = words
    best: dict[tuple[int, int], tuple[int, int, int]] = {}
    regions: dict[tuple[int, int], list[int]] = {}
    for item, start in _candidates(spaced, ends, index, unpacked):
        # an item may begin before the row's first word (its head edited away); the row holds its window
        row = int(np.searchsorted(at, min(max(start + len(index.items[item]) // 2, 0), len(spaced) - 1), "right")) - 1
        near = {row} | {int(np.searchsorted(at, max(x, 0), "right")) - 1 for x in (start, start + len(index.items[item]) - 1)}
        for r in near:
            regions.setdefault((r, item), []).append(start - int(at[r]))
    for (row, item), places in regions.items():
        own, n = index.items[item], len(index.items[item])
        slack = slack_of(n)
        text = words[begins[row]: ends[row]]
        done = -1
        for place in sorted(places):
            if place <= done:
                continue
            low, high = max(0, place - slack), max(0, min(len(text), place + n + 2 * slack))
            done = place + slack // 2 if slack else place
            if high - low < n - slack or _shared(own, text[low:high]) < n - slack:
                continue
            edits, a, b = passage_distance(own, text[low:high])
            if edits <= slack and (edits, a + low) < best.get((row, item), (n + 1, 0, 0))[:2]:
                best[row, item] = (edits, a + low, b + low - 1)
                if not edits:  # the first unedited place: every later one starts later
                    break
    for (row, item), (edits, a, b) in sorted(best.items()):
        yield row, item, edits, a, b


def _unpacked(index: Index) -> list:
    return [{name: np.unpackbits(m).astype(bool) for name, m in k.bitmaps.items()} for k in index.classes]


def _found(column: pa.Array, index: Index, unpacked: list) -> Iterator[tuple[int, int, int, int, int]]:
    if index.classes or index.seeds:
        for first, _, (_, _, h), counts in _words(column):
            if len(h):
                for row, *rest in _search(h, counts, index, unpacked):
                    yield first + row, *rest


def _blocks(benchmark: DataFrame, id_col: str, text_col: str) -> Iterator[Index]:
    """Indexes of the benchmark, ``BLOCK_ITEMS`` items at most in each."""
    items = columns(benchmark, F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("binary").alias("text")).where("text is not null")
    count = items.count()
    parts = -(-count // (BLOCK_ITEMS // 2)) if count > BLOCK_ITEMS else 1
    for part in range(parts):
        mine = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part) if parts > 1 else items
        rows = mine.orderBy("item_id", "text").collect()  # a block of the benchmark: bounded by BLOCK_ITEMS
        column = pa.array([bytes(r["text"]) for r in rows], pa.binary())
        words = [h[e - n: e] for _, _, (_, _, h), c in _words(column) for n, e in zip(c, np.cumsum(c))]
        yield build_index([(r["item_id"], w) for r, w in zip(rows, words)])


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document and item found in it: the best passage, its edits and place in words."""
    spark = docs.sparkSession
    ship(spark)
    texts = columns(docs, F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    out = None
    for index in _blocks(benchmark, item_col, item_text_col):
        sent = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index, unpacked = sent.value, _unpacked(sent.value)
            for batch in batches:
                found = list(_found(batch.column(1), index, unpacked))
                rows, item, edits, a, b = (list(x) for x in zip(*found)) if found else ([],) * 5
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(rows, pa.int64())), pa.array([index.ids[i] for i in item], pa.int64()),
                     pa.array(edits, pa.int32()), pa.array([len(index.items[i]) for i in item], pa.int32()),
                     pa.array(a, pa.int64()), pa.array(b, pa.int64())],
                    names=["doc_id", "item_id", "edits", "item_words", "first_word", "last_word"])

        part = texts.mapInArrow(run, SCHEMA)
        out = part if out is None else out.union(part)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, in which no item is found."""
    spark = docs.sparkSession
    ship(spark)
    at = docs.columns.index(text_col)
    for index in _blocks(benchmark, item_col, item_text_col):
        sent = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            index, unpacked = sent.value, _unpacked(sent.value)
            for batch in batches:
                clean = np.ones(batch.num_rows, bool)
                clean[[row for row, *_ in _found(batch.column(at), index, unpacked)]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
