"""Quality scores: hashed word n-gram logistic regression, trained by follow-the-regularised-leader.

A text is cut into words at white space. Each word gives a lower-cased hash and the hash of its
*shape* (letter case, digits, the punctuation it ends with). Features are word and shape n-grams
of one and two (an immediate repetition is one n-gram of its own), hashed into ``BUCKETS`` weights; each of the four families is spread over
``SPREAD``, so a feature's value is ``SPREAD * occurrences / n-grams`` and a score is a sparse dot
product. Labels are learned from a bounded sample (``SAMPLE`` rows, smallest hash of the id first)
dealt to ``TRAINERS`` tasks; each runs per-coordinate FTRL-proximal updates over its part and the
weights are averaged. What reaches the driver is ``TRAINERS`` weight vectors, whatever the input.

Defined results: a null or empty text has no features and gets the score of the bias; null labels
and null ids teach nothing (a null id is not held out); repeated rows are scored each; with no label
every score is 0.5; an empty table gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import hashing
from .common import columns, ship

BUCKETS = 1 << 18
#: Labelled rows that are learned from, at most.
SAMPLE = 16_000
TRAINERS = 4
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.3, 1.0, 0.002, 0.001
SPREAD = 8.0
FOLDS = 5
THRESHOLD = 0.3
_UP, _LOW = hashing.byte_class(bytes(range(65, 91))), hashing.byte_class(bytes(range(97, 123)))
_DIGIT = hashing.byte_class(bytes(range(48, 58)))
_MARK = ~(_UP | _LOW | _DIGIT | hashing.byte_class(bytes(range(128, 256))))
#: A word or shape that repeats the one before is one n-gram, whatever it is.
_SAME = [np.uint64(0x2545F4914F6CDD1D), np.uint64(0x9E6C63D0876A9A47)]


def held_out(id_col: Column) -> Column:
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def _shapes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    def count(flags: np.ndarray) -> np.ndarray:
        run = np.concatenate(([0], np.cumsum(flags[data], dtype=np.int32)))
        return run[ends] - run[starts]

    last = data[ends - 1]
    before = data[np.maximum(ends - 2, starts)]
    mark = np.where(_MARK[last], last, 0).astype(np.uint64)
    twice = (mark > 0) & (before == last) & (ends - starts > 1)
    up = count(_UP)
    shape = mark | (twice.astype(np.uint64) << np.uint64(8)) | (np.minimum(up, 2).astype(np.uint64) << np.uint64(9))
    shape |= (count(_LOW) > 0).astype(np.uint64) << np.uint64(11)
    shape |= (count(_DIGIT) > 0).astype(np.uint64) << np.uint64(12)
    shape |= (_MARK[data[starts]]).astype(np.uint64) << np.uint64(13)
    return hashing.mix(shape + np.uint64(0x5851F42D4C957F2D))


def features(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For every row: bucket of each n-gram occurrence and its value."""
    for _, data, (starts, ends, word), counts in hashing.words_of_rows(column, hashing.SPACE):
        shape = _shapes(data, starts, ends) if len(starts) else word
        limits = np.cumsum(counts)
        for n, e in zip(counts, limits):
            found = []
            for family, values in enumerate((word[e - n: e], shape[e - n: e])):
                found.append(values + np.uint64(family))
                pair = values[:-1] * np.uint64(hashing.BASE) + values[1:] + np.uint64(family + 2)
                found.append(np.where(values[:-1] == values[1:], _SAME[family], pair))
            where = [(hashing.mix(v) >> np.uint64(20)).astype(np.int64) % BUCKETS for v in found]
            value = [np.full(len(w), SPREAD / max(1, len(w)), np.float32) for w in where]
            yield np.concatenate(where), np.concatenate(value)


class Ftrl:
    """Per-coordinate FTRL-proximal logistic regression; the bias is the last coordinate."""

    def __init__(self) -> None:
        self.z, self.n = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)

    def weights(self, at: np.ndarray | slice) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -30, 30))) - label) * x
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
        self.n[at] = n + g * g


def _row(where: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at, back = np.unique(where, return_inverse=True)
    return np.append(at, BUCKETS), np.append(np.bincount(back, value, len(at)), 1.0)


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        for (where, value), label in zip(features(batch.column(0)), batch.column(1).to_pylist()):
            at, x = _row(where, value)
            rows.append((at.astype(np.int32), x.astype(np.float32), label))
    if rows:
        model = Ftrl()
        for _ in range(EPOCHS):
            for at, x, label in rows:
                model.learn(at, x, label)
        w = model.weights(slice(None)).astype(np.float32)
        yield pa.RecordBatch.from_arrays([pa.array([w.tobytes()], pa.binary()), pa.array([len(rows)], pa.int64())], names=["weights", "rows"])


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id", text_col: str = "text") -> np.ndarray:
    """Averaged weights from at most ``SAMPLE`` labelled rows that are not held out."""
    ship(docs.sparkSession)
    known = columns(labels, F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
    known = known.where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
    sample = F.broadcast(known.orderBy(F.xxhash64("id"), "label").limit(SAMPLE))  # at most SAMPLE ids and labels
    texts = columns(docs, F.col(id_col).alias("id"), F.col(text_col).cast("binary").alias("text")).join(sample, "id")
    dealt = texts.withColumn("place", F.xxhash64("id", F.lit(1))).repartition(TRAINERS, F.pmod("place", F.lit(TRAINERS)))
    dealt = dealt.sortWithinPartitions("place").select("text", "label")
    parts = dealt.mapInArrow(_train, "weights binary, rows long").collect()  # TRAINERS rows at most
    total = sum(p["rows"] for p in parts)
    if not total:
        return np.zeros(BUCKETS + 1, np.float32)
    return sum(np.frombuffer(p["weights"], np.float32) * (p["rows"] / total) for p in sorted(parts, key=lambda p: bytes(p["weights"]))).astype(np.float32)


def scores(column: pa.Array, weights: np.ndarray) -> np.ndarray:
    """Probability of label 1 for every row of a text column."""
    margin = [float(weights[where] @ value) for where, value in features(column)]
    return 1 / (1 + np.exp(-np.clip(np.array(margin, float) + float(weights[BUCKETS]), -30, 30)))


def score_quality(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = scores(batch.column(2), sent.value)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(s), pa.array((s >= THRESHOLD).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    rows = columns(docs, F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, weights: np.ndarray, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier does not reject."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(weights)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(scores(batch.column(at), sent.value) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
