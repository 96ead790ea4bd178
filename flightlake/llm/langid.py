"""Language identification: averaged hashed subword embeddings with a linear softmax, trained by SGD in numpy.

A lower-cased text is cut at ASCII bytes that are no letters. Its subwords are the byte n-grams of 2 to 4 that
lie in one word (a separator may be their first or last byte, so beginnings and ends of words count), and
whole words; each is hashed to one of ``BUCKETS`` rows. The text's vector is the mean of the rows of all its
subwords, and a linear layer with softmax over the languages follows. ``TRAINERS`` tasks learn on their parts of a
bounded sample (``PER_LANGUAGE`` documents of a language, ``SAMPLE`` in all, smallest hash of the id first);
their logits are averaged. Another bounded sample (``CALIBRATION``) that no trainer sees fits a temperature, and a
threshold: predictions whose score reaches it are wrong at rate ``ERROR`` or less there. Below it they are
rejected (``accepted`` is false), but the most likely language is still told.

As the model is linear after hashing, a text is scored whole by adding one row of ``languages`` numbers per subword.
Driver: ``TRAINERS`` models and at most ``CALIBRATION`` rows of logits, whatever the input.

Defined results: a null text or one without any letter is ``und`` with score 0, not accepted; so is every text if no
language could be learned. Null ids and null languages teach nothing (a null id is not held out); repeated rows
are answered each; an empty table gives an empty result; other columns are never looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import hashing
from .common import columns, ship

BUCKETS = 1 << 16
DIM = 16
#: Documents that are learned from, at most, by language and in all, and documents that calibrate.
PER_LANGUAGE = 1_000
SAMPLE = 4_000
CALIBRATION = 2_000
#: Rows of a frequent language that are ranked, as a multiple of ``PER_LANGUAGE``.
SURPLUS = 4
TRAINERS = 4
EPOCHS = 6
RATE = 0.3
#: A text's vector is so many times the mean of its subwords' rows.
SCALE = 8.0
#: Accepted predictions are wrong at most this often on the calibration rows.
ERROR = 0.01
FOLDS = 5
UNKNOWN = "und"
#: Longer texts are counted by bucket, shorter ones scored together.
LONG = 1 << 16
GRAMS = (2, 3, 4)
_SEPARATOR = ~hashing.byte_class(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))


def held_out(id_col: Column) -> Column:
    """Rows that are never learned from."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def subwords(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every subword of a byte array that begins and ends with a separator, and the place of its second byte."""
    gap = _SEPARATOR[data]
    inner = np.concatenate(([0], np.cumsum(gap, dtype=np.int32)))
    h, where, at = data.astype(np.uint32), [], []
    for n in range(2, max(GRAMS) + 1):
        m = len(data) - n + 1
        if m < 1:
            break
        h = h[:m] * np.uint32(0x01000193) + data[n - 1:].astype(np.uint32) + np.uint32(n)
        whole = (inner[n - 1: n - 1 + m] == inner[1: 1 + m]) & ~(gap[:m] & gap[n - 1:] if n == 2 else np.zeros(m, bool))
        place = np.flatnonzero(whole)
        where.append((h[place] * np.uint32(0x9E3779B1)) >> np.uint32(16))
        at.append(place + 1)
    starts, _, word = hashing.words(data, _SEPARATOR)
    where.append((word >> np.uint64(40)).astype(np.uint32) % np.uint32(BUCKETS))
    at.append(starts)
    return np.concatenate(where).astype(np.int32), np.concatenate(at)


def _framed(rows: list[np.ndarray]) -> np.ndarray:
    gap = np.array([32], np.uint8)
    return np.concatenate([gap, *(x for r in rows for x in (r, gap))])


def counts_of(text: np.ndarray) -> np.ndarray:
    """How often each bucket occurs in a text of any length (blocks meet at a separator where there is one)."""
    total = np.zeros(BUCKETS, np.int64)
    a = 0
    while a < len(text):
        b = min(a + hashing.BLOCK, len(text))
        if b < len(text):
            back = np.flatnonzero(_SEPARATOR[text[a:b]])
            b = a + int(back[-1]) + 1 if len(back) else b
        total += np.bincount(subwords(_framed([text[a:b]]))[0], minlength=BUCKETS)
        a = b
    return total


def _sums(rows: list[np.ndarray], table: np.ndarray) -> np.ndarray:
    """For every text the mean of its subwords' rows of ``table`` (zeros without subwords)."""
    out = np.zeros((len(rows), table.shape[1]))
    short = []
    for i, r in enumerate(rows):
        if len(r) > LONG:
            n = counts_of(r)
            out[i] = n @ table / max(1, n.sum())
        else:
            short.append(i)
    for a, b in hashing.groups_of_rows([rows[i] for i in short], max(LONG, (1 << 22) // table.shape[1])):
        chosen = short[a:b]
        where, at = subwords(_framed([rows[i] for i in chosen]))
        limits = np.cumsum([1] + [len(rows[i]) + 1 for i in chosen])
        owner = np.searchsorted(limits, at, "right") - 1
        n = np.maximum(1, np.bincount(owner, minlength=len(chosen)))
        values = table[where]
        for k in range(table.shape[1]):
            out[chosen, k] = np.bincount(owner, values[:, k], len(chosen)) / n
    return out


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, languages = [], {}
    for batch in batches:
        for text, lang in zip(hashing.rows_of(batch.column(0)), batch.column(1).to_pylist()):
            n = counts_of(text)
            at = np.flatnonzero(n)
            if len(at):
                rows.append((at.astype(np.uint16), (SCALE * n[at] / n.sum()).astype(np.float32), languages.setdefault(lang, len(languages))))
    if not rows:
        return
    random = np.random.default_rng(0)
    table = random.uniform(-1, 1, (BUCKETS, DIM)).astype(np.float32)
    weights, bias = np.zeros((DIM, len(languages)), np.float32), np.zeros(len(languages), np.float32)
    steps = EPOCHS * len(rows)
    for step in range(steps):
        at, x, label = rows[step % len(rows)]
        hidden = x @ table[at]
        g = hidden @ weights + bias
        g = np.exp(g - g.max())
        g /= g.sum()
        g[label] -= 1
        rate = np.float32(RATE * (1 - step / steps))
        back = weights @ g
        weights -= rate * np.outer(hidden, g)
        bias -= rate * g
        table[at] -= (rate * np.sqrt(len(at)) * x)[:, None] * back
    yield pa.RecordBatch.from_arrays([pa.array([table.tobytes()], pa.binary()), pa.array([weights.tobytes()], pa.binary()),
                                      pa.array([bias.tobytes()], pa.binary()), pa.array([list(languages)], pa.list_(pa.string()))],
                                     names=["table", "weights", "bias", "languages"])


@dataclass
class Model:
    languages: list[str]
    #: logits of each bucket, with the factor of the text's vector
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    #: least score of an accepted prediction
    threshold: float = 0.0

    def logits(self, rows: list[np.ndarray]) -> np.ndarray:
        return _sums(rows, self.table) + self.bias

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def _averaged(parts: list) -> Model | None:
    languages = sorted({lang for p in parts for lang in p["languages"]})
    if not languages:
        return None
    table, bias = np.zeros((BUCKETS, len(languages))), np.zeros(len(languages))
    seen = np.zeros(len(languages))
    for p in sorted(parts, key=lambda p: bytes(p["bias"])):
        at = [languages.index(lang) for lang in p["languages"]]
        rows = np.frombuffer(p["table"], np.float32).reshape(BUCKETS, DIM).astype(float)
        table[:, at] += SCALE * rows @ np.frombuffer(p["weights"], np.float32).reshape(DIM, len(at))
        bias[at] += np.frombuffer(p["bias"], np.float32)
        seen[at] += 1
    return Model(languages, (table / seen).astype(np.float32), bias / seen)


def calibrate(model: Model, logits: np.ndarray, truth: np.ndarray) -> None:
    """Temperature of least log loss, then the least threshold at which accepted rows err at most ``ERROR``."""
    if not len(truth):
        return
    low, high = np.log(0.02), np.log(50.0)

    def loss(t: float) -> float:
        z = logits / np.exp(t)
        z = z - z.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(z).sum(axis=1)) - z[np.arange(len(truth)), truth]))

    golden = (5 ** 0.5 - 1) / 2
    for _ in range(60):  # the loss is convex in 1 / temperature, so it has one valley
        a, b = high - golden * (high - low), low + golden * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    model.temperature = float(np.exp((low + high) / 2))
    p = model.probabilities(logits)
    score, wrong = p.max(axis=1), p.argmax(axis=1) != truth
    order = np.argsort(-score, kind="stable")
    rate = np.cumsum(wrong[order]) / np.arange(1, len(order) + 1)
    last = np.append(score[order][1:] != score[order][:-1], True)  # equal scores are accepted together
    fine = np.flatnonzero((rate <= ERROR) & last)
    model.threshold = float(score[order][fine[-1]]) if len(fine) else 1.0


def _thinned(ids: DataFrame) -> DataFrame:
    """Of each frequent language only the smallest places, several times ``PER_LANGUAGE`` rows: its rank is
    then taken of a few thousand rows, however many the table has."""
    frequent = ids.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(SAMPLE).collect()  # a bounded list
    share = {r["lang"]: SURPLUS * PER_LANGUAGE / r["count"] for r in frequent if r["count"] > SURPLUS * PER_LANGUAGE}
    if not share:
        return ids
    of = F.create_map(*[F.lit(v) for item in share.items() for v in item])
    return ids.where((F.col("place") / F.lit(2.0 ** 64) + 0.5) < F.coalesce(F.try_element_at(of, "lang"), F.lit(2.0)))


def fit(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> Model | None:
    """The model of the bounded samples described above; None if there is nothing to learn from."""
    spark = docs.sparkSession
    ship(spark)
    known = columns(docs, F.col(id_col).alias("id"), F.col(lang_col).cast("string").alias("lang"), F.lower(text_col).cast("binary").alias("text"))
    known = known.where(F.col("id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("id")))
    ids = known.select("id", "lang", F.xxhash64("id").alias("place"), (F.pmod(F.xxhash64("id", F.lit(7)), F.lit(5)) == 0).alias("check"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "id"))
    chosen = _thinned(ids.where(~F.col("check"))).withColumn("rank", rank).where(F.col("rank") <= PER_LANGUAGE)
    chosen = chosen.orderBy("rank", "place", "id").limit(SAMPLE).select("id", "check").distinct()
    tested = ids.where("check").orderBy("place", "id").limit(CALIBRATION).select("id", "check").distinct()
    # at most SAMPLE and CALIBRATION ids
    dealt = known.join(F.broadcast(chosen), "id").withColumn("place", F.xxhash64("id", F.lit(1)))
    dealt = dealt.repartition(TRAINERS, F.pmod("place", F.lit(TRAINERS))).sortWithinPartitions("place", "lang")
    parts = dealt.select("text", "lang").mapInArrow(_train, "table binary, weights binary, bias binary, languages array<string>").collect()
    model = _averaged(parts)
    if model is None:
        return None
    sent, at = spark.sparkContext.broadcast(model), {lang: i for i, lang in enumerate(model.languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = sent.value.logits(list(hashing.rows_of(batch.column(0))))
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.list_(pa.float64())), batch.column(1)], names=["logits", "lang"])

    rows = known.join(F.broadcast(tested), "id").select("text", "lang").mapInArrow(run, "logits array<double>, lang string")
    rows = [r for r in rows.limit(2 * CALIBRATION).collect() if r["lang"] in at]  # repeated ids may give more rows
    calibrate(model, np.array([r["logits"] for r in rows]).reshape(len(rows), len(at)), np.array([at[r["lang"]] for r in rows], int))
    return model


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, held_out, lang_pred, score, accepted`` for every row."""
    spark = docs.sparkSession
    ship(spark)
    sent = spark.sparkContext.broadcast(model)
    has_letter = F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))
    rows = columns(docs, F.col(id_col).cast("long").alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), has_letter.alias("told"),
                   F.lower(text_col).cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for batch in batches:
            told = batch.column(2).to_numpy(zero_copy_only=False).astype(bool)
            lang, score = np.full(len(told), UNKNOWN, object), np.zeros(len(told))
            accepted = np.zeros(len(told), bool)
            if m is not None and len(told):
                p = m.probabilities(m.logits(list(hashing.rows_of(batch.column(3)))))
                best = np.array(m.languages, object)[p.argmax(axis=1)]
                lang, score = np.where(told, best, lang), np.where(told, p.max(axis=1), score)
                accepted = told & (score >= m.threshold)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lang, pa.string()), pa.array(score), pa.array(accepted)],
                                             names=["doc_id", "held_out", "lang_pred", "score", "accepted"])

    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double, accepted boolean")
