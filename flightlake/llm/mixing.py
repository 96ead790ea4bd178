"""Mixing to target weights with soft domain membership, in DataFrame expressions only.

A classifier learned from a labelled table gives every document a posterior over the domains. A
nonnegative rate per document is then fitted so that the expected tokens of each domain,
``sum(rate * tokens * posterior)``, meet the targets: least squares by accelerated projected gradient from
rate 1 on, so documents of a domain that is short of its target go up and others down. ``most`` also bounds
rates from above (1: no document is repeated). ``keep`` names a domain whose sure documents (posterior of
``SURE`` at least) stay: their rates are 1 or more. Copies are drawn by rate alone, so the tokens of the drawn
mixture meet the fitted totals on average.

Classifier: one logistic regression per domain over a few document-level features (shares of capitals,
marks, digits and repeated words; how many words of each domain's own vocabulary occur), fitted by Newton
steps whose sums Spark aggregates over a bounded sample of labelled documents (``SAMPLE``, smallest hash
of the id first). The vocabularies hold the ``VOCABULARY`` most telling words of each domain.

Fit of the rates: all documents count. Posteriors are rounded to ``1 / STEPS``, and a document's rate
depends on its posterior alone, so documents are first summed up by posterior; each gradient step is then an
aggregate over that small table, and only one total per domain reaches the driver. A domain's miss is
scaled by the domain's own tokens, so that rare domains move as fast as large ones. The fit ends when
every target is met, or when rates stand still: the targets left cannot be met within the bounds, and a warning
says by how much (also after ``ROUNDS`` rounds).

Defined results: null and empty texts have 0 tokens and get the posterior of empty features; null labels and
null ids teach nothing; without labels all domains are equally likely; a domain without tokens cannot
be raised and is left out; repeated rows each get the same rate; an empty table gives an empty result;
other columns are ignored (``mix`` keeps them).
"""

from __future__ import annotations

import json
import warnings
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Labelled documents that the classifier is fitted on, at most.
SAMPLE = 12_000
VOCABULARY = 200
LEAST_DOCUMENTS = 5
#: Standard deviations by which a word must be more frequent in a domain than overall.
TELLING = 6.0
RIDGE, NEWTON = 1e-2, 8
STEPS = 1000
#: A target is met within this part of itself; the fit stands still if no domain moves by this part of its tokens.
ROUNDS, TOLERANCE, STILL = 400, 1e-4, 1e-5
#: Rows of decisions that may be broadcast; beyond it they are shuffled.
BROADCAST_ROWS = 200_000
#: Posterior, of the domain that is to be kept, from which on a document stays.
SURE = 0.9
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
FEATURES = ("capitals", "marks", "digits", "repeats")


@dataclass(frozen=True)
class Classifier:
    domains: list[str]
    words: list[list[str]]  # by domain
    weights: list[list[float]]  # by domain: bias, FEATURES, one per vocabulary


def with_words(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``_words``, the lower-cased words of the text, and ``_tokens``, how many."""
    low = F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit(""))), SEPARATORS, " "))
    docs = docs.withColumn("_words", F.split(low, " "))
    return docs.withColumn("_tokens", F.when(F.col("_words")[0] == "", 0).otherwise(F.size("_words")).cast("long"))


def _shape_features(text: Column) -> list[Column]:
    text = F.coalesce(text.cast("string"), F.lit(""))
    length = F.greatest(F.length(text), F.lit(1))

    def share(others: str) -> Column:
        return F.log1p(50 * F.length(F.regexp_replace(text, others, "")) / length)

    repeats = 1 - F.size(F.array_distinct("_words")) / F.greatest(F.size("_words"), F.lit(1))
    return [share("[^A-Z]+"), share(r"[^!*$%&#|~^<>{}=+_]+"), share("[^0-9]+"), repeats]


def _features(text: Column, words: list[list[str]]) -> Column:
    known = [F.log1p(F.size(F.array_intersect(F.array_distinct("_words"), F.lit(w) if w else F.array().cast("array<string>")))) for w in words]
    return F.array(*[c.cast("double") for c in (F.lit(1.0), *_shape_features(text), *known)])


def fit_classifier(docs: DataFrame, labels: DataFrame, domain: Column, domains: list[str], id_col: str = "doc_id", text_col: str = "text") -> Classifier:
    """``domain``: a string expression over the columns of ``labels``; other values teach nothing."""
    spark = docs.sparkSession
    known = labels.select(F.col(id_col).alias("_id"), domain.alias("_domain")).where(F.col("_id").isNotNull() & F.col("_domain").isin(domains))
    sample = F.broadcast(known.orderBy(F.xxhash64("_id"), "_domain").limit(SAMPLE))  # at most SAMPLE ids
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(sample, "_id")
    texts = written(spark, with_words(texts, "_text").select("_text", "_words", "_domain"), "labelled")
    total = {r["_domain"]: r["count"] for r in texts.groupBy("_domain").count().collect()}  # one row per domain
    words = _vocabularies(texts, domains, total)
    rows = written(spark, texts.select("_domain", _features(F.col("_text"), words).alias("x")), "features")
    size = 1 + len(FEATURES) + len(domains)
    weights = np.zeros((len(domains), size))
    present = [k for k, d in enumerate(domains) if total.get(d)]
    for _ in range(NEWTON if len(present) > 1 else 0):
        weights = _newton(rows, domains, weights, present)
    return Classifier(domains, words, weights.tolist())


def _vocabularies(texts: DataFrame, domains: list[str], total: dict[str, int]) -> list[list[str]]:
    """The words whose documents in a domain most exceed what their share overall would give."""
    each = texts.select("_domain", F.explode(F.array_distinct("_words")).alias("word")).where("word <> ''")
    counts = each.groupBy("word").agg(F.count("*").alias("all"), *[F.sum((F.col("_domain") == d).cast("long")).alias(f"n{k}") for k, d in enumerate(domains)])
    out = []
    for k, d in enumerate(domains):
        own, rest = total.get(d, 0), sum(n for e, n in total.items() if e != d)
        expected = F.col("all") * (own / max(1, own + rest))
        telling = (F.col(f"n{k}") - expected) / F.sqrt(expected + 1e-9)
        best = counts.where((F.col(f"n{k}") >= LEAST_DOCUMENTS) & (telling > TELLING)).orderBy(telling.desc(), "word").limit(VOCABULARY)
        out.append([r["word"] for r in best.select("word").collect()])  # VOCABULARY words
    return out


def _dot(a: Column, b: Column) -> Column:
    """Over arrays, so that new weights are new data and not new code to compile."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def _probability(weights: list[float]) -> Column:
    return _sigmoid(_dot(F.lit([float(w) for w in weights]), F.col("x")))


def _sigmoid(margin: Column) -> Column:
    return 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), margin))))


def _newton(rows: DataFrame, domains: list[str], weights: np.ndarray, present: list[int]) -> np.ndarray:
    """One Newton step of every domain's logistic regression, from sums over the sample."""
    size = weights.shape[1]
    w = F.lit([[float(v) for v in weights[k]] for k in present])
    y = F.array(*[(F.col("_domain") == domains[k]).cast("double") for k in present])
    terms = F.zip_with(w, y, lambda v, label: F.struct(_sigmoid(_dot(v, F.col("x"))).alias("p"), label.alias("y")))
    rows = rows.select("x", F.posexplode(terms).alias("domain", "t"))
    p, slope = F.col("t.p"), F.col("t.p") - F.col("t.y")
    curve = F.flatten(F.transform("x", lambda a: F.transform("x", lambda b: p * (1 - p) * a * b)))
    parts = rows.select("domain", F.posexplode(F.concat(F.transform("x", lambda a: slope * a), curve)).alias("at", "v"))
    sums = parts.groupBy("domain", "at").agg(F.sum("v").alias("v")).collect()  # domains * size * (size + 1) rows
    got = np.zeros((len(present), size + size * size))
    for r in sums:
        got[r["domain"], r["at"]] = r["v"]
    weights = weights.copy()
    for n, k in enumerate(present):
        gradient, hessian = got[n, :size], got[n, size:].reshape(size, size)
        weights[k] -= np.clip(np.linalg.solve(hessian + RIDGE * np.eye(size), gradient + RIDGE * weights[k]), -4, 4)
    return weights


def with_posteriors(docs: DataFrame, model: Classifier, text_col: str = "text") -> DataFrame:
    """Adds ``_tokens`` and ``_p``, the posteriors in units of ``1 / STEPS``, to all columns of ``docs``."""
    rows = with_words(docs, text_col)
    rows = rows.withColumn("x", _features(F.col(text_col), model.words)).drop("_words")
    each = F.array(*[_probability(w) for w in model.weights])
    rows = rows.withColumn("_each", each).drop("x")
    whole = F.aggregate("_each", F.lit(0.0), lambda a, p: a + p)
    return rows.withColumn("_p", F.transform("_each", lambda p: F.round(p / whole * STEPS).cast("int"))).drop("_each")


def fit_rates(rows: DataFrame, domains: list[str], targets: dict[str, float], most: float | None = None, keep: str | None = None) -> list[list[float]]:
    """The steps that lead from rate 1 to the fitted rates: for each a move by domain, and a momentum.

    ``targets``: each domain's weight of the mixture. The mixture is as large as it can be with the first
    domain of ``targets`` at its present size. Warns of targets that are not met."""
    spark = rows.sparkSession
    summed = written(spark, rows.groupBy("_p").agg(F.sum("_tokens").alias("_tokens")), "posteriors")
    k = len(domains)
    p = [F.col("_p")[i] / STEPS for i in range(k)]
    first = list(summed.agg(*[F.sum(F.col("_tokens") * p[i]) for i in range(k)]).first())
    if first[0] is None:
        return []
    own = np.array(first)
    base = domains.index(next(iter(targets)))
    wanted = np.array([targets.get(d, 0.0) for d in domains]) * own[base] / max(targets[domains[base]], 1e-9)
    there = own > 0
    scale = np.where(there, own, np.inf)
    near = np.where(there, TOLERANCE * np.where(wanted > 0, wanted, own), np.inf)
    sure = domains.index(keep) if keep is not None else None
    totals = [F.sum(F.col("_tokens") * c * p[i]) for c in (F.col("s.rate"), F.abs(F.col("s.rate") - F.col("s.was"))) for i in range(k)]
    steps: list[list[float]] = []
    now = ahead = own
    pace, last, still = 1.0, np.inf, False
    while (np.abs(now - wanted) > near).any() and not still and len(steps) < ROUNDS:
        # posteriors sum to 1, so in this scale the largest curvature is 1, and so is the step's length
        steps.append([*((ahead - wanted) / scale / STEPS).tolist(), 0.0])
        state = _state(steps, most, sure)
        sums = list(summed.select("_p", "_tokens", state.alias("s")).agg(*totals).first())
        then, moved = np.array(sums[:k]), np.array(sums[k:])
        still = bool((moved / scale).max() <= STILL)
        loss = float(((then - wanted) ** 2 / scale).sum())
        pace = 1.0 if loss > last else pace  # momentum that leads away is dropped
        after = (1 + np.sqrt(1 + 4 * pace * pace)) / 2
        steps[-1][-1] = float((pace - 1) / after)
        ahead = then + steps[-1][-1] * (then - now)
        now, pace, last = then, after, loss
    missed = np.flatnonzero(there & (np.abs(now - wanted) > near))
    if len(missed):
        why = "out of reach of the bounds (rates stand still)" if still else f"not met in {ROUNDS} rounds"
        warnings.warn(f"mixing targets {why}: " + ", ".join(f"{domains[i]} {now[i]:.6g} tokens for {wanted[i]:.6g}" for i in missed), RuntimeWarning, stacklevel=2)
    return steps


def _rate(steps: list[list[float]], most: float | None = None, sure: int | None = None) -> Column:
    """The fitted rate of a row with posterior ``_p``: all steps in turn. ``sure``: the place of the domain that is kept."""
    return _state(steps, most, sure)["rate"] if steps else F.lit(1.0)


def _state(steps: list[list[float]], most: float | None, sure: int | None) -> Column:
    """After all steps: ``rate``, ``ahead`` (where the next gradient is taken) and ``was`` (where the last one was).
    As SQL text: a round then costs a few calls to the JVM, and new steps are new data and not new code."""
    least = "0D" if sure is None else f"IF(_p[{sure}] >= {SURE * STEPS}, 1D, 0D)"
    down = f"greatest({least}, s.ahead - aggregate(zip_with(x, _p, (a, b) -> IF(b IS NULL, 0D, a * b)), 0D, (t, v) -> t + v))"
    down = f"least({float(most)}D, {down})" if most is not None else down
    one = f"transform(array({down}), r -> named_struct('rate', r, 'ahead', r + element_at(x, -1) * (r - s.rate), 'was', s.ahead))[0]"
    return F.expr(f"aggregate(from_json('{json.dumps(steps)}', 'array<array<double>>'), named_struct('rate', 1D, 'ahead', 1D, 'was', 1D), (s, x) -> {one})")


def with_rates(rows: DataFrame, steps: list[list[float]], most: float | None = None, id_col: str = "doc_id", sure: int | None = None) -> DataFrame:
    """Adds ``_rate`` and ``_copies``: the rate rounded up or down by a hash of the id, so that it holds on average."""
    rows = rows.withColumn("_rate", F.round(_rate(steps, most, sure=sure), 6))
    chance = F.pmod(F.xxhash64(F.col(id_col), F.lit("mix")), F.lit(1 << 20)) / F.lit(1 << 20)
    return rows.withColumn("_copies", F.floor(F.col("_rate") + chance).cast("int"))


def mixing_rates(docs: DataFrame, labels: DataFrame, domain: Column, targets: dict[str, float], most: float | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, p_<domain>..., rate, copies`` for every document. The first domain of ``targets`` is kept."""
    spark = docs.sparkSession
    domains = list(targets)
    model = fit_classifier(docs, labels, domain, domains, id_col, text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_text"))
    rows = written(spark, with_posteriors(rows, model, "_text").select("doc_id", "_tokens", "_p"), "memberships")
    rows = with_rates(rows, fit_rates(rows, domains, targets, most, domains[0]), most, sure=0)
    return rows.select("doc_id", F.col("_tokens").alias("n_tokens"), *[(F.col("_p")[i] / STEPS).alias(f"p_{d}") for i, d in enumerate(domains)],
                       F.col("_rate").alias("rate"), F.col("_copies").alias("copies"))


def mix(docs: DataFrame, labels: DataFrame, domain: Column, targets: dict[str, float], most: float | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, as often as their rate says. The first domain of ``targets`` is kept."""
    spark = docs.sparkSession
    domains = list(targets)
    model = fit_classifier(docs, labels, domain, domains, id_col, text_col)
    key = [F.col(id_col).cast("long").alias("_id"), F.xxhash64(text_col).alias("_text_key")]
    rows = with_posteriors(docs.select(*key, F.col(text_col).alias("_text")), model, "_text")
    rows = written(spark, rows.select("_id", "_text_key", "_tokens", "_p"), "memberships")
    rated = with_rates(rows, fit_rates(rows, domains, targets, most, domains[0]), most, "_id", sure=0)
    # only what does not simply stay is looked up; the same id and text have the same rate
    odd = written(spark, rated.where("_copies <> 1").select("_id", "_text_key", "_copies").distinct(), "copies")
    odd = F.broadcast(odd) if odd.count() <= BROADCAST_ROWS else odd
    packed = docs.select(F.struct(*docs.columns).alias("_row"), *key)
    same = packed["_id"].eqNullSafe(odd["_id"]) & (packed["_text_key"] == odd["_text_key"])
    drawn = packed.join(odd, same, "left").select("_row", F.coalesce("_copies", F.lit(1)).alias("_copies")).where("_copies > 0")
    return drawn.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).select("_row.*")
