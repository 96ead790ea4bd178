"""Whitening against a direct eigendecomposition, and the factorisation by itself."""

import numpy as np
import pytest
from pyspark.sql import types as T

from flightlake.llm import whitening
from flightlake.llm.queries import queries

SMALL = "/root/testdata/sf0.001"
SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("x", T.StringType()), T.StructField("component", T.DoubleType()), T.StructField("n", T.LongType())])


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, "clash", 0.0, 7) for i, v in rows], SCHEMA)


def whitened(df, most=16):
    vectors = whitening.whole_vectors(df)
    return whitening.whiten(vectors, whitening.fit(vectors, most)).collect()


def direct(rows, most=16):
    """Per row: deviation, and per component the whitened value and the explained share, by numpy's eigh."""
    x = np.floor(64 * np.array([[float(np.float32(c)) for c in v] for _, v in rows])) + 1_000_000
    fitted = np.unique(x, axis=0)
    n, mean = len(fitted), fitted.mean(axis=0)
    e, q = np.linalg.eigh((fitted - mean).T @ (fitted - mean) / n)
    e, q = e[::-1][:most], q[:, ::-1][:, :most]
    sums = [int(s) for s in fitted.sum(axis=0)]
    return n, [sum((n * int(v) - s) ** 2 for v, s in zip(r, sums)) for r in x], (x - mean) @ q / np.sqrt(e), e / ((fitted - mean) ** 2).sum(axis=1).mean()


def compare(found, rows, most=16):
    n, deviations, values, explained = direct(rows, most)
    k = min(most, len(rows[0][1]))
    at = {}
    for r in found:
        at.setdefault(r.vec_id, {})[r.component] = r
    table = np.array([[at[i][c + 1].whitened for c in range(k)] for i, _ in rows])
    sign = np.sign((table * values).sum(axis=0))
    assert np.abs(table - values * sign).max() < 1e-8
    for (i, _), d in zip(rows, deviations):
        assert [r.deviation for r in at[i].values()] == [d] * k
        assert np.allclose([at[i][c + 1].explained for c in range(k)], explained, rtol=1e-9)
    assert {r.n for r in found} == {n} and len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-9


def test_factor_and_jacobi_equal_eigh():
    rng = np.random.default_rng(5)
    for d, rank in ((1, 1), (2, 2), (7, 7), (12, 5), (64, 64)):
        b = rng.normal(size=(d, rank)) * 10.0 ** rng.uniform(-3, 3, rank)
        a = b @ b.T
        factor = whitening.pivoted_cholesky(a)
        assert factor.shape[1] <= d and np.allclose(factor @ factor.T, a, rtol=1e-10, atol=1e-10 * a.max())
        values, vectors = whitening.one_sided_jacobi(factor)
        assert np.allclose(values[:rank], np.linalg.eigvalsh(a)[::-1][:len(values)][:rank], rtol=1e-8, atol=1e-12 * a.max())
        assert np.allclose(vectors.T @ vectors, np.eye(len(values)), atol=1e-10)
    assert whitening.pivoted_cholesky(np.zeros((3, 3))).shape == (3, 0)


def test_every_pair_meets_once():
    for r in (0, 1, 2, 5, 8):
        pairs = [(int(i), int(j)) for a, b in whitening._rounds(r) for i, j in zip(a, b)]
        assert sorted(pairs) == [(i, j) for i in range(r) for j in range(i + 1, r)]
        assert all(len(set(a) | set(b)) == 2 * len(a) for a, b in whitening._rounds(r))


def test_query_equals_eigh(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()]
    compare(queries()["op11_whitening"](spark, SMALL).collect(), rows)


def test_copies_are_fitted_once_and_odd_rows_take_no_part(spark):
    rng = np.random.default_rng(2)
    good = [(i, [float(c) for c in rng.normal(size=5) * [9, 4, 2, 1, 0.5]]) for i in range(80)]
    copies = [(100 + i, good[3][1]) for i in range(60)]
    bad = [(500, None), (501, []), (502, [1.0, None, 1.0, 1.0, 1.0]), (503, [float("nan")] * 5), (504, [float("inf"), 1.0, 1.0, 1.0, 1.0]),
           (505, [1.0, 2.0])]
    found = whitened(table_of(spark, good + copies + bad))
    assert {r.vec_id for r in found} == {i for i, _ in good + copies}
    compare(found, good + copies)


def test_repeated_rows_and_null_ids_are_answered_each(spark):
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, -1.0]), (2, [0.0, 0.5])]
    found = whitened(table_of(spark, rows))
    assert len(found) == 8 and sum(r.vec_id is None for r in found) == 2 and {r.n for r in found} == {3}


def test_components_without_variance_are_left_out(spark):
    rows = [(i, [float(i), 2.0 * i, 7.0]) for i in range(10)]
    found = whitened(table_of(spark, rows))
    assert {r.component for r in found} == {1} and abs(found[0].explained - 1) < 1e-12
    assert whitened(table_of(spark, [(i, [1.0, 2.0]) for i in range(4)])) == []
    assert whitened(table_of(spark, [])) == []


def test_deviations_are_exact_or_null():
    model = whitening.Whitening(3, [3 * 10**6, 3 * 10**6], np.eye(2), np.ones(2), np.ones(2))
    x = np.array([[10**6 + 2, 10**6 - 1], [10**6 + 900_000_001, 10**6], [float(2**52), 10**6]])
    assert model.deviations(x) == [45, (3 * 900_000_001) ** 2, None]


def test_huge_entries_are_bounded(spark):
    found = whitened(table_of(spark, [(1, [1e30, 1.0]), (2, [-1e30, 2.0]), (3, [0.5, 9.0])]))
    assert {r.vec_id for r in found} == {1, 2, 3}
