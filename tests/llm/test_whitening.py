"""Covariances by polarisation against exact fractions."""

from __future__ import annotations

import math
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import types as T

from ledgerflow.llm.whitening import whiten

SHAPE = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))]
    + [T.StructField(c, T.StringType()) for c in ("x", "n", "size", "place", "total", "whitened")]
)


def frame(spark, rows):
    return spark.createDataFrame([(*row, *"abcdef") for row in rows], SHAPE)


def brute(rows, size, components=4):
    """Integer rows, fit list, exact covariance and eigenvectors by plain loops."""
    good = [
        (k, [math.floor(256.0 * c) + 0 for c in v]) for k, v in rows
        if v is not None and len(v) == size and all(c is not None and math.isfinite(c) for c in v)
    ]
    fit = sorted({tuple(x) for _, x in good})
    n, sums = len(fit), [sum(x[d] for x in fit) for d in range(size)]
    cov = [[Fraction(sum((n * x[i] - sums[i]) * (n * x[j] - sums[j]) for x in fit), n**3)
            for j in range(size)] for i in range(size)]
    values, vectors = np.linalg.eigh(np.array([[float(c) for c in row] for row in cov]))
    return good, fit, n, sums, cov, values[::-1][:components], vectors[:, ::-1][:, :components]


def check(spark, rows, size):
    found = whiten(frame(spark, rows)).collect()
    good, fit, n, sums, cov, values, vectors = brute(rows, size)
    trace = float(sum(cov[d][d] for d in range(size)))
    by_row = defaultdict(list)
    for r in found:
        by_row[r.vec_id].append(r)
    assert len(found) == len(good) * min(4, size)
    signs = None
    for key, x in good:
        own = by_row[key]
        copies = len(own) // min(4, size)
        for r in own:
            k = r.component - 1
            assert r.n == n and copies >= 1
            exact = sum((n * v - s) ** 2 for v, s in zip(x, sums))
            assert (r.deviation if r.deviation is not None else int(r.deviation_digits)) == exact
            assert (r.deviation is None) == (exact >= 1 << 63) == (r.deviation_digits is not None)
            assert r.explained == pytest.approx(values[k] / trace, rel=1e-9)
    first = {r.vec_id: {} for r in found}
    for r in found:
        first[r.vec_id][r.component] = r.whitened
    table = np.array([[first[key][k + 1] for k in range(len(values))] for key, _ in good])
    centred = np.array([[float(Fraction(n * v - s, n)) for v, s in zip(x, sums)] for _, x in good])
    expected = centred @ vectors / np.sqrt(values)
    signs = np.sign((table * expected).sum(0))
    assert np.allclose(table, expected * signs, rtol=1e-7, atol=1e-9)
    assert 0 <= found[0].identity_error < 1e-9
    return found


def test_odd_vectors(spark):
    draw = np.random.default_rng(1)
    base = draw.standard_normal((300, 6)) @ draw.standard_normal((6, 6)) + 3
    rows = [(k, v.tolist()) for k, v in enumerate(base)]
    rows += [(1000 + k, rows[3][1]) for k in range(150)] + [rows[7], rows[7]]
    rows += [(None, base[5].tolist()), (2000, None), (2001, []), (2002, [1.0, None, 1, 1, 1, 1]),
             (2003, [math.nan] * 6), (2004, [math.inf] * 6), (2005, [1.0, 2.0]), (-3, [-0.001] * 6)]
    rows = [(k, None if v is None else [None if c is None else float(c) for c in v]) for k, v in rows]
    check(spark, rows, 6)


def test_large_entries_stay_exact(spark):
    """Sums of squares beyond 2^53 and 2^63, and deviations beyond a long."""
    draw = np.random.default_rng(2)
    for scale in (1e5, 1e9, 1e14):
        rows = [(k, v.tolist()) for k, v in enumerate(draw.standard_normal((80, 3)) * scale + 5 * scale)]
        check(spark, rows, 3)


def test_no_spread_and_no_rows(spark):
    one = whiten(frame(spark, [(k, [1.0, 2.0, 3.0]) for k in range(5)])).collect()
    assert len(one) == 15 and {r.n for r in one} == {1} and {r.deviation for r in one} == {0}
    assert {(r.whitened, r.explained, r.identity_error) for r in one} == {(None, None, None)}
    two = whiten(frame(spark, [(1, [1.0, 2.0, 3.0]), (2, [2.0, 2.0, 3.0])])).collect()
    assert sorted(r.component for r in two if r.whitened is not None) == [1, 1]
    assert sorted(abs(r.whitened) for r in two if r.component == 1) == pytest.approx([1.0, 1.0])
    assert [r.explained for r in two if r.component == 1] == [1.0, 1.0]
    assert whiten(frame(spark, [])).count() == 0
    assert whiten(frame(spark, [(1, None), (2, [])])).count() == 0
    assert whiten(frame(spark, [(1, [1e308, 1.0]), (2, [0.0, 1.0])])).count() == 4


def test_the_whole_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding")
    check(spark, [(r.vec_id, r.embedding) for r in rows.collect()], 64)
