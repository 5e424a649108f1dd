"""Exact top-k and cap filters against brute force."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import types as T

from ledgerflow.llm.cap_dedup import cap, list_decode, near_duplicates
from ledgerflow.llm.vector_topk import Approximation, top_scores

SHAPE = T.StructType(
    [T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
     T.StructField("label", T.IntegerType()), T.StructField("bucket", T.StringType()),
     T.StructField("dim", T.StringType()), T.StructField("id", T.StringType())]
)


def frame(spark, rows):
    return spark.createDataFrame([(*row, "x", None, "y") for row in rows], SHAPE)


def odd_rows(seed=0, count=240, size=8):
    """Near copies, exact copies, ties, repeated rows and every kind of unusable vector."""
    draw = np.random.default_rng(seed)
    rows = []
    for k in range(count):
        x = draw.standard_normal(size)
        if k % 3 == 1:
            x = np.array(rows[-1][1]) + draw.standard_normal(size) * 0.05
        elif k % 7 == 2:
            x = np.array(rows[max(0, k - 9)][1])
        rows.append((k, [float(np.float32(v)) for v in x], k % 4))
    rows.append(rows[20])
    rows += [
        (1000, None, 1), (1001, [], 1), (1002, [0.0] * size, 1), (1003, [1.0] * (size - 1) + [None], 1),
        (1004, [math.nan] * size, 1), (1005, [math.inf] * size, 1), (1006, rows[5][1], None),
        (None, rows[5][1], 1), (1008, [1.0, 2.0], 1), (1020, [2.0, 4.0], 1), (-40, rows[0][1], 0),
    ]
    return rows


def usable(row):
    x = row[1]
    return row[0] is not None and x is not None and all(v is not None and math.isfinite(v) for v in x)


def brute_top(rows, k, step):
    chosen = [(r[0], [math.floor(64.0 * v) for v in r[1]]) for r in rows if usable(r)]
    out = set()
    for q, x in chosen:
        if q % step:
            continue
        scores = sorted(
            (-sum(a * b for a, b in zip(x, y)), c) for c, y in chosen if c != q and len(x) == len(y)
        )
        out |= {(q, n + 1, c, -s) for n, (s, c) in enumerate(scores[:k])}
    return out


def test_top_scores_agree_with_brute_force(spark):
    rows = odd_rows()
    found = top_scores(frame(spark, rows), k=5, step=20)
    assert {tuple(r) for r in found.collect()} == brute_top(rows, 5, 20)
    assert [f.dataType.simpleString() for f in found.schema] == ["bigint", "int", "bigint", "bigint"]


@pytest.mark.parametrize("scale", [3e4, 1e8, 1e17, 1e300, 8e306])
def test_scores_of_large_components_are_exact(spark, scale):
    """Beyond 2^20, beyond what doubles and longs hold, and beyond 64 x as a double."""
    draw = np.random.default_rng(5)
    rows = [(k, [float(v) for v in draw.standard_normal(6) * scale], 0) for k in range(40)]
    rows += [(100 + k, [float(v) for v in draw.standard_normal(6)], 0) for k in range(40)]
    shape = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.DoubleType()))])
    found = {tuple(r) for r in top_scores(spark.createDataFrame([r[:2] for r in rows], shape), k=7, step=20).collect()}
    whole = {k: [math.floor(64.0 * v) if abs(v) < 2.0**56 else 64 * int(v) for v in x] for k, x, _ in rows}
    wanted = set()
    for q in (k for k in whole if k % 20 == 0):
        best = []
        for c in whole:
            score = sum(a * b for a, b in zip(whole[q], whole[c]))
            best.append((-min(max(score, -(2**63 - 1)), 2**63 - 1), c))
        wanted |= {(q, n + 1, c, -s) for n, (s, c) in enumerate(sorted(b for b in best if b[1] != q)[:7])}
    assert found == wanted


def test_queries_and_candidates_over_many_blocks(spark, monkeypatch):
    from ledgerflow.llm import vector_topk

    monkeypatch.setattr(vector_topk, "VECTOR_BLOCK", 64)
    rows = odd_rows(seed=9, count=700)
    found = top_scores(frame(spark, rows), k=6, step=5)
    assert {tuple(r) for r in found.collect()} == brute_top(rows, 6, 5)


def test_fewer_candidates_than_asked_for_and_no_rows(spark):
    few = [(0, [1.0, 2.0], 0), (7, [1.0, 1.0], 0)]
    assert {tuple(r) for r in top_scores(frame(spark, few)).collect()} == {(0, 1, 7, 64 * 64 * 3)}
    assert top_scores(frame(spark, [])).count() == 0


def test_cells_bound_every_inner_product():
    draw = np.random.default_rng(3)
    exact = np.floor(64 * draw.standard_normal((500, 16)))
    queries = exact[:40]
    upper, lower = Approximation.of(exact).bounds(queries)
    score = queries @ exact.T
    assert (lower <= score).all() and (score <= upper).all() and (upper - lower).mean() > 0


def brute_links(rows):
    good = [
        k for k, r in enumerate(rows)
        if usable(r) and r[2] is not None and any(v != 0 for v in r[1])
    ]
    linked = {k: set() for k in range(len(rows))}
    for a in good:
        for b in good:
            if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1]), np.array(rows[b][1])
                if x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= 0.98:
                    linked[a].add(b)
                    linked[b].add(a)
    out = []
    for k, row in enumerate(rows):
        reach, todo = {k}, [k]
        while todo:
            fresh = linked[todo.pop()] - reach
            reach |= fresh
            todo += fresh
        least = min((rows[j][0] for j in reach if rows[j][0] is not None), default=None)
        out.append((row[0], len(linked[k]), least, row[0] is None or row[0] == least))
    return sorted(out, key=repr)


def test_near_duplicates_agree_with_brute_force(spark):
    rows = odd_rows(seed=2)
    found = sorted((tuple(r) for r in near_duplicates(frame(spark, rows)).collect()), key=repr)
    assert found == brute_links(rows)


def test_near_duplicates_of_nothing(spark):
    assert near_duplicates(frame(spark, [])).count() == 0


def test_a_large_group_of_near_copies_is_compared_in_blocks(spark):
    """1500 vectors of one cap: more than a block, and every pair linked."""
    draw = np.random.default_rng(4)
    base = draw.standard_normal(16)
    rows = [(k, (base + draw.standard_normal(16) * 0.01).tolist(), 0) for k in range(1500)]
    found = near_duplicates(frame(spark, rows)).collect()
    assert {(r.n_links, r.component_id) for r in found} == {(1499, 0)}


@pytest.mark.parametrize("cosine, size", [(0.98, 64), (0.99, 64), (0.98, 384), (0.98, 20), (0.98, 8), (0.98, 3)])
def test_few_pairs_at_the_threshold_share_no_filter(cosine, size):
    draw = np.random.default_rng(1)
    x = draw.standard_normal((400, size))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = draw.standard_normal((400, size))
    z -= (z * x).sum(axis=1, keepdims=True) * x
    z /= np.linalg.norm(z, axis=1, keepdims=True)
    lists = []
    for one in (x, cosine * x + math.sqrt(1 - cosine**2) * z):
        rows, filters = list_decode(one)
        lists.append(set(zip(rows.tolist(), filters.tolist())))
    assert len({row for row, _ in lists[0] & lists[1]}) >= 0.98 * 400


def test_list_decoding_finds_what_trying_every_pair_finds():
    from ledgerflow.llm.cap_dedup import WORDS, product_codes

    x = np.random.default_rng(6).standard_normal((5, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    found = set(zip(*(a.tolist() for a in list_decode(x))))
    every = set()
    for code, (rotation, first, second) in enumerate(product_codes(64)):
        y = x @ rotation
        one, two = y[:, :32] @ first.T, y[:, 32:] @ second.T
        for row, i, j in zip(*np.nonzero(one[:, :, None] + two[:, None, :] >= cap(64)[0])):
            every.add((int(row), (code * WORDS + int(i)) * WORDS + int(j)))
    assert found == every
