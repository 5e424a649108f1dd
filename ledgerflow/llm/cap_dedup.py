"""Near-duplicate vectors by spherical-cap filters from random product codes.

A filter direction is a pair of code words, one for each half of a randomly rotated vector. A vector
passes a filter if its inner product with the direction reaches the cap's height. List decoding finds
all filters a vector passes without trying every pair: a code word of one half matters only if the
best of the other half lifts it to the height. Vectors that pass a common filter are compared
exactly. Equal vectors are one vertex with a count, so copies never meet in pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerflow.llm.common import ship
from ledgerflow.llm.components import connected_components
from ledgerflow.llm.pairs import allowed_pairs, cut_buckets, deal, groups, local_roots
from ledgerflow.session import stage

COSINE = 0.98
#: Code words of each half, at most; their pairs are the filters of one code.
WORDS = 1024
#: Independent codes, each with a rotation of its own.
CODES = 6
#: Share of random vectors that pass a filter; a vector passes WORDS^2 times that many, on average.
PASS = 7e-6
#: Caps are not narrower than this, and shorter vectors are filled up with zeros to LEAST_SIZE.
HIGHEST, LEAST_SIZE = 0.9, 8


@lru_cache(maxsize=8)
def cap(size: int) -> tuple[float, int]:
    """Height of the caps for vectors of ``size`` components, and code words of each half.

    A random unit vector reaches the height with probability PASS; where few components make that a
    narrower cap than linked vectors need, the height is HIGHEST and there are fewer words.
    """
    # The exact law of one coordinate of a random unit vector.
    grid = np.linspace(0.0, 1.0, 200_001)
    density = np.maximum(1.0 - grid**2, 0.0) ** ((size - 3) / 2)
    tail = np.cumsum(density[::-1])[::-1] / (2 * density.sum())
    height = min(float(grid[np.searchsorted(-tail, -PASS)]), HIGHEST)
    share = float(tail[np.searchsorted(grid, height)])
    return height, min(WORDS, int(np.ceil(WORDS * np.sqrt(PASS / share))))


@lru_cache(maxsize=8)
def product_codes(size: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Rotation and the code words of both halves, for vectors of ``size`` components."""
    half, words = (size + 1) // 2, cap(size)[1]
    out = []
    for code in range(CODES):
        draw = np.random.default_rng([size, code])
        rotation = np.linalg.qr(draw.standard_normal((size, size)))[0]
        sides = []
        for columns in (half, size - half):
            side = draw.standard_normal((words, columns))
            sides.append(side / (np.linalg.norm(side, axis=1, keepdims=True) * np.sqrt(2.0)))
        out.append((rotation, *sides))
    return out


def list_decode(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row number and filter number of every filter that rows of unit vectors pass."""
    rows, filters = [], []
    if unit.shape[1] < LEAST_SIZE:
        unit = np.pad(unit, ((0, 0), (0, LEAST_SIZE - unit.shape[1])))
    size = unit.shape[1]
    height = cap(size)[0]
    for code, (rotation, first, second) in enumerate(product_codes(size)):
        turned = unit @ rotation
        half = first.shape[1]
        one, two = turned[:, :half] @ first.T, turned[:, half:] @ second.T
        at_one, word_one = np.nonzero(one >= height - two.max(axis=1, keepdims=True))
        at_two, word_two = np.nonzero(two >= height - one.max(axis=1, keepdims=True))
        count_two = np.bincount(at_two, minlength=len(unit))
        begin_two = np.cumsum(count_two) - count_two
        times = count_two[at_one]
        left = np.repeat(np.arange(len(at_one)), times)
        within = np.arange(len(left)) - np.repeat(np.cumsum(times) - times, times)
        right = begin_two[at_one[left]] + within
        row = at_one[left]
        passed = one[row, word_one[left]] + two[row, word_two[right]] >= height
        rows.append(row[passed])
        filters.append((code * WORDS + word_one[left[passed]]) * WORDS + word_two[right[passed]])
    return np.concatenate(rows), np.concatenate(filters)


def _matrix(values: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(values), np.float64).reshape(len(values), -1)


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = batch.column(0).to_numpy()
        vectors = batch.column(1).to_pylist()
        lengths = np.array([len(v) for v in vectors])
        for size in np.unique(lengths):
            same = np.flatnonzero(lengths == size)
            for at in range(0, len(same), 512):
                part = same[at : at + 512]
                x = np.array([vectors[k] for k in part], np.float64)
                # Scaled first, so that squares neither overflow nor vanish.
                x /= np.abs(x).max(axis=1, keepdims=True)
                rows, filters = list_decode(x / np.linalg.norm(x, axis=1, keepdims=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[part[rows]]), pa.array(filters.astype(np.int64)),
                     pa.array(np.full(len(rows), size, np.int64))],
                    names=["id", "filter", "size"],
                )


FOUND = "id long, links long, root long"


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple[np.ndarray, ...]] = []
    for group in groups(batches):
        bucket, one, two = (group.column(k)[0].as_py() for k in range(3))
        own = group["own"].to_numpy()
        ids = group["id"].to_numpy()
        order = np.argsort(ids, kind="stable")
        own, ids = own[order], ids[order]
        copies = group["copies"].to_numpy()[order]
        x = np.array([group["embedding"][int(k)].as_py() for k in order], np.float64)
        x /= np.abs(x).max(axis=1, keepdims=True)
        norms = np.sqrt((x * x).sum(axis=1))
        linked = (x @ x.T) / (norms[:, None] * norms[None, :]) >= COSINE
        linked &= allowed_pairs(own, one, two)
        left, right = np.nonzero(linked)
        if not len(left):
            continue
        # A pair that shares an earlier bucket was counted there.
        passed = [np.array(group["buckets"][int(k)].as_py(), np.int64) for k in order]
        member = np.repeat(np.arange(len(ids)), [len(p) for p in passed])
        earlier = np.concatenate(passed)
        member, earlier = member[earlier < bucket], earlier[earlier < bucket]
        names, number, seen = np.unique(earlier, return_inverse=True, return_counts=True)
        shared = seen[number] > 1
        grid = np.zeros((len(ids), len(names)), np.float32)
        grid[member[shared], number[shared]] = 1.0
        fresh = (grid @ grid.T)[left, right] == 0
        links = np.zeros(len(ids), np.int64)
        np.add.at(links, left[fresh], copies[right[fresh]])
        np.add.at(links, right[fresh], copies[left[fresh]])
        root = ids[local_roots(len(ids), left, right)]
        told = (links > 0) | (root != ids)
        out.append((ids[told], links[told], root[told]))
        if sum(len(o[0]) for o in out) > 20_000:
            yield _result(out)
            out = []
    if out:
        yield _result(out)


def _result(out: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    columns = [pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)]
    return pa.RecordBatch.from_arrays(columns, names=["id", "links", "root"])


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row of ``vectors``.

    ``vectors`` has vec_id, embedding and label. Two vectors are linked if their labels are equal
    and their cosine, in doubles, is at least COSINE. Rows whose vec_id or label is null, and
    vectors that are null, empty, zero or hold a null or non-finite component, link with nothing
    and are kept as their own component. Rows with one vec_id count as vectors of their own.
    """
    ship(vectors.sparkSession)
    x = F.col("embedding")
    finite = F.forall(
        x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")).cast("double"))
    )
    valid = (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & finite
        & F.exists(x, lambda v: v != 0)
    )
    rows = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("label"),
        x.cast("array<double>").alias("embedding"),
        F.coalesce(valid, F.lit(False)).alias("valid"),
        F.xxhash64("label", "embedding").alias("id"),
    )
    classes = rows.where("valid").groupBy("id").agg(
        F.min("vec_id").alias("first_id"), F.count(F.lit(1)).alias("copies"),
        F.first("label").alias("label"), F.first("embedding").alias("embedding"),
    )
    classes = stage(classes, "cap-classes")
    passed = classes.select("id", "embedding").mapInArrow(_decode, "id long, filter long, size long")
    named = passed.join(classes.select("id", "label"), "id").select(
        "id", F.xxhash64("label", "size", "filter").alias("bucket")
    )
    named = stage(named.distinct(), "cap-filters")
    shared = named.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    kept = stage(named.join(shared.select("bucket"), "bucket"), "cap-buckets")
    lists = kept.groupBy("id").agg(F.sort_array(F.collect_list("bucket")).alias("buckets"))
    full = lists.join(classes.select("id", "copies", "embedding"), "id")
    members = cut_buckets(kept).select("bucket", "one", "two", "own", "id").join(full, "id")
    members = members.select("bucket", "one", "two", "own", "id", "copies", "buckets", "embedding")
    found = stage(deal(members).mapInArrow(_compare, FOUND), "cap-links")

    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    edges = found.where("id <> root").select(F.col("id").alias("a"), F.col("root").alias("b"))
    label = connected_components(edges.distinct())
    joined = classes.select("id", "first_id", "copies").join(label, "id", "left").join(links, "id", "left")
    joined = joined.withColumn("component", F.coalesce("component", "id"))
    smallest = joined.groupBy("component").agg(F.min("first_id").alias("component_id"))
    facts = joined.join(smallest, "component").select(
        "id", "component_id",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
    )
    told = rows.select("vec_id", F.when(F.col("valid"), F.col("id")).alias("id"))
    whole = told.join(stage(facts, "cap-facts"), "id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    )
    return whole.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


ORACLE = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e,
    sqrt(list_inner_product(CAST(embedding AS DOUBLE[]), CAST(embedding AS DOUBLE[]))) AS norm
  FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.98
), reach(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), facts AS (
  SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links,
    least(e.vec_id, coalesce((SELECT min(b) FROM reach r WHERE r.a = e.vec_id), e.vec_id))
      AS component_id
  FROM embeddings e
)
SELECT vec_id, n_links, component_id, vec_id = component_id AS kept FROM facts
"""
