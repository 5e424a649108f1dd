"""Exact top-k search by vector-approximation files.

Vectors are kept in blocks. A block holds, per dimension, cell borders between its quantiles, each
vector's cell numbers (the approximation, four bits a dimension) and, apart from these, the exact
integer components. The ends of a cell bound what a dimension can add to the inner product, so the
cells alone give each vector's score an upper and a lower bound:

1. Queries, a stated set, are gathered in blocks and go to the cells of every block of vectors. The k
   highest lower bounds over all blocks give each query a score that its kth best reaches for sure.
2. They go to the blocks again. Only vectors whose upper bound reaches that score are read exactly,
   in falling order of the bound, until no bound left reaches the kth score of the block.
3. The best of all blocks are ranked.

Blocks move once a pass, as large as they are; what goes everywhere are the queries.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerflow.llm.common import ship
from ledgerflow.session import stage

SCALE = 64.0
CELLS = 16
VECTOR_BLOCK = 8192
QUERY_BLOCK = 256
#: Exact vectors read between two looks at the kth score.
STEP = 64
#: The end of the scores; beyond it a score is taken to be there.
LONG = (1 << 63) - 1
#: The highest double below that; bounds are cut there, so that scores at the end tie.
TOP = float((1 << 63) - 1024)


def integer_vectors(column: pa.Array) -> list[np.ndarray | None]:
    """floor(64 x) of each vector, None where it is null or a component is null or not finite. Python
    integers where a component leaves the long range."""
    out: list[np.ndarray | None] = []
    for value in column.to_pylist():
        if value is None or any(x is None or not math.isfinite(x) for x in value):
            out.append(None)
            continue
        x = np.asarray(value, np.float64)
        if np.abs(x).max(initial=0) < 2.0**56:
            out.append(np.floor(SCALE * x).astype(np.int64))
        else:
            # Beyond 2^53 a double is whole.
            whole = [math.floor(SCALE * v) if abs(v) < 2.0**56 else int(SCALE) * int(v) for v in value]
            out.append(np.array(whole, object))
    return out


def largest(x: np.ndarray) -> int:
    return max(int(x.max(initial=0)), -int(x.min(initial=0))) if x.size else 0


def as_doubles(x: np.ndarray) -> np.ndarray:
    """Integers as doubles; those beyond any double are infinite."""
    if x.dtype != object:
        return x.astype(np.float64)
    limit = int(np.finfo(np.float64).max)
    flat = [float(v) if abs(v) <= limit else (math.inf if v > 0 else -math.inf) for v in x.ravel()]
    return np.array(flat, np.float64).reshape(x.shape)


def pack_rows(rows: np.ndarray) -> bytes:
    """Integers as the first byte's kind says: 2, 4 or 8 bytes each, or 0 for decimal text."""
    most = largest(rows)
    for size in (2, 4, 8):
        if most < 1 << (8 * size - 1):
            return bytes([size]) + rows.astype(f"<i{size}").tobytes()
    return bytes([0]) + " ".join(map(str, rows.ravel())).encode()


def unpack_rows(raw: bytes, dim: int) -> np.ndarray:
    if raw[0]:
        flat = np.frombuffer(raw, f"<i{raw[0]}", offset=1).astype(np.int64)
    else:
        flat = np.array([int(v) for v in raw[1:].split()], object)
    return flat.reshape(-1, dim) if dim else flat.reshape(0, 0)


def exact_scores(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products as longs, whatever the components."""
    bound = largest(rows) * largest(query) * max(len(query), 1)
    if bound < 1 << 53:
        return (rows.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    if bound <= LONG:
        return rows @ query
    found = rows.astype(object) @ query.astype(object)
    return np.array([min(max(int(v), -LONG), LONG) for v in found], np.int64)


class Approximation:
    """Cells of a block of integer vectors: cell numbers, and each cell's lowest and highest value."""

    def __init__(self, codes: np.ndarray, low: np.ndarray, high: np.ndarray) -> None:
        at = np.arange(codes.shape[1])
        self.codes, self.low, self.high = codes, low, high
        self.ends = np.concatenate([high[codes, at], low[codes, at]], axis=1).T

    @classmethod
    def of(cls, exact: np.ndarray, cells: int = CELLS) -> Approximation:
        ranks = np.linspace(0, 1, cells + 1)[1:-1]
        values = as_doubles(exact)
        codes = np.empty(exact.shape, np.uint8)
        low, high = np.zeros((2, cells, exact.shape[1]))
        for d in range(exact.shape[1]):
            column = values[:, d]
            borders = np.quantile(column, ranks, method="lower")
            codes[:, d] = np.searchsorted(borders, column, side="right")
            order = np.argsort(codes[:, d], kind="stable")
            used, starts = np.unique(codes[order, d], return_index=True)
            low[used, d] = np.minimum.reduceat(column[order], starts)
            high[used, d] = np.maximum.reduceat(column[order], starts)
        return cls(codes, low, high)

    def upper(self, queries: np.ndarray) -> np.ndarray:
        """At least the inner products, queries by vectors."""
        q = as_doubles(queries)
        return self._slack(q) + np.concatenate([np.maximum(q, 0), np.minimum(q, 0)], axis=1) @ self.ends

    def lower(self, queries: np.ndarray) -> np.ndarray:
        """At most the inner products."""
        q = as_doubles(queries)
        return np.concatenate([np.minimum(q, 0), np.maximum(q, 0)], axis=1) @ self.ends - self._slack(q)

    def bounds(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.upper(queries), self.lower(queries)

    def _slack(self, q: np.ndarray) -> np.ndarray | float:
        """What rounding may take from a bound; nothing while all sums are whole numbers in a double."""
        size = max(q.shape[1], 1)
        most = np.abs(q).max(axis=1, initial=0) * np.abs(self.ends).max(initial=0) * size
        if most.max(initial=0) < 2.0**53:
            return 0.0
        return (most * size * 2.0**-50)[:, None]


class BestRows:
    """The k best (score, vector id) of one query; ties go to the smaller id."""

    def __init__(self, k: int) -> None:
        self.k = k
        self.scores, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def kth(self) -> float:
        return self.scores[-1] if len(self.scores) == self.k else -np.inf

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        scores, ids = np.append(self.scores, scores), np.append(self.ids, ids)
        order = np.lexsort((ids, -scores))[: self.k]
        self.scores, self.ids = scores[order], ids[order]


class Block:
    """The vectors of one length of a block, as one row brings them."""

    def __init__(self, dim: int, ids: bytes, exact: bytes | None, codes: bytes, low: bytes, high: bytes) -> None:
        self.ids = np.frombuffer(ids, "<i8")
        self.exact = None if exact is None else unpack_rows(exact, dim)
        packed = np.frombuffer(codes, np.uint8).reshape(len(self.ids), -1)
        cells = np.stack([packed & 15, packed >> 4], axis=2).reshape(len(self.ids), -1)[:, :dim]
        ends = (np.frombuffer(raw, np.float64).reshape(CELLS, dim) for raw in (low, high))
        self.cells = Approximation(cells, *ends)

    def sure(self, queries: np.ndarray, query_ids: np.ndarray, k: int) -> list[np.ndarray]:
        """Per query the k highest lower bounds of other rows."""
        out = []
        for own, lower in zip(query_ids, self.cells.lower(queries)):
            lower = np.minimum(np.nan_to_num(lower[self.ids != own], nan=-np.inf), TOP)
            out.append(np.partition(lower, len(lower) - k)[len(lower) - k :] if len(lower) > k else lower)
        return out

    def search(self, query: np.ndarray, own: int, upper: np.ndarray, floor: float, k: int) -> BestRows:
        """The best rows of one query, read exactly in falling order of the bound."""
        best = BestRows(k)
        upper = np.minimum(np.nan_to_num(upper, nan=np.inf), TOP)
        rows = np.flatnonzero((upper >= floor) & (self.ids != own))
        rows = rows[np.argsort(-upper[rows], kind="stable")]
        for at in range(0, len(rows), STEP):
            part = rows[at : at + STEP]
            part = part[upper[part] >= min(best.kth, TOP)]
            if not len(part):
                break
            best.add(exact_scores(self.exact[part], query), self.ids[part])
        return best


FIELDS = ("dim", "ids", "exact", "codes", "low", "high")
BLOCK = "dim int, ids binary, exact binary, codes binary, low binary, high binary"
BLOCK_ARROW = pa.schema([("dim", pa.int32())] + [(name, pa.binary()) for name in FIELDS[1:]])


def _gather(size: int, cells: bool):
    """Rows gathered to blocks of at most ``size`` vectors of one length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list[int], list[np.ndarray]]] = {}

        def close(dim: int) -> pa.RecordBatch:
            ids, rows = held.pop(dim)
            exact = np.array(rows, None if any(r.dtype == object for r in rows) else np.int64)
            exact = exact.reshape(len(ids), dim)
            raw = [pack_rows(exact), None, None, None]
            if cells:
                found = Approximation.of(exact)
                codes = np.pad(found.codes, ((0, 0), (0, dim % 2)))
                raw[1:] = (codes[:, ::2] | codes[:, 1::2] << 4).tobytes(), found.low.tobytes(), found.high.tobytes()
            values = [[dim], [np.array(ids, "<i8").tobytes()], *([a] for a in raw)]
            return pa.RecordBatch.from_arrays(
                [pa.array(v, f.type) for v, f in zip(values, BLOCK_ARROW)], schema=BLOCK_ARROW
            )

        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                for key, row in zip(some.column(0).to_pylist(), integer_vectors(some.column(1))):
                    if row is None or key is None:
                        continue
                    ids, rows = held.setdefault(len(row), ([], []))
                    ids.append(key)
                    rows.append(row)
                    if len(ids) == size:
                        yield close(len(row))
        for dim in list(held):
            yield close(dim)

    return run


def _blocks(rows: DataFrame, size: int, least: int, cells: bool, label: str) -> tuple[DataFrame, int]:
    """Rows dealt out evenly to parts of at most about ``size``, ``least`` parts where there are rows
    for them, and gathered there."""
    count = rows.count()
    parts = max(1, -(-count // size), min(least, -(-count // 512)))
    part = F.spark_partition_id().alias("part")
    gathered = rows.repartition(parts).mapInArrow(_gather(size, cells), BLOCK)
    return stage(gathered.select(part, *FIELDS), label), parts


def _meet(blocks: DataFrame, queries: DataFrame, parts: int) -> DataFrame:
    """Every block of vectors in one task, then all blocks of queries, for ``_turns``."""
    every = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))
    none = F.lit(None)
    held = blocks.select(
        F.col("part").alias("turn"), F.lit(0).alias("kind"), *FIELDS,
        none.cast("long").alias("number"), none.cast("array<double>").alias("floors"),
    )
    asked = queries.select(every.alias("turn"), F.lit(1).alias("kind"), *FIELDS, "number", "floors")
    return held.unionByName(asked).repartition(parts, "turn").sortWithinPartitions("turn", "kind")


def _turns(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Blocks of vectors and of queries that have one length, as (block, number, ids, queries, floors)."""
    turn, held = None, []
    for batch in batches:
        for at in range(batch.num_rows):
            number, kind, dim, *raw, first, floors = (c[at].as_py() for c in batch.columns)
            if number != turn:
                turn, held = number, []
            if kind == 0:
                held.append((dim, Block(dim, *raw)))
                continue
            for size, block in held:
                if size == dim:
                    yield block, first, np.frombuffer(raw[0], "<i8"), unpack_rows(raw[1], dim), floors


def top_scores(vectors: DataFrame, k: int = 20, step: int = 20) -> DataFrame:
    """For each row whose ``vec_id`` is divisible by ``step``: the ``k`` rows of highest score.

    ``vectors`` has vec_id and embedding. The score is the inner product of floor(64 x); ties go to
    the smaller vec_id. Rows without a vec_id, and vectors that are null or hold a null or
    non-finite component, take no part; vectors of different lengths have no score. A vec_id that
    is repeated is a candidate with each of its rows, but never for itself, and a query with each of
    its rows. Scores are exact for any components; one beyond the long range is taken to be at its
    end.
    """
    spark = vectors.sparkSession
    ship(spark)
    chosen = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    least = spark.sparkContext.defaultParallelism
    blocks, parts = _blocks(chosen, VECTOR_BLOCK, least, True, "topk-vectors")
    queries = chosen.where(F.col("vec_id") % step == 0)
    asked, _ = _blocks(queries, QUERY_BLOCK, 1, False, "topk-queries")
    # Queries are numbered, since a vec_id may be repeated.
    asked = asked.withColumn("number", F.monotonically_increasing_id() * QUERY_BLOCK)
    asked = stage(asked.withColumn("floors", F.lit(None).cast("array<double>")), "topk-numbered")

    def sure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, first, ids, rows, _ in _turns(batches):
            found = block.sure(rows, ids, k)
            sizes = [len(one) for one in found]
            yield pa.RecordBatch.from_arrays(
                [pa.array(first + np.repeat(np.arange(len(ids)), sizes)), pa.array(np.concatenate(found))],
                names=["query", "bound"],
            )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, first, ids, rows, floors in _turns(batches):
            upper = block.cells.upper(rows)
            best = [block.search(rows[q], ids[q], upper[q], floors[q], k) for q in range(len(ids))]
            sizes = [len(one.ids) for one in best]
            columns = [
                first + np.repeat(np.arange(len(ids)), sizes), np.repeat(ids, sizes),
                np.concatenate([one.ids for one in best]), np.concatenate([one.scores for one in best]),
            ]
            names = ["query", "query_id", "vec_id", "score"]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    def ranked(rows: DataFrame, *order) -> DataFrame:
        window = Window.partitionBy("query").orderBy(*order)
        return rows.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= k)

    cells = blocks.withColumn("exact", F.lit(None).cast("binary"))
    bounds = _meet(cells, asked, parts).mapInArrow(sure, "query long, bound double")
    kth = ranked(bounds, F.desc("bound")).where(F.col("rank") == k)
    # Floors go back to the blocks of queries, 256 at most to each.
    at = F.col("query") % QUERY_BLOCK
    known = kth.select((F.col("query") - at).alias("number"), F.struct(at.alias("at"), "bound").alias("one"))
    known = known.groupBy("number").agg(F.map_from_entries(F.collect_list("one")).alias("known"))
    size = F.octet_length("ids") / 8
    floors = F.transform(
        F.sequence(F.lit(0).cast("long"), size.cast("long") - 1),
        lambda i: F.coalesce(F.try_element_at("known", i), F.lit(float("-inf"))),
    )
    asked = asked.join(known, "number", "left").withColumn("floors", floors).drop("known")
    found = _meet(blocks, asked, parts).mapInArrow(
        search, "query long, query_id long, vec_id long, score long"
    )
    return ranked(found, F.desc("score"), "vec_id").select("query_id", "rank", "vec_id", "score")


ORACLE = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20
"""
