"""Whitening of vectors by a covariance from squares alone.

By polarisation, 2 cov(i, j) = var(i + j) - var(i) - var(j), so the squared centred values of every
dimension and of every sum of two dimensions give all covariances. Vectors are integers and are
centred by the integer nearest to the mean first; what that leaves of the mean is taken out of the
sums of squares afterwards, in integers, so every variance is exact. Tasks add up squares of their
rows, one shuffle adds up the tasks' sums, and the driver holds one number per pair of dimensions,
which grows with the vectors' length and not with their count.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerflow.llm.common import ship
from ledgerflow.session import stage

SCALE = 256.0
COMPONENTS = 4
#: Vectors whose squares are added up at a time.
ROWS = 2048
WIDE = pa.decimal128(38, 0)
SHAPE = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double, deviation_digits string"
)


def integer_vector(vector: str) -> Column:
    """floor(256 c) of every entry, at the ends of the long range where it lies beyond."""
    return F.transform(vector, lambda c: F.floor(F.lit(SCALE) * c.cast("double")).cast("long"))


def usable(vector: str) -> Column:
    """Whether a vector is there and has neither null nor non-finite entries, nor no entry at all."""
    finite = F.forall(
        vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < F.lit(float("inf")))
    )
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & finite


def matrix(column: pa.Array) -> np.ndarray:
    """A list column of one length as rows of integers."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def shifted(x: np.ndarray, centre: list[int]) -> np.ndarray:
    """x - centre; Python integers where a difference could leave the long range."""
    limit = 1 << 62
    if max(map(abs, centre)) < limit and -limit < int(x.min()) and int(x.max()) < limit:
        return x - np.array(centre, np.int64)
    return x.astype(object) - np.array(centre, object)


def most(y: np.ndarray) -> int:
    """The largest absolute entry."""
    return max(-int(y.min()), int(y.max()))


def squares(y: np.ndarray) -> list[np.ndarray]:
    """Per dimension i the sums of squares of i's values and of its sums with all later dimensions."""
    bound = 4 * most(y) ** 2 * len(y)
    if bound < 1 << 53:
        y = y.astype(np.float64)
    elif bound >= 1 << 63:
        y = y.astype(object)
    out = []
    for i in range(y.shape[1]):
        sums = y[:, i:] + y[:, i : i + 1]
        sums[:, 0] = y[:, i]
        total = (sums * sums).sum(0) if y.dtype == object else np.einsum("ij,ij->j", sums, sums)
        out.append(total.astype(np.int64) if total.dtype == np.float64 else total)
    return out


def sums_by_dimension(fit: DataFrame) -> DataFrame:
    """``size``, ``place``, ``n`` and ``total``: vectors of each length and the sums of their entries."""
    schema = pa.schema([("size", pa.int32()), ("place", pa.int32()), ("n", pa.int64()), ("total", WIDE)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            column = batch.column(0)
            sizes = column.value_lengths().to_numpy(zero_copy_only=False)
            for size in np.unique(sizes).tolist():
                x = matrix(column.filter(pa.array(sizes == size)))
                if most(x) * len(x) >= 1 << 62:
                    x = x.astype(object)
                one = held.setdefault(size, [0, np.zeros(size, object)])
                one[0] += len(x)
                one[1] = one[1] + x.sum(0)
        rows = [(s, k, n, Decimal(int(t))) for s, (n, sums) in held.items() for k, t in enumerate(sums)]
        columns = list(zip(*rows)) or [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
        )

    parts = fit.select("x").mapInArrow(run, "size int, place int, n long, total decimal(38,0)")
    return parts.groupBy("size", "place").agg(
        F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total")
    )


def sums_of_squares(fit: DataFrame, centre: list[int]) -> DataFrame:
    """``one``, ``two`` and ``total``: squares of dimension one (where both are the same) or of the
    sum of both, each centred, over all vectors."""
    size = len(centre)
    schema = pa.schema([("one", pa.int32()), ("two", pa.int32()), ("total", WIDE)])

    def row_batches(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        for i, sums in enumerate(held):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(size - i, i, np.int32)),
                    pa.array(np.arange(i, size, dtype=np.int32)),
                    pa.array([Decimal(int(s)) for s in sums], WIDE),
                ],
                schema=schema,
            )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        bound = 0
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                y = shifted(matrix(batch.column(0).slice(at, ROWS)), centre)
                more = 4 * most(y) ** 2 * len(y)
                if held and bound + more >= 1 << 62:
                    yield from row_batches(held)
                    held, bound = [], 0
                part = squares(y)
                held = [a + b for a, b in zip(held, part)] if held else part
                bound += more
        yield from row_batches(held)

    parts = fit.select("x").mapInArrow(run, "one int, two int, total decimal(38,0)")
    return parts.groupBy("one", "two").agg(F.sum("total").cast("decimal(38,0)").alias("total"))


def covariance(n: int, rest: list[int], totals: dict[tuple[int, int], int]) -> np.ndarray:
    """All covariances by polarisation, each the double nearest to its exact value.

    ``rest`` is what centring by an integer left: the sum of the centred values of each dimension.
    """
    size = len(rest)
    own = [n * n * totals[i, i] - n * rest[i] ** 2 for i in range(size)]
    out = np.zeros((size, size))
    for i in range(size):
        out[i, i] = own[i] / n**3
        for j in range(i + 1, size):
            both = n * n * totals[i, j] - n * (rest[i] + rest[j]) ** 2
            out[i, j] = out[j, i] = (both - own[i] - own[j]) / (2 * n**3)
    return out


class Whitening:
    """Centre and components of a fit list of ``n`` integer vectors with sums ``sums``."""

    def __init__(self, n: int, sums: list[int], cov: np.ndarray, components: int) -> None:
        self.n = n
        self.centre = [(2 * s + n) // (2 * n) for s in sums]
        self.rest = [s - n * c for s, c in zip(sums, self.centre)]
        values, vectors = np.linalg.eigh(cov)
        values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
        # One sign for all rows: the entry of the largest size is positive.
        at = np.abs(vectors).argmax(0)
        self.vectors = vectors * np.where(vectors[at, np.arange(vectors.shape[1])] < 0, -1.0, 1.0)
        trace = float(np.trace(cov))
        # Below this, an eigenvalue is rounding, and the direction has no spread to divide by.
        self.spread = values > len(cov) * np.finfo(float).eps * max(trace, 0.0)
        self.values = np.where(self.spread, values, 1.0)
        self.explained = [max(float(v), 0.0) / trace if trace > 0 else None for v in values]

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened values by row and component, NaN where a component has no spread."""
        y = shifted(x, self.centre)
        centred = y.astype(np.float64) - np.array([r / self.n for r in self.rest])
        # Row by row: a row's value does not depend on the rows beside it.
        out = np.einsum("ij,jk->ik", centred, self.vectors) / np.sqrt(self.values)
        out[:, ~self.spread] = np.nan
        return out

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sums of (n x - S)^2, exact."""
        y = shifted(x, self.centre)
        if y.dtype != object and ((most(y) + 1) * self.n) ** 2 * y.shape[1] >= 1 << 63:
            y = y.astype(object)
        centred = y * self.n - np.array(self.rest, y.dtype)
        return (centred * centred).sum(1).tolist()


def fit(vectors: DataFrame, components: int) -> tuple[Whitening, DataFrame, int] | None:
    """Components of the distinct vectors in ``x``, those vectors, and their length; None if none."""
    fit_list = stage(vectors.select("x").distinct(), "whitening-fit")
    sums = stage(sums_by_dimension(fit_list), "whitening-sums")
    largest = sums.where("place = 0").orderBy(F.desc("n"), F.desc("size")).select("size").first()
    if largest is None:
        return None
    size = largest["size"]
    rows = sums.where(F.col("size") == size).orderBy("place").collect()
    n, totals = rows[0]["n"], [int(r["total"]) for r in rows]
    centre = [(2 * s + n) // (2 * n) for s in totals]
    fit_list = fit_list.where(F.size("x") == size)
    pairs = sums_of_squares(fit_list, centre).collect()
    rest = [s - n * c for s, c in zip(totals, centre)]
    cov = covariance(n, rest, {(r["one"], r["two"]): int(r["total"]) for r in pairs})
    return Whitening(n, totals, cov, min(components, size)), fit_list, size


def identity_error(fit_list: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance minus the identity, measured over
    its vectors; None where no component has any spread."""
    chosen = np.flatnonzero(model.spread)
    if not len(chosen):
        return None
    count = len(chosen)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, product = np.zeros(count), np.zeros((count, count))
        for batch in batches:
            if batch.num_rows:
                w = model.project(matrix(batch.column(0)))[:, chosen]
                total += w.sum(0)
                product += w.T @ w
        values = np.concatenate([total, product.ravel()])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], names=["place", "total"]
        )

    parts = fit_list.select("x").mapInArrow(run, "place int, total double").groupBy("place").sum("total")
    values = np.array([r[1] for r in sorted(map(tuple, parts.collect()))])
    mean = values[:count] / model.n
    found = values[count:].reshape(count, count) / model.n - np.outer(mean, mean)
    return float(np.abs(found - np.eye(count)).max())


def whiten(embeddings: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row per usable row of ``embeddings`` (``vec_id``, ``vector``) and component, see SHAPE.

    Null vectors, those with null or non-finite entries and those without entries have no row. The
    fit list is each distinct integer vector once, so copies and repeated rows do not weigh, but each
    row has its own result; a null vec_id stays null. Where vectors differ in length, the length of
    most of the fit list counts (of ties the longer) and rows of another have no result, since they
    have no covariance with the rest. A component without spread (one distinct vector, fewer vectors
    than components, constant dimensions) has a null ``whitened``; where nothing has spread,
    ``explained`` and ``identity_error`` are null, too. A ``deviation`` beyond the long range is null
    and stands in ``deviation_digits``, which is null otherwise. Other columns are left out.
    """
    spark = embeddings.sparkSession
    ship(spark)
    vectors = embeddings.where(usable(vector)).select(
        F.col("vec_id").cast("long").alias("vec_id"), integer_vector(vector).alias("x")
    )
    found = fit(vectors, components)
    if found is None:
        return spark.createDataFrame([], SHAPE)
    model, fit_list, size = found
    error = identity_error(fit_list, model)
    schema = pa.schema(
        [("vec_id", pa.int64()), ("deviation", pa.int64()), ("deviation_digits", pa.string()),
         ("whitened", pa.list_(pa.float64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(1))
            whitened = model.project(x)
            values = pa.array(whitened.ravel(), mask=np.isnan(whitened.ravel()))
            ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * whitened.shape[1])
            deviations = model.deviations(x)
            fits = [d < 1 << 63 for d in deviations]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([d if ok else None for d, ok in zip(deviations, fits)], pa.int64()),
                    pa.array([None if ok else str(d) for d, ok in zip(deviations, fits)], pa.string()),
                    pa.ListArray.from_arrays(ends, values),
                ],
                schema=schema,
            )

    shape = "vec_id long, deviation long, deviation_digits string, whitened array<double>"
    rows = vectors.where(F.size("x") == size).mapInArrow(run, shape)
    explained = F.array(*[F.lit(e).cast("double") for e in model.explained])
    return rows.select("*", F.posexplode("whitened").alias("place", "value")).select(
        "vec_id", (F.col("place") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"),
        "deviation", F.col("value").alias("whitened"), F.get(explained, F.col("place")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"), "deviation_digits",
    )
