"""Comparing all rows of a bucket with each other, however large the bucket."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerflow.session import stage

#: Rows of a bucket that one task compares with as many others.
BLOCK_ROWS = 1024


def cut_buckets(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows of every bucket with two rows or more, with the group of rows they are compared in.

    ``rows`` has ``bucket`` and ``id``, both long. A bucket of more than ``block_rows`` rows is cut
    into blocks by hash of the id, and every pair of blocks becomes a group of its own, so no task
    holds more than two blocks. Adds ``one`` and ``two``, the group's blocks, and ``own``, the row's.
    """
    counts = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("rows_in")).where("rows_in > 1")
    # Staged, so that the join lays both sides out itself and adaptive execution can split a bucket
    # that holds a third of all rows.
    sized = rows.join(stage(counts, "bucket-sizes"), "bucket").withColumn(
        "blocks", F.ceil(F.col("rows_in") / block_rows).cast("int")
    )
    owned = sized.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return owned.withColumn("other", other).select(
        "bucket", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"),
        "own", *[c for c in rows.columns if c != "bucket"],
    )


def deal(cut: DataFrame) -> DataFrame:
    """Every group of ``cut_buckets`` in one task, its rows in sequence, for ``groups``."""
    keys = ["bucket", "one", "two"]
    return cut.repartition(*keys).sortWithinPartitions(*keys)


def groups(batches: Iterator[pa.RecordBatch], keys: int = 3) -> Iterator[pa.Table]:
    """Consecutive rows of equal first ``keys`` columns, as tables."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        change = np.zeros(batch.num_rows - 1, bool)
        for column in columns:
            change |= column[1:] != column[:-1]
        starts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        if held and any(held[-1].column(k)[-1].as_py() != columns[k][0].item() for k in range(keys)):
            yield pa.Table.from_batches(held)
            held = []
        for begin, end in zip(starts[:-2], starts[1:-1]):
            held.append(batch.slice(begin, end - begin))
            yield pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(starts[-2], batch.num_rows - starts[-2]))
    if held:
        yield pa.Table.from_batches(held)


def allowed_pairs(own: np.ndarray, one: int, two: int) -> np.ndarray:
    """Which rows (down) are to be compared with which (across) in a group; each pair once."""
    if one == two:
        return np.triu(np.ones((len(own), len(own)), bool), 1)
    return (own == one)[:, None] & (own == two)[None, :]


def local_roots(count: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """For each of ``count`` rows the first row that the pairs connect it with."""
    root = np.arange(count)
    while True:
        before = root.copy()
        np.minimum.at(root, left, root[right])
        np.minimum.at(root, right, root[left])
        root = root[root]
        if (root == before).all():
            return root
