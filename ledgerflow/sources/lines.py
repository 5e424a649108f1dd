"""Text files as numbered lines, without gathering a file in one task.

Spark reads a large file in blocks. Every line carries its file and the start of its block, and
lines of one block sit together, in file order, in one task. So counts inside a block need no
shuffle, and one small row per block is enough to carry them on to the next block of the file.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from ledgerflow.session import stage

# Underscores keep these apart from the partition columns of a folder.
VALUE, FILE, BLOCK, LINE = "value", "_file", "_block", "_line"


def read_lines(
    spark: SparkSession, paths: str | list[str], line_sep: str | None = None
) -> DataFrame:
    """Raw lines with their file path and block start."""
    reader = spark.read if line_sep is None else spark.read.option("lineSep", line_sep)
    found = reader.text(paths)
    return found.select(
        "*",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
    )


def scan_blocks(
    lines: DataFrame, counts: dict[str, str] | None = None, carry: dict[str, str] | None = None
) -> DataFrame:
    """Running values inside each block, in one narrow pass.

    Adds ``LINE`` (1, 2, 3... in the block), a running count per flag column
    (``counts={new: flag}``) and the last value seen per text column (``carry={new: column}``).
    Must come before any shuffle, since it relies on the order of the file.
    """
    counts, carry = counts or {}, carry or {}
    added = [T.StructField(LINE, T.LongType())]
    added += [T.StructField(n, T.LongType()) for n in counts]
    added += [T.StructField(n, T.StringType()) for n in carry]
    schema = T.StructType([*lines.schema.fields, *added])

    # Everything the tasks run is nested here, so executors need no copy of this package.
    def run_starts(file: pa.Array, block: np.ndarray) -> np.ndarray:
        """True where a row begins another block than the row before it; the first row is open."""
        codes = file.dictionary_encode().indices.to_numpy(zero_copy_only=False)
        starts = np.zeros(len(block), dtype=bool)
        starts[1:] = (codes[1:] != codes[:-1]) | (block[1:] != block[:-1])
        return starts

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here: tuple | None = None
        totals = dict.fromkeys([LINE, *counts], 0)
        seen: dict[str, str | None] = dict.fromkeys(carry)
        for batch in batches:
            size = batch.num_rows
            if size == 0:
                continue
            file = batch.column(FILE)
            block = batch.column(BLOCK).to_numpy(zero_copy_only=False)
            starts = run_starts(file, block)
            first = (file[0].as_py(), int(block[0]))
            if first != here:
                totals = dict.fromkeys(totals, 0)
                seen = dict.fromkeys(seen)
            rows = np.arange(size)
            begin = np.maximum.accumulate(np.where(starts, rows, 0))
            continued = begin == 0
            columns = []
            for name in totals:
                if name == LINE:
                    step = np.ones(size, dtype=np.int64)
                else:
                    flags = batch.column(counts[name]).to_numpy(zero_copy_only=False)
                    step = flags.astype(bool).astype(np.int64)
                running = np.cumsum(step)
                before = np.where(begin > 0, running[begin - 1], 0)
                running = running - before + np.where(continued, totals[name], 0)
                totals[name] = int(running[-1])
                columns.append(pa.array(running, type=pa.int64()))
            for name, source in carry.items():
                values = batch.column(source)
                known = values.is_valid().to_numpy(zero_copy_only=False)
                last = np.maximum.accumulate(np.where(known, rows, -1))
                last = np.where(last >= begin, last, -1)
                filled = values.take(pa.array(last, mask=last < 0))
                if seen[name] is not None:
                    old = pa.array(continued & (last < 0))
                    filled = pc.if_else(old, pa.scalar(seen[name], filled.type), filled)
                seen[name] = filled[size - 1].as_py()
                columns.append(filled.cast(pa.string()))
            here = (file[size - 1].as_py(), int(block[size - 1]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *columns], names=[f.name for f in schema.fields]
            )

    return lines.mapInArrow(number, schema)


def carry_over_blocks(
    scanned: DataFrame,
    counts: list[str],
    carry: list[str] | None = None,
    file_number: str | None = None,
) -> DataFrame:
    """Turn running values per block into running values per file.

    Stages the scanned lines, so that the block totals and the lines come from the same read, then
    joins one row per block back. Blocks follow each other by their start in the file. The block
    rows are staged, too, so the optimizer knows their size and broadcasts them where that is small
    enough. ``file_number`` adds a number per file under that name, a shorter key than the path for
    later steps.
    """
    carry = carry or []
    staged = stage(scanned, "lines")
    # The last line of a block holds its totals.
    blocks = staged.groupBy(FILE, BLOCK).agg(
        *[F.max(c).alias(c) for c in counts],
        *[F.max_by(c, staged[LINE]).alias(c) for c in carry],
    )
    before = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    # Each block row draws a number of its own, so the lowest per file is the file's own.
    lowest = F.min("_drawn").over(Window.partitionBy(FILE))
    offsets = blocks.withColumn("_drawn", F.monotonically_increasing_id()).select(
        FILE,
        BLOCK,
        *([lowest.alias(file_number)] if file_number else []),
        *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_before_{c}") for c in counts],
        *[F.last(c, ignorenulls=True).over(before).alias(f"_before_{c}") for c in carry],
    )
    joined = staged.join(stage(offsets, "blocks"), [FILE, BLOCK], "left")
    moved = {c: F.col(c) + F.col(f"_before_{c}") for c in counts}
    moved |= {c: F.coalesce(F.col(c), F.col(f"_before_{c}")) for c in carry}
    added = [file_number] if file_number else []
    return joined.withColumns(moved).select(*scanned.columns, *added)
