"""What several operators need: task-side helpers and blocks of staged rows."""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerflow.llm.token_ids import forget_units

#: The characters that separate words, as a Java or Python class.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def words_of(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8; bytes split at exactly 0x20 and 0x09-0x0D."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def text_parts(texts: list[str], size: int = 1_000_000) -> Iterator[slice]:
    """Slices of about ``size`` characters, so that what a task derives from texts stays small."""
    first = held = 0
    for k, text in enumerate(texts):
        held += len(text)
        if held >= size:
            yield slice(first, k + 1)
            first, held = k + 1, 0
    if first < len(texts):
        yield slice(first, len(texts))


def batch_parts(batch: pa.RecordBatch, column: int, size: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of a batch of about ``size`` bytes in its text or binary column.

    Cut while still Arrow, so no more than a slice becomes Python values at a time.
    """
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes, dtype=np.int64)
    first = 0
    while first < batch.num_rows:
        before = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, before + size, side="right")))
        yield batch.slice(first, last - first)
        first = last


def give_back() -> None:
    """Return freed memory to the machine; idle Python workers would keep it until they end."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # a C library without it


def frugal(
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], encodes: bool = False
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function whose task gives its memory back at its end.

    Workers serve one operator after another; unless the function ``encodes``, what an earlier one's
    encoders remember goes first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not encodes:
            forget_units()
            give_back()
        try:
            yield from function(batches)
        finally:
            give_back()

    return run


def per_batch(
    function: Callable[[pa.RecordBatch], pa.RecordBatch],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A mapInArrow function from one that maps a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return run


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Tasks import helpers from it, also where it is not installed on the workers.
    """
    context = spark.sparkContext
    if getattr(context, "_ledgerflow_shipped", False):
        return
    root = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="ledgerflow-")) / f"{root.name}-tasks.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for path in sorted(root.rglob("*.py")):
            out.write(path, path.relative_to(root.parent))
    context.addPyFile(str(archive))
    context._ledgerflow_shipped = True
