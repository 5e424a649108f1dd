"""Keep-latest and running numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerflow.session import stage

PART, OFFSET, NUMBER = "_part", "_offset", "_number"


def latest_per_key(
    df: DataFrame, keys: list[str | Column], newest_first: list[Column], tie_break: list[Column]
) -> DataFrame:
    """One row per key: the first by ``newest_first``, then ``tie_break``.

    A tie-break is required, since load times repeat within a load. Each map task keeps its own
    first row per key before the shuffle, so a key with very many rows stays cheap.
    """
    if not tie_break:
        raise ValueError("latest_per_key needs a tie-break to give the same rows on every run")
    if NUMBER in df.columns:
        raise ValueError(f"a column may not be called {NUMBER} here")
    window = Window.partitionBy(*keys).orderBy(*newest_first, *tie_break)
    return df.withColumn(NUMBER, F.row_number().over(window)).filter(F.col(NUMBER) == 1).drop(NUMBER)


def running_number(df: DataFrame, order_by: list[Column], name: str = "NO") -> DataFrame:
    """Number the rows 1, 2, 3... in the given order, without pulling them into one task.

    The rows are range-sorted and staged with their position; only one count per sorted part is
    then added up. Writes the sorted rows to the shared folder once.
    """
    position = F.monotonically_increasing_id()
    placed = df.orderBy(*order_by).select(
        "*",
        F.shiftright(position, 33).alias(PART),
        position.bitwiseAND(F.lit((1 << 33) - 1)).alias(NUMBER),
    )
    sorted_rows = stage(placed, "numbered")
    before = Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sorted_rows.groupBy(PART)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select(PART, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias(OFFSET))
    )
    # One row per sort partition, so the broadcast is bounded by the partition count.
    numbered = sorted_rows.join(F.broadcast(offsets), PART)
    value = (F.col(NUMBER) + F.col(OFFSET) + 1).alias(name)
    return numbered.select(value, *df.columns)
