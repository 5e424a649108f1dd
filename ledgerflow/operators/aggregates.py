"""Counts and summaries. Every group aggregate combines on the map side before the shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def summarise(
    df: DataFrame, keys: list[str] | None = None, where: Column | None = None, **aggregates: Column
) -> DataFrame:
    """Named aggregates in one pass, after an optional filter and by optional keys."""
    rows = df if where is None else df.filter(where)
    columns = [expr.alias(name) for name, expr in aggregates.items()]
    return rows.groupBy(*keys).agg(*columns) if keys else rows.agg(*columns)


def group_sum(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    """Short form; the result column is called ``sum(column)``."""
    return df.groupBy(*keys).sum(column)


def group_by_spec(df: DataFrame, keys: list[str], spec: dict[str, str]) -> DataFrame:
    """Aggregates given as ``{column: function name}``."""
    return df.groupBy(*keys).agg(spec)


def sum_text_amounts(df: DataFrame, key: str, amount: str, name: str = "total") -> DataFrame:
    """Sum whole amounts held as text; unreadable text adds nothing."""
    return df.groupBy(key).agg(F.sum(F.col(amount).try_cast("bigint")).alias(name))


def sql_query(spark: SparkSession, views: dict[str, DataFrame], query: str) -> DataFrame:
    """Run SQL over the given frames, named as views."""
    return spark.sql(query, **views)


def describe(df: DataFrame, *columns: str) -> DataFrame:
    """Count, mean, sample standard deviation, minimum and maximum, as text."""
    return df.describe(*columns)


def first_rows(df: DataFrame, n: int, *order_by: Column) -> DataFrame:
    """First ``n`` rows, by an order if one is given."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)


def union_sources(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name; duplicates stay."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def load_audit(written: DataFrame, table: str, expected: int | None = None) -> DataFrame:
    """One row: table, rows found in it, and whether the load holds what was sent."""
    count = F.count(F.lit(1))
    if expected is None:
        status = F.when(count > 0, "SUCCESS").otherwise("EMPTY")
    else:
        status = F.when(count == expected, "SUCCESS").otherwise("MISMATCH")
    return written.agg(
        F.lit(table).alias("table_name"), count.alias("row_count"), status.alias("status")
    )
