"""Projection, filters and missing values."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F, types as T

NULL_SENTINEL = "<NULL>"


def select_as(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Keep the named columns under new names: ``{old: new}``."""
    return df.select(*[F.col(old).alias(new) for old, new in columns.items()])


def project_sql(df: DataFrame, *expressions: str) -> DataFrame:
    return df.selectExpr(*expressions)


def derive(df: DataFrame, **columns: Column) -> DataFrame:
    return df.withColumns(columns)


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast by name; a value that does not fit becomes NULL instead of stopping the job."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in types.items()})


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Rename by map; names without an entry stay."""
    return df.withColumnsRenamed(names)


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def add_source(df: DataFrame, source: str, load_time: bool = True) -> DataFrame:
    """Tag rows with their source and, if asked, the time of this load.

    The load time is one constant per query, so it cannot rank rows of the same load.
    """
    tagged = df.withColumn("source", F.lit(source))
    return tagged.withColumn("load_time", F.current_timestamp()) if load_time else tagged


def load_time_text(pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    return F.date_format(F.current_timestamp(), pattern)


def where_all(df: DataFrame, *conditions: Column) -> DataFrame:
    return df.filter(reduce(and_, conditions))


def where_present(df: DataFrame, *names: str) -> DataFrame:
    return where_all(df, *[F.col(n).isNotNull() for n in names])


def count_missing(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col(name).isNull()).agg(F.count(F.lit(1)).alias("missing"))


def drop_missing(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    return df.na.drop(subset=subset)


def drop_report(df: DataFrame, subset: list[str] | None = None) -> DataFrame:
    """Rows before, after and removed by dropping missing values, in one pass."""
    names = subset or df.columns
    whole = reduce(and_, [F.col(n).isNotNull() for n in names])
    counts = df.agg(
        F.count(F.lit(1)).alias("rows_before"), F.count_if(whole).alias("rows_after")
    )
    return counts.withColumn("rows_removed", F.col("rows_before") - F.col("rows_after"))


def fill_sentinel(
    df: DataFrame, columns: list[str] | None = None, sentinel: str = NULL_SENTINEL
) -> DataFrame:
    """Put a marker text where a string column is missing."""
    strings = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    chosen = strings if columns is None else columns
    return df.withColumns({n: F.coalesce(F.col(n), F.lit(sentinel)) for n in chosen})
