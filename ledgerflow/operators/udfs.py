"""Hooks for user functions, for rules that no built-in expression covers."""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T


def apply_row_function(
    df: DataFrame, column: str, into: str, function: Callable, returns: T.DataType
) -> DataFrame:
    """One Python call per row, rows moved in Arrow batches; prefer the vectorised form."""
    return df.withColumn(into, F.udf(function, returns, useArrow=True)(F.col(column)))


def apply_series_function(
    df: DataFrame,
    column: str,
    into: str,
    function: Callable[[pd.Series], pd.Series],
    returns: T.DataType,
) -> DataFrame:
    """One Python call per Arrow batch."""

    def on_batch(values: pd.Series) -> pd.Series:
        return function(values)

    return df.withColumn(into, F.pandas_udf(on_batch, returns)(F.col(column)))
