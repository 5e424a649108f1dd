"""Files and lake tables."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame, SparkSession

# Text formats drop microseconds unless told otherwise.
FULL_TIME = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def write_csv(
    df: DataFrame,
    path: str,
    header: bool = True,
    sep: str = ",",
    mode: str = "overwrite",
    **options: Any,
) -> None:
    options = {**FULL_TIME, "header": header, "sep": sep, **options}
    df.write.mode(mode).options(**options).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite", keep_nulls: bool = True) -> None:
    """JSON lines; missing values are written as null, not left out."""
    options = {**FULL_TIME, "ignoreNullFields": not keep_nulls}
    df.write.mode(mode).options(**options).json(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def lake_format(spark: SparkSession) -> str:
    """``delta`` when the session is set up for it, else ``parquet``."""
    extensions = spark.conf.get("spark.sql.extensions", "") or ""
    return "delta" if "delta" in extensions.lower() else "parquet"


def write_lake(df: DataFrame, path: str, fmt: str | None = None, mode: str = "overwrite") -> None:
    df.write.format(fmt or lake_format(df.sparkSession)).mode(mode).save(path)
