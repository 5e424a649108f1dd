"""In-line rows and files."""

from __future__ import annotations

from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, types as T


def from_rows(spark: SparkSession, rows: list, schema: T.StructType | str | list[str]) -> DataFrame:
    """Small in-line data, with a declared schema or only names (types are then inferred)."""
    return spark.createDataFrame(rows, schema)


def from_pandas(spark: SparkSession, frame: pd.DataFrame) -> DataFrame:
    return spark.createDataFrame(frame)


def number_range(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    header: bool = True,
    sep: str = ",",
    null_token: str | None = None,
    infer: bool = False,
    **options: Any,
) -> DataFrame:
    """CSV with a declared schema, inferred types (one more pass over the files), or all text."""
    reader = spark.read.options(header=header, sep=sep, **options)
    if null_token is not None:
        reader = reader.option("nullValue", null_token)
    if schema is not None:
        reader = reader.schema(schema)
    elif infer:
        reader = reader.option("inferSchema", True)
    return reader.csv(path)


def read_json(
    spark: SparkSession, path: str | list[str], schema: T.StructType | str | None = None
) -> DataFrame:
    """JSON lines; give a schema to save the inference pass."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a folder."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system the path names."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return target.getFileSystem(conf).exists(target)
