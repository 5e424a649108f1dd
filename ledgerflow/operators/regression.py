"""Linear regression workflow."""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession, functions as F

FEATURES = "features"


def assemble(df: DataFrame, features: list[str], into: str = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=features, outputCol=into).transform(df)


def random_split(
    df: DataFrame, train_share: float = 0.7, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Random split; the rows drawn depend on how the data is partitioned."""
    train, test = df.randomSplit([train_share, 1.0 - train_share], seed=seed)
    return train, test


def key_split(df: DataFrame, key: str, train_tenths: int = 7) -> tuple[DataFrame, DataFrame]:
    """Split by a hash of the key: the same rows on every run."""
    digest = F.md5(F.col(key).cast("string"))
    bucket = F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint"), F.lit(10))
    in_train = bucket < train_tenths
    return df.filter(in_train), df.filter(~in_train)


def fit_linear(df: DataFrame, label: str, features_col: str = FEATURES) -> LinearRegressionModel:
    return LinearRegression(featuresCol=features_col, labelCol=label).fit(df)


def coefficients(
    spark: SparkSession, model: LinearRegressionModel, features: list[str]
) -> DataFrame:
    """One row: a column per feature plus the intercept."""
    names = [*(f"coef_{f}" for f in features), "intercept"]
    values = [float(v) for v in model.coefficients] + [float(model.intercept)]
    return spark.createDataFrame([tuple(values)], ", ".join(f"{n} double" for n in names))


def score(model: LinearRegressionModel, df: DataFrame) -> DataFrame:
    return model.transform(df)
