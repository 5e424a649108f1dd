"""The keys of a huge target, kept in buckets beside it, so that a load moves its own rows only."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerflow.operators.joins import upper_columns

KEY = "_key"


@dataclass(frozen=True)
class KnownKeys:
    """A folder of key digests, and how many buckets it is laid out in."""

    path: str
    keys: tuple[str, ...]
    buckets: int


def key_digest(df: DataFrame, keys: tuple[str, ...]) -> Column:
    """One value per key: its parts as texts, a missing part unlike any text, hashed to 256 bits."""
    parts = [df[name.upper()].cast("string").alias(f"k{i}") for i, name in enumerate(keys)]
    return F.sha2(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}), 256).alias(KEY)


def _table_name() -> str:
    return f"known_keys_{uuid.uuid4().hex}"


def remember_keys(rows: DataFrame, known: KnownKeys) -> None:
    """Add the keys of ``rows`` (the target at first, later what was loaded into it).

    A key that is there already may be added again. Rows move once, as digests; the files of a bucket
    are sorted, and the table they are written through is forgotten again, so the folder is all there
    is. Call it after the load itself; where a job fails between the two, add the target's keys again.
    """
    spark = rows.sparkSession
    df = upper_columns(rows)
    digests = df.select(key_digest(df, known.keys)).distinct().repartition(known.buckets, KEY)
    name = _declare(spark, known)
    try:
        writer = digests.write.format("parquet").bucketBy(known.buckets, KEY).sortBy(KEY)
        writer.mode("append").saveAsTable(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def _declare(spark: SparkSession, known: KnownKeys) -> str:
    name = _table_name()
    place = known.path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({KEY} STRING) USING parquet "
        f"CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {known.buckets} BUCKETS LOCATION '{place}'"
    )
    return name


def known_keys(spark: SparkSession, known: KnownKeys) -> DataFrame:
    """The digests, as a frame whose layout the optimizer knows."""
    name = _declare(spark, known)
    try:
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE {name}")


def new_by_known_keys(incoming: DataFrame, known: KnownKeys) -> DataFrame:
    """Rows of ``incoming`` whose key is not among the known ones; as ``new_rows`` has it.

    The distinct digests of ``incoming`` go to the buckets of the known keys, which stay where they
    are; rows then meet the digests found new, in a join that adaptive execution can split, so one
    very common key does not gather in a task.
    """
    df = upper_columns(incoming)
    keyed = df.withColumn(KEY, key_digest(df, known.keys))
    asked = keyed.select(KEY).distinct().repartition(known.buckets, KEY)
    # An anti-join would be moved below the distinct, and a hot key would move row by row.
    hits = known_keys(df.sparkSession, known).withColumn("_hit", F.lit(True)).hint("merge")
    fresh = asked.join(hits, KEY, "left").filter(F.col("_hit").isNull())
    fresh = fresh.select(F.col(KEY).alias("_fresh"))
    return keyed.join(fresh, keyed[KEY].eqNullSafe(fresh["_fresh"]), "left_semi").drop(KEY)
