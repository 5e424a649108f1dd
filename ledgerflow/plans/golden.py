"""The golden record kept up to date batch by batch, without reading history.

The state has one row per key and batch: the newest of that batch. Keeping the newest row of a key is
a merge that takes rows in any order and any number of times, so the newest over all batches is what
one run over all history gives, late and repeated rows included. A batch costs its own rows; from
time to time ``compact`` merges the batches into one.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerflow.functions.codec import key_hash
from ledgerflow.operators.aggregates import union_sources
from ledgerflow.operators.clean import where_present
from ledgerflow.operators.windows import latest_per_key
from ledgerflow.sinks.snapshots import Snapshot, publish, read_snapshot, snapshot

KEY, BUCKET = "unique_key", "_bucket"


@dataclass(frozen=True)
class GoldenRules:
    """How rows are keyed, which of a key's rows wins, and what a golden record shows.

    ``newest_first`` and ``tie_break`` must order the rows of a key in full, or batches could decide
    differently from one run.
    """

    identity: tuple[str, ...]
    keep: tuple[str, ...]
    required: tuple[str, ...]
    newest_first: tuple[Column, ...]
    tie_break: tuple[Column, ...]
    renames: dict[str, str] = field(default_factory=dict)
    null_marker: str | None = None

    def newest(self, rows: DataFrame) -> DataFrame:
        return latest_per_key(rows, [KEY], list(self.newest_first), list(self.tie_break))

    def keyed(self, sources: list[DataFrame]) -> DataFrame:
        key = key_hash(*self.identity, null_marker=self.null_marker)
        return union_sources(*sources).withColumn(KEY, key)


def fold(sources: list[DataFrame], base: str, rules: GoldenRules, buckets: int = 64) -> Snapshot:
    """Add a batch to the state under ``base``: its newest row per key, by bucket of the key.

    Rows that lack a required column are kept, since they hide older ones. Only the batch is read.
    """
    newest = rules.newest(rules.keyed(sources))
    bucket = F.pmod(F.xxhash64(KEY), F.lit(buckets)).cast("int")
    rows = newest.withColumn(BUCKET, bucket).repartition(buckets, BUCKET)
    return publish(rows, base, append=True, partition_by=[BUCKET])


def golden_state(
    spark: SparkSession, base: str, rules: GoldenRules, version: int | None = None
) -> DataFrame:
    """The newest row per key over all batches; a filter on the bucket reads that bucket alone."""
    return rules.newest(read_snapshot(spark, base, version))


def golden_view(
    spark: SparkSession, base: str, rules: GoldenRules, version: int | None = None
) -> DataFrame:
    """Golden records: complete newest rows, with the columns that they show."""
    state = golden_state(spark, base, rules, version).select(KEY, *rules.keep)
    return where_present(state, *rules.required).withColumnsRenamed(rules.renames)


def compact(spark: SparkSession, base: str, rules: GoldenRules, most: int = 8) -> Snapshot | None:
    """Merge the batches into one folder where there are more than ``most``."""
    now = snapshot(spark, base)
    if now is None or len(now.folders) <= most:
        return now
    merged = golden_state(spark, base, rules, now.version).repartition(BUCKET)
    return publish(merged, base, seen=now.version, partition_by=[BUCKET])
