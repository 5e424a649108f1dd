"""Tokenise, publish safely, and keep a vault."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerflow.functions.codec import sha256_hex
from ledgerflow.operators.joins import missing_from
from ledgerflow.session import stage
from ledgerflow.sinks.snapshots import Snapshot, publish, read_snapshot, snapshot


def tokenise(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add a SHA-256 token per identity column: ``{column: token column}``."""
    return df.withColumns({token: sha256_hex(name) for name, token in columns.items()})


def safe_projection(df: DataFrame, keep: list[str], identifying: list[str]) -> DataFrame:
    """Let only the listed columns out; naming an identifying one is an error."""
    leaks = [c for c in keep if c.lower() in {p.lower() for p in identifying}]
    if leaks:
        raise ValueError(f"identifying columns may not leave: {leaks}")
    return df.select(*keep)


def build_vault(df: DataFrame, value: str, token: Column) -> DataFrame:
    """Distinct (token, value) pairs."""
    return df.select(token.alias("token"), F.col(value).alias("value")).distinct()


def clashing_tokens(pairs: DataFrame) -> DataFrame:
    """Tokens that stand for more than one value, with how many; ``pairs`` are distinct."""
    return pairs.groupBy("token").agg(F.count(F.lit(1)).alias("values")).filter(F.col("values") > 1)


def grow_vault(df: DataFrame, value: str, token: Column, base: str) -> Snapshot:
    """Add the values of ``df`` that the vault under ``base`` does not hold yet, as a new version.

    ``token`` is computed for these alone, once, so a random token stays what it was. A token that
    would stand for two values, old or new, stops the job, and the vault stays as it was; so does
    another writer who has published in the meantime. NULL is no value.
    """
    spark = df.sparkSession
    now = snapshot(spark, base)
    values = df.select(F.col(value).alias("value")).filter("value IS NOT NULL").distinct()
    old = read_snapshot(spark, base, now.version) if now else None
    unseen = values if old is None else missing_from(values, old, ["value"])
    # ``token`` names the column of ``df``; the new pairs are written once and read from there.
    named = unseen.withColumnRenamed("value", value)
    new = stage(named.select(token.alias("token"), F.col(value).alias("value")), "vault-new")
    met = new if old is None else new.unionByName(old.join(new.select("token"), "token", "left_semi").select("token", "value"))
    clash = clashing_tokens(met).select("token").limit(5).collect()
    if clash:
        raise ValueError(f"tokens that stand for several values: {[row[0] for row in clash]}")
    if now is not None and new.isEmpty():
        return now
    return publish(new, base, append=True, seen=now.version if now else 0)
