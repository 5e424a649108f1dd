"""Numeric masks that keep a value near the original."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerflow.functions.text import as_column

LOWEST_FACTOR, FACTOR_RANGE = 0.9, 0.2


def mask_random(c: Column | str, seed: int | None = None) -> Column:
    """Times a random factor in [0.9, 1.1); NULL stays NULL."""
    draw = F.rand() if seed is None else F.rand(seed)
    return as_column(c) * (F.lit(LOWEST_FACTOR) + F.lit(FACTOR_RANGE) * draw)


def mask_by_key(c: Column | str, key: Column | str, salt: str) -> Column:
    """Times a factor in [0.9, 1.1) drawn from a salted hash of the key.

    The same row gets the same mask on every run, also when its task is run again.
    """
    digest = F.sha2(F.concat_ws(":", as_column(key).cast("string"), F.lit(salt)), 256)
    draw = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(float(2**32))
    return as_column(c) * (F.lit(LOWEST_FACTOR) + F.lit(FACTOR_RANGE) * draw)
