"""Hashes that depend on the key and seed only, never on the file or partition layout."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

HASH_BITS = 60


def stable_hash(key: Column, seed: int | str) -> Column:
    """A 60-bit non-negative integer for `key`."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("bigint")


def unit_hash(key: Column, seed: int | str) -> Column:
    """A number in [0, 1) for `key`, from the first 32 bits of the digest."""
    digest = F.md5(F.concat(key.cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)
