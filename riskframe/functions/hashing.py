"""Portable hash order: the same value in Spark and in other SQL engines."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

HASH_BITS = 60


def hash60(key: Column, seed: int) -> Column:
    """First 15 hex digits of md5('seed:key') as a long in [0, 2^60)."""
    text = F.concat_ws(":", F.lit(str(seed)), key.cast("string"))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def hash_unit(key: Column, seed: int) -> Column:
    """Uniform in [0, 1), fixed per (key, seed)."""
    return hash60(key, seed).cast("double") / F.lit(float(1 << HASH_BITS))
