"""Seeded randomness as column expressions.

Every random choice is a function of (seed, key), so a lost task that is run
again draws the same numbers, and another SQL engine can repeat them.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

HASH_BITS = 60


def digest(seed: str | int, *keys: Column | str) -> Column:
    cols = [F.col(k) if isinstance(k, str) else k for k in keys]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[c.cast("string") for c in cols]))


def order_value(seed: str | int, *keys: Column | str) -> Column:
    """Non-negative 60-bit integer, uniform over distinct keys."""
    return F.conv(F.substring(digest(seed, *keys), 1, 15), 16, 10).cast("long")


def unit_uniform(seed: str | int, *keys: Column | str) -> Column:
    """Uniform double in [0, 1) with 52 random bits."""
    bits = F.conv(F.substring(digest(seed, *keys), 1, 13), 16, 10).cast("long")
    return bits.cast("double") / F.lit(float(2**52))
