"""Placement-independent pseudo-random numbers: functions of the row key alone."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def hash_int(*keys, seed: int = 0) -> Column:
    """First 32 bits of md5("seed:key[:key…]") as a BIGINT."""
    text = F.concat_ws(":", F.lit(str(seed)), *[_col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_unit(*keys, seed: int = 0) -> Column:
    """Uniform number in [0, 1)."""
    return hash_int(*keys, seed=seed) / F.lit(4294967296.0)


def hash_weight(*keys, seed: int = 0) -> Column:
    """Uniform number in (0, 1]: a positive starting value for factor models."""
    return (hash_int(*keys, seed=seed) + 1) / F.lit(4294967296.0)
