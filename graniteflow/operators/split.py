"""Splits, folds, shuffles and resampling as functions of the row key.

Nothing depends on row placement, so a lost and recomputed task gives the same rows.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graniteflow.functions.hashing import hash_int, hash_unit


def split(df: DataFrame, key: str | list[str], frac: float = 0.2, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(train, test); about ``frac`` of the rows are test rows."""
    flagged = with_test_flag(df, key, frac, seed)
    return flagged.where("NOT is_test").drop("is_test"), flagged.where("is_test").drop("is_test")


def with_test_flag(df: DataFrame, key, frac: float = 0.2, seed: int = 0) -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.withColumn("is_test", hash_unit(*keys, seed=seed) < F.lit(frac))


def with_fold(df: DataFrame, key, k: int, seed: int = 0, name: str = "fold") -> DataFrame:
    keys = [key] if isinstance(key, str) else list(key)
    return df.withColumn(name, (hash_int(*keys, seed=seed) % k).cast("int"))


def shuffle(df: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """Rows in a repeatable random order."""
    return df.orderBy(hash_int(key, seed=seed), key)


def poisson_steps() -> list[float]:
    """Chances that a Poisson(1) weight is at most 0, 1, …, until the tail is below the finest step of the hash."""
    steps = [math.exp(-1.0)]
    while 1.0 - steps[-1] > 2.0**-32:
        steps.append(steps[-1] + math.exp(-1.0) / math.factorial(len(steps)))
    return steps[:-1]


def bootstrap_weight(key, resample, seed: int = 0) -> Column:
    """Poisson(1) weight of a row in one resample, from a hash of (key, resample).

    Weights go on until the tail is below the finest step of the hash.
    """
    u = hash_unit(key, resample, seed=seed)
    steps = [(u >= F.lit(chance)).cast("bigint") for chance in poisson_steps()]
    return sum(steps[1:], steps[0])


def bootstrap_weights(keys: list[str | None], rounds: int, seed: int = 0) -> np.ndarray:
    """The weights of ``bootstrap_weight`` as a matrix (keys × resamples), for keys as text."""
    ends = [b"%d" % b for b in range(rounds)]
    found = []
    for key in keys:
        start = hashlib.md5(f"{seed}:".encode() if key is None else f"{seed}:{key}:".encode(), usedforsecurity=False)
        for end in ends:
            each = start.copy()
            each.update(end)
            found.append(each.digest())
    first = np.frombuffer(b"".join(found), dtype=">u4")[::4].astype(float) / 4294967296.0
    return np.searchsorted(poisson_steps(), first, side="right").astype(np.uint8).reshape(len(keys), rounds)


def bootstrap(df: DataFrame, key: str, rounds: int, seed: int = 0) -> DataFrame:
    """Weight of every row in every resample; weight 0 = out of bag."""
    out = df.withColumn("resample", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1))))
    return out.withColumn("weight", bootstrap_weight(key, "resample", seed)).withColumn(
        "out_of_bag", F.col("weight") == 0
    )
