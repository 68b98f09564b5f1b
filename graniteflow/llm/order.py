"""Each row beside its successor in the order of a key, with one shuffle and no global sort task."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graniteflow.session import partitions_for

_LOWEST = -(2**63)


def deal_by_order(df: DataFrame, key: Column, payload: list[Column]) -> DataFrame:
    """Rows as (``_range``, ``_guest``, ``_key``, payload): ranges of ``key`` in ascending order.

    The rows with the first key of a range are added once more to the range before
    as guests, and those of the first range to the last one, so that every row of a
    range finds its successor within the range; the order is a ring. Null keys come
    first. Range borders are keys of the table (their number follows the session's
    shuffle width); only these borders reach the driver. Equal keys share a range.
    """
    keyed = df.select(F.coalesce(key.cast("bigint"), F.lit(_LOWEST)).alias("_key"), *payload)
    n = 4 * partitions_for(df)
    row = keyed.agg(
        F.min("_key").alias("low"),
        F.percentile_approx("_key", [i / n for i in range(1, n)] or [0.5], 10_000).alias("cuts"),
    ).first()
    if row["low"] is None:
        return keyed.select(F.lit(0).alias("_range"), F.lit(False).alias("_guest"), "*")
    # Neighbouring keys beyond 2^53 may fall on one double; they then simply share a range.
    edges = sorted({float(k) for k in [row["low"], *row["cuts"]]})
    keyed = keyed.withColumn("_at", F.col("_key").cast("double"))
    if len(edges) > 1:
        dealt = Bucketizer(splits=[float("-inf"), *edges[1:], float("inf")], inputCol="_at", outputCol="_in").transform(keyed)
    else:
        dealt = keyed.withColumn("_in", F.lit(0.0))
    own = F.col("_in").cast("int")
    before = F.when(own == 0, F.lit(len(edges) - 1)).otherwise(own - 1)
    first = F.col("_at") == F.element_at(F.array(*[F.lit(e) for e in edges]), own + 1)
    home = F.struct(own.alias("_range"), F.lit(False).alias("_guest"))
    away = F.struct(before.alias("_range"), F.lit(True).alias("_guest"))
    spots = F.when(first, F.array(home, away)).otherwise(F.array(home))
    names = [c for c in dealt.columns if c not in ("_at", "_in")]
    return dealt.select(F.explode(spots).alias("_spot"), *names).select("_spot.*", *names)
