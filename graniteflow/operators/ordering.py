"""Global order without a single task: ranks and running totals over any row count.

A window without (or with a huge) partition key sends the whole group to one
task. Here rows are range-partitioned first, each range is summed locally, and
the few per-range totals are turned into offsets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graniteflow.session import cut_lineage, partitions_for


def _sort_columns(order: list[str]) -> list[Column]:
    """``"x"`` ascending, ``"-x"`` descending."""
    return [F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc() for c in order]


def running_totals(
    df: DataFrame, order: list[str], sums: dict[str, Column], keys: list[str] | None = None,
    totals: bool = False,
) -> DataFrame:
    """Inclusive running sums in ``order`` within ``keys`` (which must not be null).

    ``sums`` maps output name → summed expression. With ``totals`` the whole
    group's sum is added as ``<name>_total``. One key may hold most rows: its
    rows are spread over many ranges. Placement is frozen by a checkpoint,
    because range boundaries are sampled and may differ when recomputed.
    """
    keys = list(keys or [])
    by = _sort_columns(order)
    width = partitions_for(df)
    frozen = cut_lineage(
        df.withColumns({f"_v_{n}": c for n, c in sums.items()})
        .repartitionByRange(width, *[F.col(k) for k in keys], *by)
        .withColumn("_range", F.spark_partition_id())
    )
    per_range = frozen.groupBy(*keys, "_range").agg(
        *[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums]
    )
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    extra = {f"_o_{n}": F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)) for n in sums}
    if totals:
        extra |= {f"{n}_total": F.sum(f"_t_{n}").over(whole) for n in sums}
    offsets = per_range.withColumns(extra).drop(*[f"_t_{n}" for n in sums])
    local = Window.partitionBy(*keys, "_range").orderBy(*by).rowsBetween(Window.unboundedPreceding, 0)
    out = frozen.join(offsets, [*keys, "_range"])
    out = out.withColumns({n: F.sum(f"_v_{n}").over(local) + F.col(f"_o_{n}") for n in sums})
    return out.drop("_range", *[f"_v_{n}" for n in sums], *[f"_o_{n}" for n in sums])


def row_index(
    df: DataFrame, order: list[str], keys: list[str] | None = None, name: str = "row_no",
    totals: bool = False,
) -> DataFrame:
    """Zero-based position of each row in ``order`` (and group size with ``totals``)."""
    out = running_totals(df, order, {name: F.lit(1).cast("bigint")}, keys, totals)
    return out.withColumn(name, F.col(name) - 1)


def top_per_group(df: DataFrame, keys: list[str], order: list[str], n: int, name: str = "rank") -> DataFrame:
    """First ``n`` rows of every group, numbered from 1.

    The rank limit is pushed below the shuffle, so a task receives at most
    ``n`` rows per group and map task, however large the group is.
    """
    w = Window.partitionBy(*keys).orderBy(*_sort_columns(order))
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)


def quantiles(df: DataFrame, col: str, probs: list[float], keys: list[str]) -> DataFrame:
    """Exact linear-interpolated quantiles ``q0, q1, …`` and size ``n`` per group.

    Equal values are counted first, so a frequent value is one row of its range.
    """
    counted = df.where(F.col(col).isNotNull()).groupBy(*keys, col).agg(F.count(F.lit(1)).alias("_c"))
    ranked = running_totals(counted, [col], {"_r": F.col("_c")}, keys, totals=True)
    cells = []
    for i, p in enumerate(probs):
        spot = (F.col("_r_total") - 1) * F.lit(float(p))
        low, high = F.floor(spot), F.ceil(spot)
        at = lambda rank: (rank < F.col("_r")) & (rank >= F.col("_r") - F.col("_c"))
        cells += [
            F.max(F.when(at(low), F.col(col))).alias(f"_lo{i}"), F.max(F.when(at(high), F.col(col))).alias(f"_hi{i}"),
            F.max(spot - low).alias(f"_f{i}"),
        ]
    found = ranked.groupBy(*keys).agg(F.max("_r_total").alias("n"), *cells)
    lerp = lambda i: (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")).alias(f"q{i}")
    return found.select(*keys, "n", *[lerp(i) for i in range(len(probs))])
