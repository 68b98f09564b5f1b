"""Descriptive aggregations."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graniteflow.functions.mathx import safe_corr
from graniteflow.operators.ordering import quantiles, row_index, running_totals


def value_counts(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n"))


def source_stats(df: DataFrame, tag: str = "tag") -> DataFrame:
    """Rows, rows per hour, mean followers and mean retweets per source."""
    hours = (F.max("epoch") - F.min("epoch")) / 3600
    return df.groupBy(tag).agg(
        F.count(F.lit(1)).alias("n"),
        F.try_divide(F.count(F.lit(1)), hours).alias("per_hour"),
        F.avg("followers").alias("mean_followers"),
        F.avg("retweets").alias("mean_retweets"),
    )


def hourly_histogram(df: DataFrame, tag: str, hour: str) -> DataFrame:
    """Rows per hour and tag between the tag's first and last hour, zeros included."""
    counts = df.groupBy(tag, hour).agg(F.count(F.lit(1)).alias("n"))
    spans = counts.groupBy(tag).agg(F.min(hour).alias("_a"), F.max(hour).alias("_b"))
    grid = spans.select(tag, F.explode(F.sequence("_a", "_b")).alias(hour))
    return grid.join(counts, [tag, hour], "left").select(tag, hour, F.coalesce("n", F.lit(0)).alias("n"))


def rating_matrix(ratings: DataFrame, items: list | None = None) -> DataFrame:
    """Mean rating per (user, item) in long form; one column per listed item if given."""
    if items is None:
        return ratings.groupBy("user", "item").agg(F.avg("rating").alias("rating"))
    return ratings.groupBy("user").pivot("item", items).agg(F.avg("rating")).na.fill(0)


def density(ratings: DataFrame) -> DataFrame:
    """Ratings ÷ (users × items)."""
    return ratings.agg(
        F.count(F.lit(1)).alias("n_ratings"),
        F.countDistinct("user").alias("n_users"),
        F.countDistinct("item").alias("n_items"),
    ).withColumn("density", F.try_divide("n_ratings", F.col("n_users") * F.col("n_items")))


def rating_frequency(ratings: DataFrame, key: str) -> DataFrame:
    """Ratings per key, most first, with the zero-based rank."""
    counts = ratings.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return row_index(counts, ["-n", key], name="rank_index")


def item_variance(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("item").agg(
        F.count(F.lit(1)).alias("n"), F.var_pop("rating").alias("variance")
    )


def user_mean(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("user").agg(F.avg("rating").alias("mean_rating"))


def histogram(df: DataFrame, col: str, bins: int, lo: float | None = None, hi: float | None = None) -> DataFrame:
    """Bins of one width from ``lo`` to ``hi``, last bin closed, empty bins included; nulls are not counted.

    Without bounds they are the smallest and the largest value (half a unit around a single
    value). A value outside given bounds is an error, so that no row is lost.
    """
    ends = df.agg(F.min(col).alias("low"), F.max(col).alias("high")).first()
    if ends["low"] is not None and (lo is not None and ends["low"] < lo or hi is not None and ends["high"] > hi):
        raise ValueError(f"{col} has values from {ends['low']} to {ends['high']}, outside the bounds")
    lo, hi = (float((end or 0) if bound is None else bound) for bound, end in ((lo, ends["low"]), (hi, ends["high"])))
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    slot = F.least(F.floor((F.col(col) - lo) / width), F.lit(bins - 1)).cast("bigint")
    counts = df.where(F.col(col).isNotNull()).groupBy(slot.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = df.sparkSession.range(bins).select(F.col("id").alias("bin"))
    return grid.join(counts, "bin", "left").select(
        "bin", (F.lit(lo) + F.col("bin") * width).alias("left_edge"), F.coalesce("n", F.lit(0)).alias("n")
    )


def box_stats(df: DataFrame, cat: str, y: str, order: list | None = None) -> DataFrame:
    """Quartiles, 1.5·IQR whiskers and outlier count per category."""
    boxes = quantiles(df, y, [0.25, 0.5, 0.75], [cat]).select(
        cat, "n", F.col("q0").alias("q1"), F.col("q1").alias("median"), F.col("q2").alias("q3")
    )
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col(y).between(F.col("q1") - reach, F.col("q3") + reach)
    spans = (
        df.select(cat, y).join(boxes.select(cat, "q1", "q3"), cat).groupBy(cat).agg(
            F.min(F.when(inside, F.col(y))).alias("low_whisker"),
            F.max(F.when(inside, F.col(y))).alias("high_whisker"),
            F.count_if(~inside).alias("n_outliers"),
        )
    )
    out = boxes.join(spans, cat)
    if order:
        out = out.withColumn("place", F.array_position(F.array(*[F.lit(o) for o in order]), F.col(cat)))
    return out


def trend(df: DataFrame, key: str, y: str) -> DataFrame:
    """Mean per key with a normal 95 % band."""
    half = 1.96 * F.try_divide(F.stddev_samp(y), F.sqrt(F.count(y)))
    return df.groupBy(key).agg(
        F.count(y).alias("n"), F.avg(y).alias("mean"),
        (F.avg(y) - half).alias("low"), (F.avg(y) + half).alias("high"),
    )


def contingency(df: DataFrame, a: str, b: str, keys: list[str] | None = None) -> DataFrame:
    """Pair counts of two label columns; only pairs that occur."""
    return df.groupBy(*(keys or []), a, b).agg(F.count(F.lit(1)).alias("n"))


def filled_contingency(df: DataFrame, a: str, b: str, labels: list) -> DataFrame:
    """Pair counts for every pair of the listed labels, zeros included."""
    wanted = F.array(*[F.lit(x) for x in labels])
    grid = (
        df.sparkSession.range(1)
        .select(F.explode(wanted).alias(a))
        .select(a, F.explode(wanted).alias(b))
    )
    return grid.join(contingency(df, a, b), [a, b], "left").select(a, b, F.coalesce("n", F.lit(0)).alias("n"))


def corr_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """Pearson correlation of every column pair (a ≤ b) from one aggregation."""
    pairs = list(combinations_with_replacement(cols, 2))
    row = df.agg(*[safe_corr(a, b).alias(f"c{i}") for i, (a, b) in enumerate(pairs)])
    cells = [
        F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"c{i}").alias("corr"))
        for i, (a, b) in enumerate(pairs)
    ]
    return row.select(F.inline(F.array(*cells)))


def mean_by(df: DataFrame, keys: list[str], score: str, name: str = "mean_score") -> DataFrame:
    """Mean score per key: fold means, marginals of one parameter."""
    return df.groupBy(*keys).agg(F.avg(score).alias(name))


def best_param(df: DataFrame, param: str, score: str, largest: bool) -> DataFrame:
    """Parameter with the best score; the smaller parameter wins ties."""
    pick = F.min(F.struct((-F.col(score) if largest else F.col(score)).alias("s"), F.col(param).alias("p")))
    return df.agg(pick.alias("b")).select(
        F.col("b.p").alias(param), (-F.col("b.s") if largest else F.col("b.s")).alias(score)
    )


def rank_results(df: DataFrame, score: str, name: str = "rank") -> DataFrame:
    """Competition rank of candidates by score, best first; ties share the smaller rank.

    Candidates are counted per distinct score, then ranked by a running total.
    """
    groups = df.groupBy(score).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_totals(groups, [f"-{score}"], {"_upto": F.col("_n")})
    return df.join(ranked.select(score, (F.col("_upto") - F.col("_n") + 1).alias(name)), score)


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out
