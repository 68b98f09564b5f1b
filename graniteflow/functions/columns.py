"""Scalar columns and projections."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def columns_of(df: DataFrame, kind: type[DataType]) -> list[str]:
    """Names of the columns whose type is ``kind``, in table order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kind)]


def product_of(*cols) -> Column:
    """Product of several columns, e.g. a box volume from three edges."""
    return reduce(lambda a, b: a * b, [_col(c) for c in cols])


def merge_labels(col, groups: dict[str, list]) -> Column:
    """Replace every label listed in ``groups`` by the group's name."""
    c = _col(col)
    out = None
    for name, members in groups.items():
        hit = c.isin(members)
        out = F.when(hit, F.lit(name)) if out is None else out.when(hit, F.lit(name))
    return c if out is None else out.otherwise(c)


def rollup_label(col, width: int) -> Column:
    """Leaf label number to root label number."""
    return F.floor(_col(col) / F.lit(width)).cast("bigint")


def binarise(col, threshold) -> Column:
    return (_col(col) >= F.lit(threshold)).cast("double")


def binarise_all(df: DataFrame, col: str, thresholds: list[float]) -> DataFrame:
    """One row per (input row, threshold) with the 0/1 label, in a single pass."""
    out = df.withColumn("threshold", F.explode(F.array(*[F.lit(float(t)) for t in thresholds])))
    return out.withColumn("positive", (F.col(col) >= F.col("threshold")).cast("double"))


def to_numeric(col) -> Column:
    """Number, or null where the text is no decimal number; white space around it is allowed.

    A plain cast would also take type suffixes, as in ``5d`` or ``1.5F``.
    """
    text = _col(col).cast("string")
    decimal = F.rlike(text, F.lit(r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*\z"))
    return F.when(decimal, F.trim(text).try_cast("double"))


def count_alnum(col) -> Column:
    return F.length(F.regexp_replace(_col(col), r"[^\p{L}\p{N}]", "")).cast("bigint")


def length_without_spaces(col) -> Column:
    return F.length(F.replace(_col(col), F.lit(" "), F.lit(""))).cast("bigint")


def list_length(col) -> Column:
    return F.when(_col(col).isNull(), F.lit(0)).otherwise(F.size(_col(col))).cast("bigint")


def epoch_seconds(col) -> Column:
    """Seconds since 1970 of a zone-less timestamp, whatever the session zone is."""
    origin = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", origin, _col(col).cast("timestamp_ntz"))


def hour_bucket(epoch) -> Column:
    return F.floor(_col(epoch) / F.lit(3600)).cast("bigint")


def relabel(col, mapping: dict) -> Column:
    """Value lookup by a literal map; values that are not listed stay."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.coalesce(F.element_at(F.create_map(*pairs), _col(col)), _col(col))


def absolute_gap(a, b) -> Column:
    return F.abs(_col(a) - _col(b))


def profile(df: DataFrame) -> DataFrame:
    """One row per column: name, type, rows, non-null rows. A single pass."""
    counts = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count(F.col(f.name)).alias(f"c{i}") for i, f in enumerate(df.schema.fields)],
    )
    cells = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("column_type"),
            F.col("n_rows"),
            F.col(f"c{i}").alias("n_present"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return counts.select(F.inline(F.array(*cells)))


def record_fields(df: DataFrame, paths: dict[str, str]) -> DataFrame:
    """Flatten nested fields: output name → dotted path."""
    return df.select(*[F.col(path).alias(name) for name, path in paths.items()])


def tag_totals(tags, start: str = "indices", text: str = "text") -> dict[str, Column]:
    """Count, sum of first and sum of second index over an array of tag structs."""
    c = _col(tags)
    zero = F.lit(0).cast("bigint")
    total = lambda j: F.aggregate(c, zero, lambda acc, t: acc + t[start][j].cast("bigint"))
    return {
        "n_tags": F.size(c).cast("bigint"),
        "sum_start": total(0),
        "sum_end": total(1),
    }


def merged_map(left, right) -> Column:
    """Union of two maps; the right one wins where both have a key."""
    l, r = _col(left), _col(right)
    return F.map_concat(F.map_filter(l, lambda k, v: ~F.map_contains_key(r, k)), r)
