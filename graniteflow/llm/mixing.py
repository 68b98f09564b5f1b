"""Mixing sources to target weights: capped water-filling and seeded repetitions.

The targets are found on the table of sources: every source gets words in proportion to
its weight; a source above its cap (maximum epochs times its size) is clamped and the
excess is shared by the others, until none is above. A source then takes every document
as often as it has whole epochs, and one more fractional epoch of whole documents in a
seeded order. Only sums over sources reach the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graniteflow.operators.ordering import row_index
from graniteflow.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)


def word_count(text: Column) -> Column:
    """Words of a text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def seeded_key(seed: str, key: Column, text: Column) -> Column:
    """Pseudo-random hexadecimal key of a row, the same on every run."""
    return F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(key.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))))


def water_fill(sources: DataFrame, share: float, max_epochs: float, size: str = "_source_size", weight: str = "_weight") -> DataFrame:
    """Adds ``_target`` to a table of sources.

    The targets sum to ``share`` of all sizes, or to all caps if these are lower. Each
    round is one aggregation to four numbers; a source once clamped stays so. A table
    without words gets targets of 0.
    """
    cap = F.col(size) * F.lit(float(max_epochs))
    total = sources.agg(F.sum(size)).first()[0] or 0
    budget, level, clamped = share * total, 0.0, -1
    while True:
        above = (F.col(weight) * F.lit(level)) > cap
        row = sources.agg(
            F.count(F.when(above, 1)).alias("n"), F.sum(F.when(above, cap)).alias("fixed"), F.sum(F.when(~above, F.col(weight))).alias("open")
        ).first()
        if row["n"] == clamped:
            break
        clamped = row["n"]
        if not row["open"]:
            break
        level = (budget - (row["fixed"] or 0.0)) / float(row["open"])
    return sources.withColumn("_target", F.least(cap, F.col(weight) * F.lit(level)).cast("double"))


def mix(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple = WEIGHTS, share: float = 1.5, max_epochs: float = 2.0, seed: str = "mix-1", carry: list[str] | None = None,
) -> DataFrame:
    """One row per row of ``df``: id, size, source_size, target (of its source), whole, taken, and ``carry`` columns.

    ``taken`` is ``whole`` times the size, and once more the size for the documents of the
    fractional epoch. Documents are always taken whole: the one in which the epoch ends is
    taken or left, whichever is nearer to the target, so a source is off by half of one
    document at most and stays within twice its size. Sources are weighed in order of their
    code points, null last (a source of its own), repeating ``weights``. Null texts have size
    0; repeated rows count as often as they occur; ties of the seeded order only arise
    between rows with equal id and text. Names in ``carry`` may not begin with ``_``.
    """
    carry = carry or []
    base = df.select(
        F.col(id_col).alias("_id"), F.coalesce(F.col(source_col), F.lit("")).alias("_source"), F.col(source_col).isNull().alias("_no_source"),
        word_count(F.col(text_col)).alias("_size"), seeded_key(seed, F.col(id_col), F.col(text_col)).alias("_h"), *carry,
    ).withColumn("_bucket", F.col("_h").substr(1, 3))
    narrow = base.select("_id", "_source", "_no_source", "_size", "_h", "_bucket")
    if not carry:
        base = narrow = cut_lineage(narrow)
    key = ["_no_source", "_source"]
    buckets = cut_lineage(narrow.groupBy(*key, "_bucket").agg(F.sum("_size").alias("_in_bucket")))
    sources = row_index(buckets.groupBy(*key).agg(F.sum("_in_bucket").alias("_source_size")), key, name="_rank")
    weigh = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % len(weights) + 1).cast("int"))
    sources = water_fill(cut_lineage(sources.withColumn("_weight", weigh)), share, max_epochs)
    whole = F.when(F.col("_source_size") > 0, F.floor(F.col("_target") / F.col("_source_size"))).otherwise(F.lit(0)).cast("bigint")
    sources = sources.withColumn("_whole", whole).withColumn("_part", F.round("_target").cast("bigint") - F.col("_whole") * F.col("_source_size"))
    before = Window.partitionBy(*key).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    spots = buckets.withColumn("_before", F.coalesce(F.sum("_in_bucket").over(before), F.lit(0))).drop("_in_bucket")
    spots = spots.join(sources.select(*key, "_source_size", "_target", "_whole", "_part"), key)
    # A source is dealt over 4,096 buckets of the seeded key, so a large source is no single task.
    inside = Window.partitionBy(*key, "_bucket").orderBy("_h", "_id", "_size").rowsBetween(Window.unboundedPreceding, -1)
    rows = base.join(spots, [*key, "_bucket"])
    earlier = F.col("_before") + F.coalesce(F.sum("_size").over(inside), F.lit(0))
    rows = rows.withColumn("_extra", F.when(2 * earlier + F.col("_size") <= 2 * F.col("_part"), F.col("_size")).otherwise(0))
    return rows.select(
        F.col("_id").alias(id_col), F.col("_size").alias("size"), F.col("_source_size").cast("bigint").alias("source_size"),
        F.col("_target").alias("target"), F.col("_whole").alias("whole"), (F.col("_whole") * F.col("_size") + F.col("_extra")).alias("taken"),
        *[c for c in carry if c != id_col],
    )


def mixed_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``df`` as often as ``mix`` takes them, with all their columns; documents without a word are not taken."""
    source = df.select(F.col(id_col).alias("_doc"), F.col(text_col).alias("_words"), F.col(source_col).alias("_from"), F.struct("*").alias("_row"))
    chosen = mix(source, "_doc", "_words", "_from", carry=["_row"], **options).where(F.col("taken") > 0)
    copies = F.sequence(F.lit(1).cast("bigint"), F.floor(F.col("taken") / F.col("size")))
    return chosen.select("_row", F.explode(copies)).select("_row.*")


#: The same rows in SQL: clamped sources are those below the level of the sorted ratios.
MIX_SQL = r"""
WITH base AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5('mix-1:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, ''))) AS h
  FROM documents),
sums AS (SELECT source, sum(size)::BIGINT AS source_size FROM base GROUP BY source),
weighed AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w
  FROM sums),
levels AS (
  SELECT *, coalesce(sum(2.0::DOUBLE * source_size) OVER (ORDER BY 2.0 * source_size / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS fixed,
    sum(w) OVER (ORDER BY 2.0 * source_size / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open,
    2.0 * source_size / w AS ratio, sum(source_size) OVER () * 1.5::DOUBLE AS budget
  FROM weighed),
level AS (SELECT coalesce(arg_min((budget - fixed) / open, ratio), 0) AS lam FROM levels WHERE (budget - fixed) / open <= ratio),
goals AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, w * lam) AS target
  FROM weighed, level),
split AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM goals),
runs AS (
  SELECT b.doc_id, b.size, s.source_size, s.target, s.whole, round(s.target)::BIGINT - s.whole * s.source_size AS part,
    coalesce(sum(b.size) OVER (PARTITION BY b.source ORDER BY b.h, b.doc_id, b.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM base b JOIN split s ON b.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, target, whole, whole * size + CASE WHEN 2 * before + size <= 2 * part THEN size ELSE 0 END AS taken FROM runs
"""
