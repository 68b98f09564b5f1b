"""Term weights, word-vector features, scaling and encoding."""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.ml.feature import PolynomialExpansion
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from graniteflow.functions.hashing import hash_unit
from graniteflow.session import cut_lineage, small_side


def _pair_counts(tokens: DataFrame, doc: str, term: str) -> DataFrame:
    return tokens.groupBy(doc, F.col(term).alias("term")).agg(F.count(F.lit(1)).alias("tf"))


def _frequent(counts: DataFrame, min_df: int) -> DataFrame:
    """(term, df, n). Counting ``n`` as well keeps the pair counts whole here, so that
    a plan that also joins them reads one and the same shuffle."""
    return counts.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("n")).where(F.col("df") >= min_df)


def count_terms(tokens: DataFrame, doc: str = "doc_id", term: str = "token", min_df: int = 1) -> DataFrame:
    """(doc, term, tf, df) of the terms found in at least ``min_df`` documents."""
    counts = _pair_counts(tokens, doc, term)
    return counts.join(_frequent(counts, min_df).where("n > 0"), "term").select(doc, "term", "tf", "df")


class TfidfModel:
    """Frozen vocabulary (term, df, n, idf) of ``n_terms`` rows, if counted; rows of the result have unit length.

    Tokens dealt by document are weighted where they lie, past a vocabulary of bounded size.
    """

    def __init__(self, vocabulary: DataFrame, n_terms: int | None = None):
        self.vocabulary, self.n_terms = vocabulary, n_terms

    @classmethod
    def fit(cls, tokens: DataFrame, docs: DataFrame, doc: str = "doc_id", term: str = "token", min_df: int = 1):
        """``docs`` holds every document once, also those without a legal word."""
        n = docs.agg(F.count(F.lit(1)).alias("n")).scalar()
        idf = F.log((1 + n) / (1 + F.col("df"))) + 1
        vocabulary = cut_lineage(_frequent(_pair_counts(tokens, doc, term), min_df).withColumn("idf", idf))
        return cls(vocabulary, vocabulary.count())

    def transform(self, tokens: DataFrame, doc: str = "doc_id", term: str = "token") -> DataFrame:
        """(doc, term, tf, w). Terms outside the vocabulary are dropped."""
        known = self.vocabulary.where("n > 0").select("term", "idf")
        known = known if self.n_terms is None else small_side(known, self.n_terms, 80)
        raw = _pair_counts(tokens, doc, term).join(known, "term").withColumn("raw", F.col("tf") * F.col("idf"))
        norm = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(doc)))
        return raw.select(doc, "term", "tf", (F.col("raw") / norm).alias("w"))


def tfidf(tokens: DataFrame, docs: DataFrame, doc: str = "doc_id", term: str = "token", min_df: int = 1) -> DataFrame:
    """Fit and transform on the same documents."""
    return TfidfModel.fit(tokens, docs, doc, term, min_df).transform(tokens, doc, term)


def embed_keywords(
    words: DataFrame, rows: DataFrame, vectors: DataFrame, key: str, dim: int, mean: bool = False, word: str = "word",
) -> DataFrame:
    """Sum (or mean) of the vectors of a row's words, one column ``f<j>`` per dimension.

    ``words`` has one row per (key, word). Unknown words are skipped; a row of
    ``rows`` without a known word gets zeros. The word join has no hint: a small
    vector table is broadcast, a large one is shuffled with skew splitting, and
    the sums are combined before the shuffle by key.
    """
    fold = F.avg if mean else F.sum
    known = words.select(key, F.col(word).alias("word")).join(vectors, "word")
    sums = known.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_known"), *[fold(F.col("v")[j]).alias(f"f{j}") for j in range(dim)]
    )
    zero = {f"f{j}": F.coalesce(f"f{j}", F.lit(0.0)) for j in range(dim)}
    return (
        rows.select(key).join(sums, key, "left")
        .withColumn("n_known", F.coalesce("n_known", F.lit(0).cast("bigint")))
        .withColumns(zero)
    )


def embedding_dim_sweep(words, rows, vectors, key: str, dims: list[int], word: str = "word") -> DataFrame:
    """Long features (key, dim, j, value) for several vector lengths from one join.

    Shorter vectors are prefixes of the longest, so they are sliced afterwards.
    """
    wide = embed_keywords(words, rows, vectors, key, max(dims), word=word)
    values = F.array(*[F.col(f"f{j}") for j in range(max(dims))])
    return (
        wide.select(key, values.alias("x"), F.explode(F.array(*[F.lit(d) for d in dims])).alias("dim"))
        .select(key, "dim", F.posexplode(F.slice("x", F.lit(1), F.col("dim"))).alias("j", "value"))
    )


def scaler_stats(df: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column: one aggregation, one row to the driver."""
    cells = [c for x in cols for c in (F.avg(x).alias(f"m_{x}"), F.stddev_pop(x).alias(f"s_{x}"))]
    row = df.agg(*cells).first()
    return {x: (row[f"m_{x}"], row[f"s_{x}"]) for x in cols}


def apply_scaler(df: DataFrame, stats: dict[str, tuple[float, float]]) -> DataFrame:
    """Subtract the mean, divide by the deviation; constant columns become zero."""
    return df.withColumns({x: (F.col(x) - m) / (s or 1.0) for x, (m, s) in stats.items()})


def standard_scale(df: DataFrame, cols: list[str]) -> DataFrame:
    return apply_scaler(df, scaler_stats(df, cols))


def ordinal_encode(col: str, order: list) -> Column:
    """Position in a given order; a value outside the order is an error."""
    table = F.create_map(*[x for i, v in enumerate(order) for x in (F.lit(v), F.lit(float(i)))])
    unseen = F.raise_error(F.concat(F.lit(f"unknown category in {col}: "), F.col(col).cast("string")))
    return F.when(F.col(col).isNull() | ~F.map_contains_key(table, F.col(col)), unseen.cast("double")).otherwise(
        F.element_at(table, F.col(col))
    )


def encode_columns(df: DataFrame, orders: dict[str, list], passthrough: list[str], keep: list[str] = ()) -> DataFrame:
    """Kept columns, then encoded columns, then the passed-through ones."""
    encoded = [ordinal_encode(c, o).alias(c) for c, o in orders.items()]
    return df.select(*keep, *encoded, *passthrough)


def polynomial_columns(cols: list[str], degree: int) -> dict[str, Column]:
    """All monomials of degree 1…d as named columns, e.g. ``a``, ``a*b``, ``a*a``."""
    out = {}
    for d in range(1, degree + 1):
        for combo in combinations_with_replacement(cols, d):
            term = F.col(combo[0])
            for c in combo[1:]:
                term = term * F.col(c)
            out["*".join(combo)] = term
    return out


def polynomial_vector(degree: int, input_col: str = "features", output_col: str = "poly") -> PolynomialExpansion:
    """The same monomials as one vector column."""
    return PolynomialExpansion(degree=degree, inputCol=input_col, outputCol=output_col)


def concat_features(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Side-by-side features matched by row key."""
    return left.join(right, key)


def random_features(df: DataFrame, key: str, dim: int, seed: int = 0) -> DataFrame:
    """Uniform control features, a function of (row key, dimension)."""
    return df.withColumns({f"r{j}": hash_unit(key, F.lit(j), seed=seed) for j in range(dim)})
