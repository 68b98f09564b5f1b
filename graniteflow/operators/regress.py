"""Regressors, feature scores and feature selection.

Linear models on a moderate number of columns need only the sums of products of
[1, features, label]. ``gram_table`` takes them in one pass, per fold if wanted;
a training fold is then total − fold, so every fold, penalty and column subset
of a search is solved without reading the rows again.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graniteflow.functions.mathx import safe_corr
from graniteflow.operators import forest, metrics
from graniteflow.operators.ordering import running_totals
from graniteflow.operators.split import bootstrap_weight
from graniteflow.operators.vectorize import polynomial_vector
from graniteflow.session import cut_lineage

WIDE = 16


# ---------------------------------------------------------- sums of products
def gram_table(df: DataFrame, cols: list[str], y: str, keys: list[str] | None = None) -> dict[tuple, np.ndarray]:
    """Key → matrix of sums of products of [1, cols…, y]. One row per key reaches the driver.

    Columns should be roughly centred and scaled. Few columns are summed by plain
    aggregates, many by one dense matrix per Arrow batch.
    """
    keys = list(keys or [])
    names = [*cols, y]
    size = len(names) + 1
    if len(names) <= WIDE:
        value = lambda i: F.lit(1.0) if i == 0 else F.col(names[i - 1]).cast("double")
        spots = [(i, j) for i in range(size) for j in range(i, size)]
        rows = df.groupBy(*keys).agg(*[F.sum(value(i) * value(j)).alias(f"g{i}_{j}") for i, j in spots]).collect()
        out = {}
        for row in rows:
            g = np.zeros((size, size))
            for i, j in spots:
                g[i, j] = g[j, i] = row[f"g{i}_{j}"]
            out[tuple(row[k] for k in keys)] = g
        return out

    def partial(batches):
        for pdf in batches:
            for key, part in pdf.groupby(keys) if keys else [((), pdf)]:
                x = np.column_stack([np.ones(len(part)), part[names].to_numpy(dtype=float)])
                yield part.iloc[:1][keys].assign(g=[(x.T @ x).ravel()])

    ddl = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in df.select(*keys).schema.fields)
    sums = df.select(*keys, *[F.col(c).cast("double") for c in names]).mapInPandas(partial, ddl + "g array<double>")
    total = vector_to_array(Summarizer.sum(F.col("v")))
    rows = sums.withColumn("v", array_to_vector("g")).groupBy(*keys).agg(total.alias("g")).collect()
    return {tuple(r[k] for k in keys): np.array(r["g"]).reshape(size, size) for r in rows}


def ridge_from_gram(gram: np.ndarray, alpha: float = 0.0, use: list[int] | None = None) -> np.ndarray:
    """[intercept, coefficients…] of (XᵀX + αI)⁻¹Xᵀy, intercept not penalised; ``use`` keeps some columns."""
    p = gram.shape[0] - 2
    pick = [0, *[i + 1 for i in (range(p) if use is None else use)]]
    a = gram[np.ix_(pick, pick)] + np.diag([0.0] + [alpha] * (len(pick) - 1))
    coef = np.zeros(p + 1)
    coef[pick] = np.linalg.lstsq(a, gram[pick, -1], rcond=None)[0]
    return coef


def lasso_from_gram(gram: np.ndarray, alpha: float, rounds: int = 1000, tol: float = 1e-12) -> np.ndarray:
    """Minimiser of ‖y − Xb‖²/(2n) + α‖b‖₁ by coordinate steps on the centred sums."""
    n = gram[0, 0]
    mean = gram[0, 1:] / n
    c = gram[1:, 1:] - n * np.outer(mean, mean)
    q, r = c[:-1, :-1] / n, c[:-1, -1] / n
    b = np.zeros(len(r))
    for _ in range(rounds):
        old = b.copy()
        for j in np.flatnonzero(np.diag(q) > 0):
            rest = r[j] - q[j] @ b + q[j, j] * b[j]
            b[j] = np.sign(rest) * max(abs(rest) - alpha, 0.0) / q[j, j]
        if np.max(np.abs(b - old), initial=0.0) < tol:
            break
    return np.concatenate([[mean[-1] - mean[:-1] @ b], b])


def mse_from_gram(gram: np.ndarray, coef: np.ndarray) -> float:
    full = np.append(coef, -1.0)
    return float(max(full @ gram @ full, 0.0) / gram[0, 0])


def linear_fold_scores(
    df: DataFrame, cols: list[str], y: str, fold: str, models: list[tuple[str, float]],
) -> list[dict]:
    """Train and test MSE of every (kind, alpha) on every fold, from one pass over the rows.

    ``kind`` is ols, ridge or lasso.
    """
    grams = {k[0]: g for k, g in gram_table(df, cols, y, [fold]).items()}
    total = sum(grams.values())
    out = []
    for kind, alpha in models:
        for f, test in sorted(grams.items()):
            train = total - test
            coef = lasso_from_gram(train, alpha) if kind == "lasso" else ridge_from_gram(train, alpha)
            out.append({
                "model": kind, "alpha": float(alpha), "fold": int(f),
                "train_mse": mse_from_gram(train, coef), "test_mse": mse_from_gram(test, coef),
            })
    return out


def result_rows(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """Search results (one row per candidate and fold) as a table."""
    names = [part.split()[0] for part in schema.split(",")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)


# ------------------------------------------------------------ Spark ML models
def assembled(df: DataFrame, cols: list[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=output).transform(df)


def ols(train: DataFrame, cols: list[str], y: str):
    """Pipeline with an exact least-squares fit (normal equations on the executors)."""
    model = LinearRegression(labelCol=y, solver="normal")
    return Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="features"), model]).fit(train)


def ridge(train: DataFrame, cols: list[str], y: str, alpha: float):
    """Same minimiser as (XᵀX + αI)⁻¹Xᵀy on centred data."""
    row = train.agg(F.count(F.lit(1)).alias("n"), F.stddev_pop(y).alias("s")).first()
    model = LinearRegression(
        labelCol=y, solver="normal", elasticNetParam=0.0, standardization=False, regParam=alpha / row["n"] * row["s"]
    )
    return Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="features"), model]).fit(train)


def lasso(train: DataFrame, cols: list[str], y: str, alpha: float):
    model = LinearRegression(
        labelCol=y, solver="l-bfgs", elasticNetParam=1.0, standardization=False, regParam=alpha, maxIter=1000, tol=1e-10
    )
    return Pipeline(stages=[VectorAssembler(inputCols=cols, outputCol="features"), model]).fit(train)


def poly_regression(train: DataFrame, cols: list[str], y: str, degree: int):
    """Least squares on all monomials up to ``degree``."""
    stages = [
        VectorAssembler(inputCols=cols, outputCol="features"), polynomial_vector(degree),
        LinearRegression(featuresCol="poly", labelCol=y, solver="auto"),
    ]
    return Pipeline(stages=stages).fit(train)


def ols_tests(df: DataFrame, cols: list[str], y: str) -> DataFrame:
    """(feature, coef, t, p_value) with the constant as its own named row."""
    summary = ols(df, cols, y).stages[-1]
    s = summary.summary
    names = [*cols, "const"]
    coefs = [*summary.coefficients, summary.intercept]
    rows = [(n, float(c), float(t), float(p)) for n, c, t, p in zip(names, coefs, s.tValues, s.pValues)]
    return df.sparkSession.createDataFrame(rows, "feature string, coef double, t double, p_value double")


def random_forest(cols_vector: str, y: str, trees: int = 150, per_split: int = 5, depth: int = 30, seed: int = 0):
    """Forest regressor. Spark grows trees to a depth of 30 at most; more is an error, not a shallower forest."""
    if depth > 30:
        raise ValueError("trees deeper than 30 levels cannot be grown")
    return RandomForestRegressor(
        featuresCol=cols_vector, labelCol=y, numTrees=trees, featureSubsetStrategy=str(per_split),
        maxDepth=depth, seed=seed,
    )


def gbt(cols_vector: str, y: str, preset: str = "leafwise", seed: int = 0, **overrides):
    """Boosted trees with one of two presets. Spark has no leaf-count or leaf-penalty parameter."""
    presets = {
        "leafwise": {"maxIter": 800, "stepSize": 0.025, "maxDepth": 8, "subsamplingRate": 0.8},
        "ordered": {"maxIter": 775, "stepSize": 0.05, "maxDepth": 9, "subsamplingRate": 1.0},
    }
    return GBTRegressor(featuresCol=cols_vector, labelCol=y, seed=seed, **{**presets[preset], **overrides})


def oob_predictions(
    train: DataFrame, key: str, features: str, y: str, trees: int, per_split: int, depth: int = 30, seed: int = 0,
) -> DataFrame:
    """(key, y, est, n_trees): mean prediction of the trees whose resample left the row out.

    The rows are stored once with their weights in every resample, and all trees grow on the
    same bins of the features, each in a task of its own (``forest``). Where the rows have more
    combinations of bins than a task may hold, the trees are Spark's, fitted one after another.
    Rows that no tree left out are not returned; rows that share a key share their weights and
    give a row each.
    """
    if depth > 30:
        raise ValueError("trees deeper than 30 levels cannot be grown")
    named = train.select(F.col(key).alias("key"), F.col(y).alias("y"), vector_to_array(features).alias("x"))
    found = forest.oob(named, trees, per_split, depth, seed)
    if found is not None:
        return found.select(F.col("key").alias(key), F.col("y").alias(y), "est", "n_trees")
    drawn = F.array(*[bootstrap_weight(key, F.lit(b), seed).cast("tinyint") for b in range(trees)])
    rows = cut_lineage(train.select(key, features, y, drawn.alias("_weights")))
    scored, left_out = rows, []
    for b in range(trees):
        weight = F.col("_weights")[b]
        tree = RandomForestRegressor(
            featuresCol=features, labelCol=y, predictionCol=f"_p{b}", numTrees=1, bootstrap=False,
            featureSubsetStrategy=str(per_split), maxDepth=depth, seed=seed + b, weightCol="_weight",
        )
        model = tree.fit(rows.where(weight > 0).select(features, y, weight.cast("double").alias("_weight")))
        scored = model.transform(scored)
        left_out.append(F.when(weight == 0, F.col(f"_p{b}")))
    known = scored.select(key, y, F.filter(F.array(*left_out), lambda p: p.isNotNull()).alias("_p"))
    total = F.aggregate("_p", F.lit(0.0), lambda a, p: a + p)
    return known.where(F.size("_p") > 0).select(key, y, (total / F.size("_p")).alias("est"), F.size("_p").cast("bigint").alias("n_trees"))


def oob_error(preds: DataFrame, y: str, est: str = "est") -> DataFrame:
    """1 − R² of out-of-bag predictions."""
    gap = F.col(y) - F.col(est)
    return preds.agg(F.count(F.lit(1)).alias("n_rows"), F.try_divide(F.sum(gap * gap), F.var_pop(y) * F.count(y)).alias("oob_error"))


def tree_report(spark: SparkSession, model, cols: list[str]) -> DataFrame:
    """(tree, depth, n_nodes, feature, importance) of every tree of a forest."""
    rows = [
        (i, tree.depth, tree.numNodes, name, float(tree.featureImportances[j]))
        for i, tree in enumerate(model.trees) for j, name in enumerate(cols)
    ]
    return spark.createDataFrame(rows, "tree int, depth int, n_nodes int, feature string, importance double")


def tree_nodes(spark: SparkSession, model_path: str) -> DataFrame:
    """Node listing of a saved forest as a table."""
    return spark.read.parquet(f"{model_path}/data")


# ------------------------------------------------------------- feature scores
def f_regression(df: DataFrame, cols: list[str], y: str) -> DataFrame:
    """(feature, score) with score = r²/(1−r²)·(n−2), all columns in one aggregation."""
    row = df.agg(F.count(F.lit(1)).alias("n"), *[safe_corr(c, y).alias(f"r{i}") for i, c in enumerate(cols)])
    score = lambda i: F.try_divide(F.col(f"r{i}") ** 2, 1 - F.col(f"r{i}") ** 2) * (F.col("n") - 2)
    cells = [F.struct(F.lit(c).alias("feature"), score(i).alias("score")) for i, c in enumerate(cols)]
    return row.select(F.inline(F.array(*cells)))


def _bin_edges(df: DataFrame, cols: list[str], bins: int) -> dict[str, list[tuple[int, float]]]:
    """Equal-frequency bins per column: (bin, smallest value), at most ``bins`` per column.

    Rows are first counted per distinct value; equal values share a bin.
    """
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in cols])
    counts = df.select(F.inline(cells)).where("x IS NOT NULL").groupBy("feature", "x").agg(F.count(F.lit(1)).alias("c"))
    ranked = running_totals(counts, ["x"], {"upto": F.col("c")}, ["feature"], totals=True)
    slot = F.floor((F.col("upto") - F.col("c")) * F.lit(bins) / F.col("upto_total")).cast("int")
    edges = ranked.groupBy("feature", slot.alias("bin")).agg(F.min("x").alias("edge")).collect()
    out = {c: [] for c in cols}
    for row in edges:
        out[row["feature"]].append((row["bin"], row["edge"]))
    return {c: sorted(v) for c, v in out.items()}


def mutual_info(df: DataFrame, cols: list[str], y: str, bins: int = 10) -> DataFrame:
    """(feature, score): plug-in mutual information of equal-frequency bins with the binned label."""
    edges = _bin_edges(df, [*cols, y], bins)

    def binned(name):
        (first, edge), *rest = reversed(edges[name])
        out = F.when(F.col(name) >= edge, first)
        for number, edge in rest:
            out = out.when(F.col(name) >= edge, number)
        return out

    cells = F.array(*[F.struct(F.lit(c).alias("feature"), binned(c).alias("bx")) for c in cols])
    long = df.select(*cols, y).na.drop().withColumn("by", binned(y)).select("by", F.inline(cells))
    sizes = metrics._label_sizes(long, "bx", "by", ["feature"])
    sums = metrics._run_sums(sizes, ["feature"])
    return sums.select("feature", metrics._entropies()["mi"].alias("score"))


def select_k_best(df: DataFrame, cols: list[str], scores: DataFrame, k: int | None) -> list[str]:
    """Names of the ``k`` best columns (all with None), in table order. One score per column is read."""
    ranked = sorted(scores.collect(), key=lambda r: (-(r["score"] if r["score"] is not None else -1.0), r["feature"]))
    keep = {r["feature"] for r in ranked[: len(cols) if k is None else k]}
    return [c for c in cols if c in keep]


def feature_count_sweep(train: DataFrame, test: DataFrame, cols: list[str], y: str) -> list[dict]:
    """Test RMSE of least squares on the k best columns for every k; two passes in total."""
    scores = {r["feature"]: r["score"] for r in f_regression(train, cols, y).collect()}
    order = sorted(range(len(cols)), key=lambda i: (-(scores[cols[i]] or 0.0), cols[i]))
    g_train, g_test = gram_table(train, cols, y)[()], gram_table(test, cols, y)[()]
    out = []
    for k in range(1, len(cols) + 1):
        coef = ridge_from_gram(g_train, 0.0, order[:k])
        out.append({"k": k, "worst_feature": cols[order[k - 1]], "rmse": mse_from_gram(g_test, coef) ** 0.5})
    return out
