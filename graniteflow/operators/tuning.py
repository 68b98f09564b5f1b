"""Cross-validation, searches and their result tables.

A search loops over candidates on the driver; every fit and score inside the
loop is a Spark job, and a few run at once in threads.
"""

from __future__ import annotations

import math
import time
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from itertools import product

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import Evaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from graniteflow.functions.columns import absolute_gap, to_numeric
from graniteflow.functions.hashing import hash_unit
from graniteflow.operators import metrics, stats

SCORES = "candidate string, fold int, train_score double, test_score double, fit_seconds double, score_seconds double"


class NegRmse(Evaluator):
    """Negative root mean squared error: larger is better."""

    def __init__(self, label: str, prediction: str = "prediction"):
        super().__init__()
        self.label, self.prediction = label, prediction

    def _evaluate(self, df: DataFrame) -> float:
        return -metrics.regression_metrics(df, self.label, self.prediction).first()["rmse"]


class MacroF1(Evaluator):
    """Unweighted mean of the class F1 scores."""

    def __init__(self, label: str, prediction: str = "prediction"):
        super().__init__()
        self.label, self.prediction = label, prediction

    def _evaluate(self, df: DataFrame) -> float:
        return metrics.macro_metrics(df, self.label, self.prediction).first()["f1"]


def in_threads(tasks: list[Callable], parallelism: int) -> list:
    """Run driver-side calls a few at a time; results in task order."""
    inherit = inheritable_thread_target(SparkSession.active())
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return [f.result() for f in [pool.submit(inherit(task)) for task in tasks]]


class PrefixCache:
    """Fitted leading pipeline stages and their persisted outputs, shared by candidates.

    Candidates that agree in fold and leading settings reuse one fit.
    """

    def __init__(self):
        self.entries = {}
        self.fits = 0

    def get(self, key, stages: list, train: DataFrame, test: DataFrame):
        if key not in self.entries:
            self.fits += 1
            model = Pipeline(stages=stages).fit(train)
            self.entries[key] = model, model.transform(train).persist(), model.transform(test).persist()
        return self.entries[key]

    def clear(self):
        for _, train, test in self.entries.values():
            train.unpersist()
            test.unpersist()
        self.entries = {}


def cross_validate(
    make: Callable[[], object], df: DataFrame, fold: str, folds: Iterable[int], evaluator: Evaluator, name: str = "model",
    parallelism: int = 1, prefix: tuple | None = None, cache: PrefixCache | None = None,
) -> list[dict]:
    """One result per fold with train and test score and times.

    ``prefix`` = (key, stages): stages fitted per fold through the cache.
    """

    def one(f):
        train, test = df.where(F.col(fold) != f), df.where(F.col(fold) == f)
        start = time.time()
        if prefix is not None:
            _, train, test = cache.get((f, prefix[0]), prefix[1], train, test)
        model = make().fit(train)
        fitted = time.time()
        test_score = evaluator.evaluate(model.transform(test))
        scored = time.time()
        return {
            "candidate": name, "fold": int(f), "train_score": evaluator.evaluate(model.transform(train)),
            "test_score": test_score, "fit_seconds": fitted - start, "score_seconds": scored - fitted,
        }

    return in_threads([lambda f=f: one(f) for f in folds], 1 if prefix is not None else parallelism)


def grid(**choices) -> list[dict]:
    """All combinations of the listed values."""
    return [dict(zip(choices, combo)) for combo in product(*choices.values())]


def grid_search(
    build: Callable[[dict], tuple], candidates: list[dict], df: DataFrame, fold: str, folds: Iterable[int], evaluator: Evaluator,
) -> list[dict]:
    """Score every candidate on every fold.

    ``build(params)`` returns (prefix key, prefix stages, estimator); equal prefix
    keys are fitted once per fold.
    """
    cache, folds, out = PrefixCache(), list(folds), []
    try:
        for params in candidates:
            key, stages, estimator = build(params)
            name = ";".join(f"{k}={v}" for k, v in sorted(params.items()))
            prefix = (key, stages) if stages else None
            out += cross_validate(lambda: estimator, df, fold, folds, evaluator, name, prefix=prefix, cache=cache)
    finally:
        cache.clear()
    return out


def scores_table(spark: SparkSession, rows: list[dict]) -> DataFrame:
    names = [part.split()[0] for part in SCORES.split(",")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], SCORES)


def cv_results(scores: DataFrame, by: list[str], test: str = "test_score", train: str = "train_score") -> DataFrame:
    """Mean and population deviation over folds per candidate, with the competition rank.

    If the scores have folds and times, ``fold_scores`` (test scores in order of the folds) and the
    mean and deviation of the seconds to fit and to score are added.
    """
    more = [F.transform(F.sort_array(F.collect_list(F.struct("fold", test))), lambda x: x[test]).alias("fold_scores")] if "fold" in scores.columns else []
    more += [f(f"{c}_seconds").alias(f"{n}_{c}_seconds") for c in ("fit", "score") if f"{c}_seconds" in scores.columns for n, f in (("mean", F.avg), ("std", F.stddev_pop))]
    table = scores.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_folds"), F.avg(test).alias("mean_test"), F.stddev_pop(test).alias("std_test"),
        F.avg(train).alias("mean_train"), *more,
    )
    return stats.rank_results(table.withColumn("mean_test", F.round("mean_test", 9)), "mean_test")


def search_report(results: DataFrame, name: str, seconds: float | None = None) -> DataFrame:
    """One row: candidates, best mean ± deviation and the best candidate."""
    best = F.max_by(F.struct("mean_test", "std_test", F.col(name).alias("name")), F.struct(F.col("mean_test"), F.col(name)))
    return results.agg(F.count(F.lit(1)).alias("n_candidates"), best.alias("b")).select(
        F.lit(seconds).cast("double").alias("seconds"), "n_candidates", F.col("b.mean_test").alias("best_mean"),
        F.col("b.std_test").alias("best_std"), F.col("b.name").alias("best_candidate"),
    )


def param_effects(results: DataFrame, params: list[str]) -> DataFrame:
    """Correlations among numeric parameters, mean scores and the train − test gap."""
    cols = [*params, "mean_test", "mean_train"]
    table = results.select(*[to_numeric(c).alias(c) for c in cols])
    return stats.corr_matrix(table.withColumn("gap", absolute_gap("mean_train", "mean_test")), [*cols, "gap"])


# --------------------------------------------------------------- random search
def log_uniform(low: float, high: float):
    return lambda u: math.exp(math.log(low) + u * (math.log(high) - math.log(low)))


def whole_number(low: int, high: int):
    return lambda u: min(high, low + int(u * (high - low + 1)))


def one_of(*values):
    return lambda u: values[min(len(values) - 1, int(u * len(values)))]


def draw(spark: SparkSession, space: dict[str, Callable], n: int, seed: int = 0) -> list[dict]:
    """``n`` candidates as a function of the seed alone."""
    names = sorted(space)
    rows = spark.range(n).select(
        "id", *[hash_unit("id", F.lit(name), seed=seed).alias(name) for name in names]
    ).orderBy("id").collect()
    return [{name: space[name](row[name]) for name in names} for row in rows]


def random_search(
    score: Callable[[dict], float], candidates: list[dict], parallelism: int = 3, delta: float = 1e-4, patience: int = 10,
    deadline: float = 6 * 3600.0,
) -> list[dict]:
    """Score candidates a few at a time (larger is better).

    Stops when the best score grew by less than ``delta`` over the last
    ``patience`` candidates, or at the deadline in seconds.
    """
    start, out, best = time.time(), [], []
    for i in range(0, len(candidates), parallelism):
        batch = candidates[i : i + parallelism]
        for params, value in zip(batch, in_threads([lambda p=p: score(p) for p in batch], parallelism)):
            out.append({"params": params, "score": value})
            best.append(max(value, best[-1] if best else value))
        if time.time() - start > deadline:
            break
        if len(best) > patience and best[-1] - best[-1 - patience] < delta:
            break
    return out


def refit(build: Callable[[dict], object], params: dict, train: DataFrame) -> PipelineModel:
    """Fit the chosen candidate on all training rows."""
    return build(params).fit(train)
