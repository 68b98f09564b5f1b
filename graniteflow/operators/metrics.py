"""Scores for classifiers, rankings, regressions and clusterings.

Cluster and class scores are plans over pair counts, so rows are reduced to
(label, label) cells before anything else happens. ``keys`` scores many runs in
one job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graniteflow.functions.mathx import ln_factorial
from graniteflow.operators.ordering import running_totals
from graniteflow.operators.stats import contingency


def _ratio(a, b) -> Column:
    """a / b, 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b), F.lit(0.0))


def binary_metrics(df: DataFrame, y: str, pred: str, positive, keys: list[str] | None = None) -> DataFrame:
    """Accuracy, precision, recall and F1 for one named positive label."""
    truth, guess = F.col(y) == F.lit(positive), F.col(pred) == F.lit(positive)
    counts = df.groupBy(*(keys or [])).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(y) == F.col(pred)).alias("hit"),
        F.count_if(truth & guess).alias("tp"), F.count_if(guess).alias("pp"), F.count_if(truth).alias("ap"),
    )
    tp = F.col("tp")
    return counts.select(
        *(keys or []), _ratio(F.col("hit"), F.col("n")).alias("accuracy"), _ratio(tp, F.col("pp")).alias("precision"),
        _ratio(tp, F.col("ap")).alias("recall"), _ratio(2 * tp, F.col("pp") + F.col("ap")).alias("f1"),
    )


def macro_metrics(df: DataFrame, y: str, pred: str, keys: list[str] | None = None) -> DataFrame:
    """Accuracy and unweighted class means of precision, recall and F1."""
    keys = list(keys or [])
    cells = contingency(df, y, pred, keys)
    same = F.col(y) == F.col(pred)
    sides = F.array(
        F.struct(F.col(y).alias("label"), F.col("n").alias("ap"), F.lit(0).cast("bigint").alias("pp")),
        F.struct(F.col(pred).alias("label"), F.lit(0).cast("bigint").alias("ap"), F.col("n").alias("pp")),
    )
    per_class = (
        cells.select(*keys, F.when(same, F.col("n")).otherwise(0).alias("hit"), F.inline(sides))
        .groupBy(*keys, "label")
        .agg(F.sum("ap").alias("ap"), F.sum("pp").alias("pp"), (F.sum("hit") / 2).alias("tp"))
    )
    tp, ap, pp = F.col("tp"), F.col("ap"), F.col("pp")
    return per_class.groupBy(*keys).agg(
        (F.sum("tp") / F.sum("ap")).alias("accuracy"),
        F.avg(_ratio(tp, pp)).alias("precision"), F.avg(_ratio(tp, ap)).alias("recall"),
        F.avg(_ratio(2 * tp, ap + pp)).alias("f1"),
    )


def roc_curve(df: DataFrame, score: str, y: str, keys: list[str] | None = None) -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, highest first; ``y`` is 0/1.

    The curve starts at (0, 0), which is not a row.
    """
    keys = list(keys or [])
    steps = df.groupBy(*keys, score).agg(F.sum(y).alias("p"), F.sum(1 - F.col(y)).alias("q"))
    run = running_totals(steps, [f"-{score}"], {"tp": F.col("p"), "fp": F.col("q")}, keys, totals=True)
    return run.select(
        *keys, F.col(score).alias("threshold"), F.try_divide("fp", "fp_total").alias("fpr"),
        F.try_divide("tp", "tp_total").alias("tpr"),
    )


def auc(df: DataFrame, score: str, y: str, keys: list[str] | None = None) -> DataFrame:
    """Exact area under the curve; equal scores count half. Null with one class only."""
    keys = list(keys or [])
    steps = df.groupBy(*keys, score).agg(F.sum(y).alias("p"), F.sum(1 - F.col(y)).alias("q"))
    run = running_totals(steps, [score], {"below": F.col("q")}, keys)
    wins = F.sum(F.col("p") * (F.col("below") - F.col("q") / 2))
    return run.groupBy(*keys).agg(F.try_divide(wins, F.sum("p") * F.sum("q")).alias("auc"))


def regression_metrics(df: DataFrame, y: str, pred: str, keys: list[str] | None = None) -> DataFrame:
    gap = F.col(y) - F.col(pred)
    mse = F.avg(gap * gap)
    return df.groupBy(*(keys or [])).agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(mse).alias("rmse"), F.avg(F.abs(gap)).alias("mae"),
        mse.alias("mse"), (-mse).alias("neg_mse"),
    )


def _label_sizes(df: DataFrame, truth: str, pred: str, keys: list[str]) -> DataFrame:
    """Cell, row and column sizes of every run: ``side`` 0 cell, 1 truth, 2 pred."""
    cells = contingency(df, truth, pred, keys)
    key_cols = [F.col(k) for k in keys]
    t, p = F.col(truth), F.col(pred)
    sets = [key_cols + [t, p], key_cols + [t], key_cols + [p]]
    side = F.grouping(truth) * 2 + F.grouping(pred)
    return (
        cells.groupingSets(sets, *key_cols, t, p)
        .agg(F.sum("n").alias("size"), side.alias("_g"))
        .select(*keys, F.col("_g").cast("int").alias("side"), "size")
    )


def _run_sums(sizes: DataFrame, keys: list[str]) -> DataFrame:
    """Σ n·ln n and Σ n(n−1)/2 over cells, rows and columns of each run."""
    size = F.col("size").cast("double")
    pick = lambda g, value: F.sum(F.when(F.col("side") == g, value))
    logs, pairs = size * F.log(size), size * (size - 1) / 2
    return sizes.groupBy(*keys).agg(
        pick(0, size).alias("n"),
        pick(0, logs).alias("cell_log"), pick(1, logs).alias("truth_log"), pick(2, logs).alias("pred_log"),
        pick(0, pairs).alias("cell_pairs"), pick(1, pairs).alias("truth_pairs"), pick(2, pairs).alias("pred_pairs"),
    )


def _entropies() -> dict[str, Column]:
    n = F.col("n")
    h = lambda s: F.greatest(F.log(n) - F.col(s) / n, F.lit(0.0))
    return {
        "h_truth": h("truth_log"), "h_pred": h("pred_log"),
        "mi": F.greatest((F.col("cell_log") - F.col("truth_log") - F.col("pred_log")) / n + F.log(n), F.lit(0.0)),
    }


def _expected_mi(sizes: DataFrame, keys: list[str], chunk: int = 65536, parts: int = 16) -> DataFrame:
    """Expected mutual information of random labelings with the same sizes.

    Equal sizes are grouped first. The sum over overlaps is cut into chunks of
    rows, so one pair of huge labels is spread over many tasks.
    """
    total = sizes.where("side = 0").groupBy(*keys).agg(F.sum("size").alias("n"))
    per_size = lambda g, a, c: (
        sizes.where(F.col("side") == g).groupBy(*keys, F.col("size").alias(a)).agg(F.count(F.lit(1)).alias(c))
    )
    rows, cols = per_size(1, "a", "ca"), per_size(2, "b", "cb")
    anchor = [*keys] or ["_one"]
    if not keys:
        rows, cols, total = (d.withColumn("_one", F.lit(1)) for d in (rows, cols, total))
    # The row sizes of one run are dealt over several keys, so a large run is no single task.
    rows = rows.withColumn("_part", F.pmod(F.hash("a"), F.lit(parts)))
    cols = cols.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    pairs = rows.join(cols, [*anchor, "_part"]).drop("_part").join(total, anchor)
    low = F.greatest(F.lit(1).cast("bigint"), F.col("a") + F.col("b") - F.col("n"))
    high = F.least("a", "b")
    starts = pairs.withColumns({"low": low, "high": high}).withColumn(
        "start", F.explode(F.sequence("low", "high", F.lit(chunk).cast("bigint")))
    )
    terms = starts.repartition(*anchor, "a", "b", "start").withColumn(
        "m", F.explode(F.sequence("start", F.least(F.col("start") + (chunk - 1), F.col("high"))))
    )
    a, b, n, m = (F.col(c).cast("double") for c in ("a", "b", "n", "m"))
    log_p = (
        ln_factorial(a) + ln_factorial(b) + ln_factorial(n - a) + ln_factorial(n - b) - ln_factorial(n)
        - ln_factorial(m) - ln_factorial(a - m) - ln_factorial(b - m) - ln_factorial(n - a - b + m)
    )
    value = m / n * (F.log(n) + F.log(m) - F.log(a) - F.log(b)) * F.exp(log_p) * F.col("ca") * F.col("cb")
    out = terms.groupBy(*anchor).agg(F.sum(value).alias("emi"))
    return out if keys else out.drop("_one")


def entropy_scores(df: DataFrame, truth: str, pred: str, keys: list[str] | None = None) -> DataFrame:
    """Homogeneity, completeness and V-measure."""
    keys = list(keys or [])
    sums = _run_sums(_label_sizes(df, truth, pred, keys), keys).withColumns(_entropies())
    return sums.withColumns(_entropy_columns()).select(*keys, "homogeneity", "completeness", "v_measure")


def _entropy_columns() -> dict[str, Column]:
    share = lambda h: F.when(F.col(h) <= 0, 1.0).otherwise(F.col("mi") / F.greatest(F.col(h), F.lit(1e-300)))
    hom, com = share("h_truth"), share("h_pred")
    return {
        "homogeneity": hom, "completeness": com,
        "v_measure": F.coalesce(F.try_divide(2 * hom * com, hom + com), F.lit(0.0)),
    }


def _adjusted_rand_column() -> Column:
    expected = F.try_divide(F.col("truth_pairs") * F.col("pred_pairs"), F.col("n") * (F.col("n") - 1) / 2)
    best = (F.col("truth_pairs") + F.col("pred_pairs")) / 2
    return F.coalesce(F.try_divide(F.col("cell_pairs") - expected, best - expected), F.lit(1.0))


def adjusted_rand(df: DataFrame, truth: str, pred: str, keys: list[str] | None = None) -> DataFrame:
    keys = list(keys or [])
    sums = _run_sums(_label_sizes(df, truth, pred, keys), keys)
    return sums.select(*keys, _adjusted_rand_column().alias("adjusted_rand"))


def cluster_score_table(df: DataFrame, truth: str, pred: str, keys: list[str] | None = None) -> DataFrame:
    """All five external scores of every run in one job."""
    keys = list(keys or [])
    sizes = _label_sizes(df, truth, pred, keys)
    sums = _run_sums(sizes, keys).withColumns(_entropies())
    emi = _expected_mi(sizes, keys)
    if keys:
        both = sums.join(emi, keys)
    else:
        both = sums.withColumn("emi", emi.scalar())
    mean_h = (F.col("h_truth") + F.col("h_pred")) / 2
    room = mean_h - F.col("emi")
    ami = F.when(F.abs(room) < 1e-15, F.lit(1.0)).otherwise((F.col("mi") - F.col("emi")) / room)
    return both.withColumns(_entropy_columns()).select(
        *keys, "homogeneity", "completeness", "v_measure",
        _adjusted_rand_column().alias("adjusted_rand"), ami.alias("adjusted_mutual_info"),
    )


def adjusted_mutual_info(df: DataFrame, truth: str, pred: str, keys: list[str] | None = None) -> DataFrame:
    return cluster_score_table(df, truth, pred, keys).select(*(keys or []), "adjusted_mutual_info")


def pred_actual(df: DataFrame, y: str, pred: str, keep: list[str]) -> DataFrame:
    """Actual beside predicted value, with the error."""
    return df.select(*keep, F.col(y).alias("actual"), F.col(pred).alias("predicted"), (F.col(pred) - F.col(y)).alias("error"))
