import numpy as np
import pytest

from graniteflow.operators import metrics


def frame(spark, pairs):
    return spark.createDataFrame(pairs, "y string, p string")


def test_cluster_scores_of_perfect_swapped_and_single_labels(spark):
    perfect = frame(spark, [("a", "1"), ("a", "1"), ("b", "2"), ("b", "2")])
    row = metrics.cluster_score_table(perfect, "y", "p").first()
    assert np.allclose(list(row), 1.0)
    single = frame(spark, [("a", "1"), ("a", "1"), ("b", "1"), ("b", "1")])
    row = metrics.cluster_score_table(single, "y", "p").first().asDict()
    assert row["homogeneity"] == pytest.approx(0) and row["completeness"] == 1.0
    assert row["v_measure"] == pytest.approx(0) and row["adjusted_rand"] == pytest.approx(0)


def test_expected_mi_does_not_depend_on_chunks(spark):
    rng = np.random.default_rng(1)
    df = frame(spark, [(str(a), str(b)) for a, b in zip(rng.integers(0, 3, 90), rng.integers(0, 5, 90))])
    sizes = metrics._label_sizes(df, "y", "p", [])
    one = metrics._expected_mi(sizes, []).first()["emi"]
    many = metrics._expected_mi(sizes, [], chunk=3).first()["emi"]
    assert one == pytest.approx(many, rel=1e-12) and one > 0


def test_adjusted_scores_against_direct_sums(spark):
    from math import comb, exp, lgamma, log

    rng = np.random.default_rng(2)
    t, p = rng.integers(0, 3, 60), rng.integers(0, 4, 60)
    cells = np.zeros((3, 4))
    np.add.at(cells, (t, p), 1)
    a, b, n = cells.sum(1), cells.sum(0), 60
    pairs = lambda x: sum(comb(int(v), 2) for v in np.ravel(x))
    e = pairs(a) * pairs(b) / comb(n, 2)
    ari = (pairs(cells) - e) / ((pairs(a) + pairs(b)) / 2 - e)
    mi = sum(c / n * log(c * n / (a[i] * b[j])) for (i, j), c in np.ndenumerate(cells) if c)
    lf = lambda x: lgamma(x + 1)
    emi = sum(
        m / n * log(n * m / (x * y)) * exp(lf(x) + lf(y) + lf(n - x) + lf(n - y) - lf(n) - lf(m) - lf(x - m) - lf(y - m) - lf(n - x - y + m))
        for x in a for y in b for m in range(int(max(1, x + y - n)), int(min(x, y)) + 1)
    )
    h = lambda s: -sum(v / n * log(v / n) for v in s)
    ami = (mi - emi) / ((h(a) + h(b)) / 2 - emi)
    row = metrics.cluster_score_table(frame(spark, [(str(x), str(y)) for x, y in zip(t, p)]), "y", "p").first()
    assert row["adjusted_rand"] == pytest.approx(ari, abs=1e-12) and row["adjusted_mutual_info"] == pytest.approx(ami, abs=1e-9)


def test_binary_metrics_without_positive_predictions(spark):
    row = metrics.binary_metrics(frame(spark, [("pos", "neg"), ("neg", "neg")]), "y", "p", "pos").first()
    assert tuple(row) == (0.5, 0.0, 0.0, 0.0)


def test_macro_metrics_counts_classes_of_both_sides(spark):
    row = metrics.macro_metrics(frame(spark, [("a", "a"), ("a", "c"), ("b", "b")]), "y", "p").first()
    assert row["accuracy"] == pytest.approx(2 / 3)
    assert row["precision"] == pytest.approx((1 + 1 + 0) / 3) and row["recall"] == pytest.approx((0.5 + 1 + 0) / 3)
    assert row["f1"] == pytest.approx((2 / 3 + 1 + 0) / 3)


def test_auc_with_ties_and_roc_end_point(spark):
    data = [(0.9, 1.0), (0.8, 0.0), (0.8, 1.0), (0.3, 0.0), (0.1, 0.0)]
    df = spark.createDataFrame(data, "s double, y double")
    pos, neg = [s for s, y in data if y], [s for s, y in data if not y]
    want = np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg])
    assert metrics.auc(df, "s", "y").first()["auc"] == pytest.approx(want)
    curve = metrics.roc_curve(df, "s", "y").orderBy("threshold").collect()
    assert (curve[0]["fpr"], curve[0]["tpr"]) == (1.0, 1.0) and len(curve) == 4
    assert metrics.auc(df.where("y = 1"), "s", "y").first()["auc"] is None


def test_regression_metrics(spark):
    row = metrics.regression_metrics(spark.createDataFrame([(1.0, 2.0), (3.0, 0.0)], "y double, p double"), "y", "p").first()
    assert row["rmse"] == pytest.approx(5**0.5) and row["mae"] == 2.0 and row["neg_mse"] == -5.0
