import numpy as np
import pytest

from graniteflow.operators import monomials


@pytest.fixture(scope="module")
def cloud():
    rng = np.random.default_rng(5)
    x = rng.uniform(-1.5, 1.5, (900, 3)) * [1.0, 2.0, 0.5] + [0.5, 4.0, 0.0]
    y = 1 + x[:, 0] - 0.3 * x[:, 1] * x[:, 2] + 0.5 * x[:, 0] ** 3 + 0.1 * rng.standard_normal(900)
    return x, y, np.arange(900) % 4


@pytest.fixture(scope="module")
def rows(spark, cloud):
    x, y, fold = cloud
    data = [(*map(float, r), float(v), int(f)) for r, v, f in zip(x, y, fold)]
    data += [(None, 1.0, 1.0, 1.0, 0), (1.0, 1.0, 1.0, None, 1)]
    return spark.createDataFrame(data, "a double, b double, c double, y double, fold int").repartition(5).cache()


ROUGH = {"b": (4.0, 2.0), "y": (1.0, 2.0)}


def design(x, degree):
    return np.column_stack([np.prod(x ** np.array(e), axis=1) for e in monomials.exponents(x.shape[1], degree)])


def test_sums_are_those_of_the_expanded_rows(rows, cloud):
    x, y, fold = cloud
    found = monomials.moment_table(rows, ["a", "b", "c"], "y", 3, ["fold"], ROUGH)
    z, label = x.copy(), (y - 1) / 2
    z[:, 1] = (z[:, 1] - 4) / 2
    assert set(found) == {(0,), (1,), (2,), (3,)}
    for (f,), m in found.items():
        full = np.column_stack([design(z[fold == f], 3), label[fold == f]])
        assert np.allclose(m.gram(), full.T @ full, rtol=1e-10, atol=1e-8)
    part = found[(2,)].gram(2, [0, 2])
    few = np.column_stack([design(z[fold == 2][:, [0, 2]], 2), label[fold == 2]])
    assert np.allclose(part, few.T @ few, rtol=1e-10, atol=1e-8)


def test_rescaling_is_exact(rows, cloud):
    x, y, _ = cloud
    m = monomials.moment_table(rows, ["a", "b", "c"], "y", 2, rough=ROUGH)[()]
    mean, std, label, spread = m.scales()
    z = x.copy()
    z[:, 1] = (z[:, 1] - 4) / 2
    assert np.allclose(mean, z.mean(axis=0)) and np.allclose(std, z.std(axis=0))
    assert np.allclose([label, spread], [((y - 1) / 2).mean(), y.std() / 2])
    full = np.column_stack([design((x - x.mean(axis=0)) / x.std(axis=0), 2), (y - y.mean()) / y.std()])
    assert np.allclose(m.rescaled(mean, std, label, spread).gram(), full.T @ full, rtol=1e-8, atol=1e-7)


def test_every_degree_equals_a_fit_on_the_expanded_rows(rows, cloud):
    x, y, fold = cloud
    folds = {k[0]: m for k, m in monomials.moment_table(rows, ["a", "b", "c"], "y", 4, ["fold"], ROUGH).items()}
    out = monomials.degree_search(folds, range(1, 5))
    assert len(out) == 16 and {r["n_terms"] for r in out} == {3, 9, 19, 34} and max(r["gradient"] for r in out) < 1e-8
    for r in out:
        train, z = fold != r["fold"], (x - [0, 4, 0]) / [1, 2, 1]
        b = np.linalg.lstsq(design(z[train], r["degree"]), (y[train] - 1) / 2, rcond=None)[0]
        error = lambda at: np.mean(((y[at] - 1) / 2 - design(z[at], r["degree"]) @ b) ** 2)
        assert r["train_mse"] == pytest.approx(error(train), rel=1e-6) and r["test_mse"] == pytest.approx(error(~train), rel=1e-6)
    assert min(out, key=lambda r: r["train_mse"])["degree"] == 4


def test_penalised_models_use_the_same_sums(rows):
    folds = {k[0]: m for k, m in monomials.moment_table(rows, ["a", "b", "c"], "y", 2, ["fold"], ROUGH).items()}
    out = monomials.degree_search(folds, [2], [("ols", 0.0), ("ridge", 1e-9), ("ridge", 50.0), ("lasso", 0.02)], use=[0, 1])
    mean = lambda kind, alpha, what: np.mean([r[what] for r in out if (r["model"], r["alpha"]) == (kind, alpha)])
    assert mean("ridge", 1e-9, "train_mse") == pytest.approx(mean("ols", 0.0, "train_mse"), rel=1e-6)
    assert mean("ols", 0.0, "train_mse") < mean("ridge", 50.0, "train_mse") and mean("ols", 0.0, "train_mse") < mean("lasso", 0.02, "train_mse")


def test_no_rows_and_too_high_degrees(rows):
    assert monomials.moment_table(rows.where("false"), ["a"], "y", 2, ["fold"]) == {}
    assert monomials.degree_search({}, [1]) == []
    with pytest.raises(ValueError):
        monomials.moment_table(rows, ["a"], "y", 1)[()].gram(2)
