import numpy as np
import pytest
from pyspark.sql import functions as F

from graniteflow.operators import recommend


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(4)
    seen = {}
    for u in range(23):
        for i in rng.choice(17, size=rng.integers(1, 12), replace=False):
            seen[(u, int(i))] = float(rng.integers(1, 11)) / 2
    for u in range(23):  # an item everybody rated
        seen[(u, 17)] = float(rng.integers(1, 11)) / 2
    return seen


def frame(spark, seen):
    return spark.createDataFrame([(u, i, r) for (u, i), r in seen.items()], "user long, item long, rating double")


def similarity(train, u, v):
    common = [i for (w, i) in train if w == u and (v, i) in train]
    if not common:
        return None
    x, y = np.array([train[(u, i)] for i in common]), np.array([train[(v, i)] for i in common])
    n = len(x)
    a, b = n * (x * x).sum() - x.sum() ** 2, n * (y * y).sum() - y.sum() ** 2
    return 0.0 if a <= 1e-9 or b <= 1e-9 else round((n * (x * y).sum() - x.sum() * y.sum()) / np.sqrt(a * b), 9)


@pytest.fixture(params=[(512, 4096, 20_000), (5, 4096, 20_000), (5, 4, 6)], ids=["one-block", "user-blocks", "slices-and-parts"])
def blocks(request, monkeypatch):
    for name, value in zip(("USERS_PER_BLOCK", "ITEMS_PER_SLICE", "TESTS_PER_PART"), request.param):
        monkeypatch.setattr(recommend, name, value)


def test_all_similarities(spark, data, blocks):
    rows = recommend.pearson_similarity(frame(spark, data), 100).collect()
    got = {(r["user"], r["peer"]): (r["n"], r["sim"]) for r in rows}
    assert got == {(v, u): x for (u, v), x in got.items()}
    got = {k: v for k, v in got.items() if k[0] < k[1]}
    want = {}
    for u in range(23):
        for v in range(u + 1, 23):
            s = similarity(data, u, v)
            if s is not None:
                want[(u, v)] = s
    assert got.keys() == want.keys()
    assert all(got[k][1] == pytest.approx(want[k], abs=2e-9) for k in want)


def test_knn_predictions(spark, data, blocks):
    test = {k: r for n, (k, r) in enumerate(data.items()) if n % 6 == 0}
    train = {k: r for k, r in data.items() if k not in test}
    test |= {(99, 3): 4.0, (1, 77): 2.0}
    mean = np.mean(list(train.values()))
    means = {u: np.mean([r for (w, _), r in train.items() if w == u]) for u in range(23)}
    got = recommend.knn_sweep(frame(spark, train), frame(spark, test), [1, 3, 50]).collect()
    assert len(got) == 3 * len(test)
    for r in got:
        u, i, k = r["user"], r["item"], r["k"]
        if u not in means or all(j != i for _, j in train):
            assert r["impossible"] and r["est"] == pytest.approx(mean)
            continue
        near = sorted(((-(similarity(train, u, v) or 0), v) for (v, j) in train if j == i and v != u))[:k]
        near = [(-s, v) for s, v in near if s < 0]
        want = means[u]
        if near:
            want += sum(s * (train[(v, i)] - means[v]) for s, v in near) / sum(s for s, _ in near)
        assert r["est"] == pytest.approx(min(5.0, max(0.5, want)), abs=1e-6)


def test_similar_users_are_ranked(spark, data):
    rows = recommend.pearson_similarity(frame(spark, data), 3).collect()
    assert max(r["rank"] for r in rows) == 3
    for r in rows:
        assert r["sim"] == pytest.approx(similarity(data, r["user"], r["peer"]), abs=2e-9)


def test_folds_at_once_equal_one_by_one(spark, data, blocks):
    rows = frame(spark, data).withColumn("fold", ((F.col("item") + F.col("user")) % 3).cast("int")).withColumn("train", F.lit(True))
    got = {(r["user"], r["item"], r["k"]): (r["est"], r["impossible"]) for r in recommend.knn_folds(rows, [1, 4, 40]).collect()}
    want = {}
    for fold in range(3):
        part = recommend.knn_sweep(rows.where(F.col("fold") != fold), rows.where(F.col("fold") == fold), [1, 4, 40])
        want |= {(r["user"], r["item"], r["k"]): (r["est"], r["impossible"]) for r in part.collect()}
    assert got.keys() == want.keys() and len(got) == 3 * len(data)
    assert all(got[k][0] == pytest.approx(want[k][0], abs=1e-7) and got[k][1] == want[k][1] for k in got)


def test_subsets_and_user_filter(spark):
    rows = spark.createDataFrame(
        [(u, 1, float(r)) for u, r in enumerate([1, 5, 1, 5, 1])] + [(1, 2, 3.0), (2, 2, 3.0)], "user long, item long, rating double"
    )
    got = {(r["item"], r["subset"]) for r in recommend.subset_items(rows).collect()}
    assert got == {(1, "popular"), (1, "high_variance"), (2, "unpopular")}
    subsets = recommend.subset_items(rows)
    assert recommend.subset_filter(rows, subsets, "unpopular").count() == 2
    assert {r["user"] for r in recommend.filter_users(rows, 2, 4.0).collect()} == {1}


def test_precision_recall_by_hand(spark):
    preds = spark.createDataFrame(
        [(1, 1, 5.0, 4.9), (1, 2, 1.0, 4.5), (1, 3, 4.0, 2.0), (2, 1, 4.0, 3.0), (3, 1, 1.0, 5.0)],
        "user long, item long, rating double, est double",
    )
    got = {r["t"]: (r["n_users"], r["precision"], r["recall"]) for r in recommend.precision_recall_at_t(preds, 3, 3.0).collect()}
    assert got[1] == (2, 1.0, 0.75)
    assert got[2] == (1, 0.5, 0.5) and got[3] == (1, pytest.approx(2 / 3), 1.0)


def test_user_mean_filter_flag(spark):
    rows = spark.createDataFrame([(1, 1, 2.0, 1), (1, 2, 4.0, 0), (2, 1, 5.0, 0)], "user long, item long, rating double, fold int")
    test = F.col("fold") == 0
    est = lambda flag: {(r["user"], r["item"]): r["est"] for r in recommend.user_mean_filter(rows, test, flag).collect()}
    assert est(True) == {(1, 2): 2.0, (2, 1): 2.0} and est(False) == {(1, 2): 3.0, (2, 1): 5.0}


def test_factor_models_on_planted_ratings(spark):
    rng = np.random.default_rng(0)
    p, q = rng.random((30, 2)) + 0.2, rng.random((20, 2)) + 0.2
    r = p @ q.T
    r = 0.5 + 4.5 * (r - r.min()) / (r.max() - r.min())
    rows = spark.createDataFrame([(u, i, float(r[u, i])) for u in range(30) for i in range(20)], "user int, item int, rating double")
    test, train = rows.where("(user + item) % 5 = 0"), rows.where("(user + item) % 5 <> 0")
    rmse = lambda d: d.agg(F.sqrt(F.avg((F.col("rating") - F.col("est")) ** 2))).first()[0]
    model = recommend.nmf_recommender(train, 2, iterations=10)
    assert min(min(x["features"]) for x in model.itemFactors.collect()) >= 0
    base = float(np.std(r))
    assert rmse(recommend.nmf_predict(model, train, test)) < 0.5 * base
    assert rmse(recommend.biased_mf(train, test, 2, iterations=5)) < 0.5 * base
    new = spark.createDataFrame([(999, 1, 3.0)], "user int, item int, rating double")
    mean = train.agg(F.avg("rating")).first()[0]
    assert recommend.nmf_predict(model, train, new).first()["est"] == pytest.approx(mean)
    items = spark.createDataFrame([(i, f"g{i}") for i in range(20)], "item int, genres string")
    top = recommend.top_factor_items(model.itemFactors, items, 4).collect()
    assert len(top) == 8 and all(r["genres"] == f"g{r['item']}" for r in top)


def test_best_sorts_in_larger_values_only():
    rng = np.random.default_rng(1)
    seen, held = [np.zeros((40, 0)), np.zeros((40, 0))], [np.zeros((40, 0)), np.zeros((40, 0))]
    for step in range(6):
        new = [np.maximum(rng.integers(-3, 9, (40, 7)) / 8.0, 0.0), rng.random((40, 7))]
        seen = [np.concatenate([a, b], axis=1) for a, b in zip(seen, new, strict=True)]
        held = recommend._best(held, new, 5, 0.0)
        order = np.argsort(-seen[0], axis=1, kind="stable")[:, :5]
        want = [np.take_along_axis(a, order, axis=1) for a in seen]
        real = want[0] > 0
        width = held[0].shape[1]
        assert not real[:, width:].any() and (held[0][:, :5] == want[0][:, :width]).all()
        assert all((np.where(held[0] > 0, h, 0) == np.where(real, w, 0)[:, :width]).all() for h, w in zip(held, want, strict=True))
    same = recommend._best(held, [np.zeros((40, 3)), np.zeros((40, 3))], 5, 0.0)
    assert all(a is b for a, b in zip(same, held, strict=True))  # nothing above the floor, nothing sorted


def test_users_travel_as_blocks(spark, data):
    """Ratings are packed before homes and guests meet, so a meeting costs a row for each block, not for each rating."""
    plan = recommend.pearson_similarity(frame(spark, data), 3)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list") == 2


def test_bias_rounds_start_without_a_join_and_leave_out_null_keys(spark):
    cells = [(u, i, float((u * 7 + i * 3) % 9) / 2 + 0.5) for u in range(6) for i in range(5) if (u + i) % 4]
    train = spark.createDataFrame([*cells, (None, 1, 5.0), (2, None, 4.0)], "user int, item int, rating double")
    mean, items, users = recommend.bias_tables(train, rounds=1)
    assert not any("Join" in d._jdf.queryExecution().executedPlan().toString() for d in (items, users))  # stored
    mean, items, users = recommend.bias_tables(train)
    cells, bu = [*cells, (None, 1, 5.0), (2, None, 4.0)], None
    for _ in range(2):
        rows = [x for x in cells if x[0] is not None]
        bi = {k: sum(r - mean - (bu[u] if bu else 0) for u, i, r in rows if i == k) / (10 + sum(i == k for _, i, _ in rows)) for k in {i for _, i, _ in rows}}
        rows = [x for x in cells if x[1] is not None]
        bu = {k: sum(r - mean - bi[i] for u, i, r in rows if u == k) / (15 + sum(u == k for u, _, _ in rows)) for k in {u for u, _, _ in rows}}
    got = {r["item"]: r["bi"] for r in items.collect()}, {r["user"]: r["bu"] for r in users.collect()}
    for found, want in zip(got, (bi, bu), strict=True):
        assert found.keys() == want.keys() and all(abs(found[k] - v) < 1e-9 for k, v in want.items())
