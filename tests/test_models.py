import numpy as np
import pytest
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from graniteflow.functions.embedding import embed_batch
from graniteflow.operators import classify, metrics, neural, regress, split, tuning


@pytest.fixture(scope="module")
def xy():
    rng = np.random.default_rng(5)
    x = rng.standard_normal((300, 3))
    return x, 1.0 + x @ np.array([2.0, -1.0, 0.0]) + 0.3 * rng.standard_normal(300)


@pytest.fixture(scope="module")
def table(spark, xy):
    x, y = xy
    rows = [(int(i), *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y double").withColumn("features", array_to_vector(F.array("a", "b", "c")))
    return df.cache()


COLS = ["a", "b", "c"]


def test_linear_models_agree_with_closed_forms(table, xy):
    x, y = xy
    gram = regress.gram_table(table, COLS, "y")[()]
    ones = np.column_stack([np.ones(300), x])
    want = np.linalg.lstsq(ones, y, rcond=None)[0]
    plain = table.drop("features")
    ols = regress.ols(plain, COLS, "y").stages[-1]
    assert np.allclose(regress.ridge_from_gram(gram), want) and np.allclose([ols.intercept, *ols.coefficients], want)
    xc, yc = x - x.mean(0), y - y.mean()
    ridge = np.linalg.solve(xc.T @ xc + 50 * np.eye(3), xc.T @ yc)
    assert np.allclose(regress.ridge_from_gram(gram, 50.0)[1:], ridge)
    assert np.allclose(regress.ridge(plain, COLS, "y", 50.0).stages[-1].coefficients, ridge, atol=1e-7)
    b = regress.lasso_from_gram(gram, 0.2)
    grad = xc.T @ (yc - xc @ b[1:]) / 300
    assert np.allclose(grad[b[1:] != 0], 0.2 * np.sign(b[1:][b[1:] != 0]), atol=1e-9) and (np.abs(grad) <= 0.2 + 1e-9).all()
    assert np.allclose(regress.lasso(plain, COLS, "y", 0.2).stages[-1].coefficients, b[1:], atol=1e-5)
    assert regress.mse_from_gram(gram, want) == pytest.approx(np.mean((y - ones @ want) ** 2))


def test_wide_gram_equals_narrow_gram(table, monkeypatch):
    keyed = table.withColumn("k", F.col("id") % 3)
    narrow = regress.gram_table(keyed, COLS, "y", ["k"])
    monkeypatch.setattr(regress, "WIDE", 0)
    wide = regress.gram_table(keyed, COLS, "y", ["k"])
    assert narrow.keys() == wide.keys() and all(np.allclose(narrow[k], wide[k]) for k in narrow)


def test_ols_tests_name_the_constant(table):
    rows = {r["feature"]: r for r in regress.ols_tests(table.drop("features"), COLS, "y").collect()}
    assert rows["a"]["p_value"] < 1e-6 and rows["c"]["p_value"] > 1e-3 and rows["const"]["coef"] == pytest.approx(1.0, abs=0.1)


def test_poly_regression_of_degree_one_is_ols(table):
    plain = table.drop("features")
    a, b = regress.ols(plain, COLS, "y").stages[-1], regress.poly_regression(plain, COLS, "y", 1).stages[-1]
    assert np.allclose(a.coefficients, b.coefficients)


def test_fold_scores_equal_separate_fits(table, xy):
    x, y = xy
    rows = split.with_fold(table, "id", 3, seed=1)
    folds = np.array([r["fold"] for r in rows.orderBy("id").collect()])
    got = regress.linear_fold_scores(rows, COLS, "y", "fold", [("ols", 0.0)])
    for r in got:
        tr, te = folds != r["fold"], folds == r["fold"]
        ones = np.column_stack([np.ones(300), x])
        coef = np.linalg.lstsq(ones[tr], y[tr], rcond=None)[0]
        assert r["test_mse"] == pytest.approx(np.mean((y[te] - ones[te] @ coef) ** 2))
        assert r["train_mse"] == pytest.approx(np.mean((y[tr] - ones[tr] @ coef) ** 2))


def test_feature_scores_and_selection(table, xy):
    x, y = xy
    f = {r["feature"]: r["score"] for r in regress.f_regression(table, COLS, "y").collect()}
    r = np.corrcoef(x[:, 0], y)[0, 1]
    assert f["a"] == pytest.approx(r * r / (1 - r * r) * 298)
    scores = regress.mutual_info(table, COLS, "y", 5)
    assert regress.select_k_best(table, COLS, scores, 1) == ["a"]
    assert regress.select_k_best(table, COLS, scores, None) == COLS
    sweep = regress.feature_count_sweep(table, table, COLS, "y")
    assert [s["worst_feature"] for s in sweep][:2] == ["a", "b"] and sweep[1]["rmse"] < sweep[0]["rmse"]


def test_trees(spark, table):
    model = regress.random_forest("features", "y", trees=4, per_split=2, depth=4).fit(table)
    report = regress.tree_report(spark, model, COLS)
    assert all(abs(r[0] - 1) < 1e-9 for r in report.groupBy("tree").agg(F.sum("importance")).select("sum(importance)").collect())
    row = table.first()
    assert model.predict(row["features"]) == pytest.approx(np.mean([t.predict(row["features"]) for t in model.trees]))
    assert regress.random_forest("features", "y").getMaxDepth() == 30
    with pytest.raises(ValueError):
        regress.random_forest("features", "y", depth=2500)
    short, longer = (regress.gbt("features", "y", "ordered", maxIter=n, maxDepth=3).fit(table) for n in (2, 8))
    rmse = lambda m: metrics.regression_metrics(m.transform(table), "y", "prediction").first()["rmse"]
    assert rmse(longer) < rmse(short)


def test_oob_rows_are_scored_in_one_pass_by_each_tree_that_left_them_out(table):
    from graniteflow.operators.split import bootstrap_weight

    preds = regress.oob_predictions(table, "id", "features", "y", trees=6, per_split=2, depth=4, seed=3)
    plan = preds._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1 and "Exchange" not in plan and "Join" not in plan
    weights = [bootstrap_weight("id", F.lit(b), 3) for b in range(6)]
    wanted = table.select("id", *[(w == 0).cast("int").alias(f"w{b}") for b, w in enumerate(weights)]).collect()
    assert {r.id: r.n_trees for r in preds.collect()} == {r.id: sum(r[1:]) for r in wanted if sum(r[1:])}
    one = regress.oob_predictions(table, "id", "features", "y", trees=1, per_split=2, depth=4, seed=3).collect()
    low, high = table.agg(F.min("y"), F.max("y")).first()
    assert one and all(low <= r.est <= high for r in one)


def test_oob_weights_are_hashed_once_and_stored_with_the_rows(table):
    again = table.unionByName(table)
    preds = regress.oob_predictions(again, "id", "features", "y", trees=3, per_split=2, depth=4, seed=3)
    assert "md5" not in preds._jdf.queryExecution().executedPlan().toString()
    left_out = split.bootstrap(again.select("id"), "id", 3, seed=3).where("out_of_bag").count()
    assert preds.agg(F.sum("n_trees")).first()[0] == left_out


def test_oob_rows_come_from_left_out_trees(table):
    preds = regress.oob_predictions(table, "id", "features", "y", trees=5, per_split=2, depth=4, seed=3)
    left_out = {
        r["id"]: r["n"] for r in split.bootstrap(table.select("id"), "id", 5, seed=3).where("out_of_bag").groupBy("id").agg(F.count(F.lit(1)).alias("n")).collect()
    }
    assert {r["id"]: r["n_trees"] for r in preds.collect()} == left_out
    assert 0 < regress.oob_error(preds, "y").first()["oob_error"] < 1


def _plain_tree(rows, depth, x, y, w):
    """Best split over all features by trying each, then the same on both sides."""
    mean = np.average(y[rows], weights=w[rows])
    best = (1e-9, None)
    for j in range(x.shape[1]) if depth else ():
        for cut in np.unique(x[rows, j])[1:]:
            left, right = rows[x[rows, j] < cut], rows[x[rows, j] >= cut]
            gain = sum(w[p].sum() * (np.average(y[p], weights=w[p]) - mean) ** 2 for p in (left, right))
            if gain > best[0] + 1e-9:
                best = gain, (left, right)
    return {int(r): mean for r in rows} if best[1] is None else {k: v for p in best[1] for k, v in _plain_tree(p, depth - 1, x, y, w).items()}


def test_tree_on_cells_is_the_plain_tree():
    rng = np.random.default_rng(2)
    x, w = rng.integers(0, 6, (80, 2)), rng.integers(1, 4, 80).astype(float)
    y = x[:, 0] * 1.0 + (x[:, 1] > 2) + rng.standard_normal(80)
    for depth in (1, 3, 30):
        got = regress.forest.grow(x.astype(np.uint8), w, w * y, 2, depth, np.random.default_rng(0))
        want = _plain_tree(np.arange(80), depth, x, y, w)
        assert np.allclose(got, [want[i] for i in range(80)])


def test_oob_forest_agrees_with_the_fits_of_spark(spark, monkeypatch):
    """Values on a grid, a common cell, keys that repeat or are null: as many trees a row, about the same error."""
    rng = np.random.default_rng(9)
    x = rng.integers(0, 9, (600, 3)).astype(float)
    x[:200] = 4.0
    y = x[:, 0] - 0.5 * x[:, 1] + 0.3 * rng.standard_normal(600)
    rows = [(None if i == 7 else i % 590, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, y double").withColumn("features", array_to_vector(F.array("a", "b", "c")))
    run = lambda: regress.oob_predictions(df, "id", "features", "y", trees=8, per_split=3, depth=6, seed=1).cache()
    monkeypatch.setattr(regress.forest, "MANY_ROWS", 3)
    new = run()
    monkeypatch.setattr(regress.forest, "CELLS", 0)
    old = run()
    trees = lambda t: sorted((r["id"] is None, r["id"], r["y"], r["n_trees"]) for r in t.collect())
    assert trees(new) == trees(old) and "binned" not in old._jdf.queryExecution().toString()
    same = np.isclose(*[[r["est"] for r in t.orderBy("id", "y").collect()] for t in (new, old)])
    assert same.mean() > 0.8  # equal falls in error may be taken at other features
    errors = [regress.oob_error(t, "y").first()["oob_error"] for t in (new, old)]
    assert errors[0] == pytest.approx(errors[1], rel=0.05)


def test_oob_error_query_grows_the_whole_forest(spark, tmp_path, monkeypatch):
    """150 trees of up to 30 levels: about 55 trees leave a row out, where all of four trees could."""
    from graniteflow.plans import all_queries

    lines = [(i, 1, i % 7, float(i % 50), 100.0 * i + 1, 0.01 * (i % 11), 0.01 * (i % 9), "N") for i in range(60)]
    spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(i, "SMALL", i) for i in range(7)], "p_partkey long, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    seen, original = [], regress.oob_error
    monkeypatch.setattr(regress, "oob_error", lambda preds, y: (seen.append(preds.agg(F.count(F.lit(1)), F.avg("n_trees")).first()), original(preds, y))[1])
    assert all_queries()["oob_error"](spark, str(tmp_path)).first()["n_rows"] == 60
    assert seen[0][0] == 60 and 50 < seen[0][1] < 60


def test_network_gradient_matches_finite_differences():
    rng = np.random.default_rng(0)
    for loss, y in (("squared", rng.standard_normal((6, 2))), ("softmax", rng.integers(0, 2, (6, 1)).astype(float))):
        weights = neural.initial_weights([3, 4, 2], 1)
        x = rng.standard_normal((6, 3))
        _, grads = neural.loss_and_gradient(weights, x, y, loss)
        for layer, at in ((0, (1, 2)), (1, (4, 1)), (0, (3, 0))):
            up, down = [w.copy() for w in weights], [w.copy() for w in weights]
            up[layer][at] += 1e-6
            down[layer][at] -= 1e-6
            diff = (neural.loss_and_gradient(up, x, y, loss)[0] - neural.loss_and_gradient(down, x, y, loss)[0]) / 2e-6
            assert grads[layer][at] == pytest.approx(diff, rel=1e-4, abs=1e-6)


def test_network_without_hidden_layer_finds_least_squares(table, xy):
    rows = table.withColumn("x", F.array(*COLS))
    model = neural.mlp_regressor(rows, "x", "y", 3, [], rate=0.2, steps=60, alpha=0.0)
    assert model.history[-1] < model.history[0]
    want = np.linalg.lstsq(np.column_stack([xy[0], np.ones(300)]), xy[1], rcond=None)[0]
    assert np.allclose(model.weights[0][:, 0], want, atol=0.1)


def test_classifier_network_and_autoencoder(table):
    rows = table.withColumn("x", F.array(*COLS)).withColumn("cls", (F.col("a") > 0).cast("int"))
    model = neural.mlp_classifier(rows, "x", "cls", 3, [8], 2, rate=0.1, steps=25, batches=2, key="id")
    assert rows.where(model.predict_class("x") == F.col("cls")).count() > 270
    auto, code = neural.autoencoder(rows, "x", 3, [], 2, rate=0.05, steps=15)
    assert auto.history[-1] < auto.history[0]
    assert rows.select(F.size(auto.predict("x", 0, code)).alias("n")).distinct().collect()[0]["n"] == 2


def test_network_rows_are_stored_as_blocks_once(table, monkeypatch):
    rows = table.select("id", F.array(*COLS).alias("x"), F.array("y").alias("y"), (F.col("id") % 3).cast("int").alias("_b"))
    monkeypatch.setattr(neural, "BLOCK_ROWS", 7)
    found = neural._blocks(rows).collect()
    assert all(r.n <= 7 for r in found) and len(found) < rows.count() / 3
    pairs = sorted((r._b, *map(float, x), float(y)) for r in found for x, y in zip(
        np.frombuffer(r.x).reshape(r.n, -1), np.frombuffer(r.y), strict=True))
    assert pairs == sorted((r._b, *r.x, *r.y) for r in rows.collect())
    weights = neural.initial_weights([3, 4, 1], 1)
    x, y = np.array([r.x for r in rows.collect()]), np.array([r.y for r in rows.collect()])
    value, grads = neural.loss_and_gradient(weights, x, y, "squared")
    n, total, flat = neural._gradient_sum(neural._blocks(rows), weights, "squared", 2)
    assert n == len(x) and np.isclose(total, value) and np.allclose(flat, np.concatenate([g.ravel() for g in grads]))


def test_network_rows_with_a_null_number_or_a_null_array_are_errors(spark):
    rows = spark.createDataFrame([(0, [1.0, None], [1.0]), (0, [1.0, 2.0], [3.0])], "_b int, x array<double>, y array<double>")
    assert np.isnan(np.concatenate([np.frombuffer(r.x) for r in neural._blocks(rows).collect()])).sum() == 1
    with pytest.raises(Exception, match="not a number"):
        neural._gradient_sum(neural._blocks(rows), neural.initial_weights([2, 1]), "squared", 1)
    with pytest.raises(Exception, match="arrays of one length"):
        neural._blocks(rows.unionByName(spark.createDataFrame([(0, None, [1.0])], rows.schema)).coalesce(1)).collect()


def test_embed_batch(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([3.0, 4.0],)], "v array<double>")
    got = [r["e"] for r in df.select(embed_batch("v", lambda: lambda b: b @ np.array([[1.0, 0.0], [1.0, 2.0]]), 2).alias("e")).collect()]
    assert got == [[3.0, 4.0], [7.0, 8.0]]


# ------------------------------------------------------------- classification
@pytest.fixture(scope="module")
def classes(table):
    return table.withColumn("label", (F.col("a") + 0.3 * F.col("b") > 0).cast("double")).withColumn(
        "kind", F.when(F.col("a") > 0.5, 2.0).when(F.col("b") > 0, 1.0).otherwise(0.0)
    ).cache()


def test_gaussian_classes_equal_the_vector_form(classes):
    rows = classes.withColumn("name", F.col("kind"))
    mine = classify.GaussianClasses.fit(rows, COLS, "kind", smoothing=0.0).transform(rows, "p1")
    other = classify.gaussian_nb(rows, label="kind").transform(mine)
    assert other.where("p1 <> prediction").count() == 0


def test_class_weights_sum_to_rows(classes):
    out = classify.class_weights(classes, "kind")
    sums = [r[0] for r in out.groupBy("kind").agg(F.sum("weight")).select("sum(weight)").collect()]
    assert np.allclose(sums, 100.0)


def test_logistic_penalties(classes, xy):
    model = classify.logistic(classes, "l2", 2.0, max_iter=500, tol=1e-10)
    w = np.array([*model.coefficients])
    y = np.array([r["label"] for r in classes.orderBy("id").collect()])
    p = 1 / (1 + np.exp(-(xy[0] @ w + model.intercept)))
    assert np.allclose(2.0 * xy[0].T @ (p - y) + w, 0, atol=1e-3)
    zeros = [int(np.sum(np.array([*classify.logistic(classes, "l1", c).coefficients]) == 0)) for c in (0.005, 100.0)]
    assert zeros[0] > zeros[1]


def test_svm_and_multiclass_votes(classes):
    svm = classify.linear_svm(classes, 1.0, max_iter=20)
    out = svm.transform(classes)
    assert metrics.binary_metrics(out, "label", "prediction", 1.0).first()["accuracy"] > 0.95
    rows = classes.withColumn("label", F.col("kind"))
    model = classify.one_vs_one(rows, lambda d: LogisticRegression(maxIter=20).fit(d), parallelism=2)
    voted = model.transform(rows)
    assert len(model.models) == 3
    assert {sum(r["votes"]) for r in voted.select("votes").collect()} == {3}
    assert voted.where("prediction = kind").count() > 270
    rest = classify.one_vs_rest(rows, LogisticRegression(maxIter=20)).transform(rows)
    assert rest.where("prediction = kind").count() > 240


@pytest.mark.parametrize("settings", [
    {"reducer": None}, {"reducer": "nmf", "components": 2, "iterations": 3}, {"reducer": "lsi", "components": 2, "rounds": 2, "analyzer": "stem", "clean": True},
])
def test_text_pipeline_keeps_empty_documents(spark, settings):
    texts = ["apple banana apples", "banana apple fruit", "engine wheel motor", "wheel engine car motors", "", "the of"]
    df = spark.createDataFrame([(i, t, float(i in (2, 3))) for i, t in enumerate(texts)], "doc_id long, text string, label double")
    model = classify.text_pipeline(LogisticRegression(maxIter=10), min_df=1, **settings).fit(df)
    out = model.transform(df).collect()
    assert len(out) == 6 and {r["doc_id"] for r in out} == set(range(6))
    assert all(r["prediction"] == r["label"] for r in out if r["doc_id"] < 4)


def test_text_features_count_words_once_where_documents_lie(spark, monkeypatch):
    """The fitted table is counted once and other tables once each; the features are those of the joins, also for keys that repeat."""
    from graniteflow.operators import sparse

    rng = np.random.default_rng(4)
    words = ["apple", "banana", "fruit", "engine", "wheel", "motor", "the", "x1"]
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 9))), float(i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, label double").cache()
    other = df.where("doc_id < 20").withColumn("doc_id", F.col("doc_id") + 100)
    other = other.unionByName(spark.createDataFrame([(200, "", 0.0), (201, None, 0.0), (202, "unheard words", 0.0)], df.schema))
    twice = other.unionByName(other.limit(5))
    calls, original = [], sparse.term_counts
    monkeypatch.setattr(sparse, "term_counts", lambda *a: (calls.append(1), original(*a))[1])
    found = lambda model, t: sorted((r["doc_id"], *r["features"]) for r in model.transform(t).collect())
    settings = {"clean": True, "min_df": 2, "reducer": "lsi", "components": 2, "rounds": 8}
    model = classify.TextFeatures(**settings).fit(df)
    new = [found(model, df), found(model, other), found(model, twice)]
    assert len(calls) == 2
    monkeypatch.setattr(classify.TextFeatures, "listed", lambda self, t: None)
    model = classify.TextFeatures(**settings).fit(df)
    for a, t in zip(new, (df, other, twice), strict=True):
        assert np.allclose(a, found(model, t), atol=1e-6)


def test_text_pipeline_query_cleans_its_texts(spark, tmp_path, monkeypatch):
    """Half of the texts have their words inside marks only: cleaned, these texts are without a word."""
    from graniteflow.plans import all_queries

    words = ["apple", "banana", "fruit", "engine", "wheel", "motor"]
    texts = [f"<b {words[i % 6]} {words[(i + 1) % 6]}>" if i % 2 else f"{words[i % 6]} {words[(i + 2) % 6]} {words[(i + 3) % 6]}" for i in range(120)]
    rows = [(i, t, "en" if i % 3 else "de") for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    seen, original = [], classify.TextFeaturesModel._transform

    def transform(self, df):
        out = original(self, df)
        seen.extend((r["text"], max(map(abs, r["features"]))) for r in out.select("text", "features").collect())
        return out

    monkeypatch.setattr(classify.TextFeaturesModel, "_transform", transform)
    assert all_queries()["text_pipeline"](spark, str(tmp_path)).count() == 1
    marked = [size for text, size in seen if text.startswith("<")]
    assert marked and not any(marked) and any(size for text, size in seen if not text.startswith("<"))


def test_mlp_classifier_query_takes_empty_texts_and_any_number_of_languages(spark, tmp_path):
    from graniteflow.plans import all_queries

    texts = {"de": "ein schöner tag über land", "en": "one fine day", "es": "un día en españa y más allá del río", "fr": "été à l'hôtel où ça", "it": "una bella giornata di sole"}
    rows = [(i, texts[lang] * (1 + i % 4) if i else "", lang) for i, lang in enumerate(sorted(texts) * 30)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    found = all_queries()["mlp_classifier"](spark, str(tmp_path)).first()
    assert 0 < found["accuracy"] <= 1


# --------------------------------------------------------------------- tuning
def test_cross_validation_and_prefix_cache(spark, classes):
    rows = split.with_fold(classes, "id", 2, seed=4)
    from pyspark.ml.feature import StandardScaler

    def build(p):
        stage = StandardScaler(inputCol="features", outputCol="scaled", withMean=p["mean"])
        return ("scale", p["mean"]), [stage], LinearSVC(featuresCol="scaled", maxIter=5, regParam=p["reg"])

    fits = []
    original = tuning.PrefixCache.clear
    tuning.PrefixCache.clear = lambda self: (fits.append(self.fits), original(self))[1]
    try:
        found = tuning.grid_search(build, tuning.grid(mean=[True, False], reg=[0.1, 1.0]), rows, "fold", range(2), tuning.MacroF1("label"))
    finally:
        tuning.PrefixCache.clear = original
    assert len(found) == 8 and fits == [4]
    table = tuning.cv_results(tuning.scores_table(spark, found), ["candidate"])
    assert table.count() == 4 and table.agg(F.min("rank")).first()[0] == 1
    report = tuning.search_report(table, "candidate", 1.5).first()
    assert report["n_candidates"] == 4 and report["best_mean"] == table.agg(F.max("mean_test")).first()[0]


def test_cross_validate_in_threads(classes):
    rows = split.with_fold(classes, "id", 3, seed=4)
    found = tuning.cross_validate(lambda: LogisticRegression(maxIter=5), rows, "fold", range(3), tuning.NegRmse("label"), parallelism=3)
    assert [r["fold"] for r in found] == [0, 1, 2] and all(r["test_score"] <= 0 for r in found)


def test_random_search_repeats_and_stops(spark):
    space = {"alpha": tuning.log_uniform(1e-3, 1e3), "depth": tuning.whole_number(2, 5), "kind": tuning.one_of("x", "y")}
    a, b = tuning.draw(spark, space, 20, seed=1), tuning.draw(spark, space, 20, seed=1)
    assert a == b and a != tuning.draw(spark, space, 20, seed=2)
    assert all(1e-3 <= p["alpha"] <= 1e3 and 2 <= p["depth"] <= 5 for p in a)
    found = tuning.random_search(lambda p: 1.0, a, parallelism=3, patience=5)
    assert 6 <= len(found) < 20
    assert len(tuning.random_search(lambda p: 1.0, a, deadline=-1.0)) == 3


def test_param_effects(spark):
    rows = spark.createDataFrame([("1", 0.1, 0.5), ("2", 0.2, 0.5), ("None", 0.9, 0.9), ("3", 0.3, 0.5)], "p string, mean_test double, mean_train double")
    got = {(r["col_a"], r["col_b"]): r["corr"] for r in tuning.param_effects(rows, ["p"]).collect()}
    assert got[("p", "mean_test")] == pytest.approx(1.0)
