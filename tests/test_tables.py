import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from graniteflow.functions import columns as cx
from graniteflow.operators import ordering, split, stats, vectorize


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def test_scalar_columns(spark):
    df = spark.createDataFrame([(1, "a b!", [1, 2], 7), (2, None, None, 9)], "id int, t string, l array<int>, v int")
    out = df.select(
        "id", cx.count_alnum("t").alias("a"), cx.length_without_spaces("t").alias("s"), cx.list_length("l").alias("n"),
        cx.rollup_label("v", 4).alias("r"), cx.relabel("v", {7: 0}).alias("m"), cx.binarise("v", 8).alias("b"),
    )
    assert rows(out, "*") == [(1, 2, 3, 2, 1, 0, 0.0), (2, None, None, 0, 2, 9, 1.0)]


def test_to_numeric_profile_and_types(spark):
    df = spark.createDataFrame([("1.5", 1.0), ("x", None)], "t string, d double")
    texts = {"1.5": 1.5, "x": None, "5d": None, "5f": None, "1.5D": None, " 7 ": 7.0, "-.5e2": -50.0, "": None, "1.": 1.0, ".": None, "1e": None}
    words = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r["t"]: r["v"] for r in words.select("t", cx.to_numeric("t").alias("v")).collect()} == texts
    assert rows(cx.profile(df), "column_name", "n_rows", "n_present") == [("d", 2, 1), ("t", 2, 2)]
    assert cx.columns_of(df, DoubleType) == ["d"]


def test_binarise_all_is_one_row_per_threshold(spark):
    df = spark.createDataFrame([(2.5,), (4.0,)], "r double")
    out = cx.binarise_all(df, "r", [2.5, 3.0])
    assert rows(out, "r", "threshold", "positive") == [(2.5, 2.5, 1.0), (2.5, 3.0, 0.0), (4.0, 2.5, 1.0), (4.0, 3.0, 1.0)]


def test_merged_map_right_wins(spark):
    df = spark.range(1).select(cx.merged_map(F.create_map(F.lit("a"), F.lit(1), F.lit("b"), F.lit(1)), F.create_map(F.lit("b"), F.lit(2))).alias("m"))
    assert df.first()["m"] == {"a": 1, "b": 2}


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(0)
    n = 3000
    key = np.where(rng.random(n) < 0.6, "hot", rng.integers(0, 5, n).astype(str))
    data = [(int(i), str(k), float(v)) for i, (k, v) in enumerate(zip(key, rng.integers(0, 40, n)))]
    return spark.createDataFrame(data, "id int, k string, v double").repartition(7)


def test_running_totals_with_a_hot_key_and_ties(skewed):
    pdf = skewed.toPandas().sort_values(["k", "v", "id"])
    want = pdf.assign(t=pdf.groupby("k")["v"].cumsum())
    got = ordering.running_totals(skewed, ["v", "id"], {"t": F.col("v")}, ["k"], totals=True).toPandas()
    both = want.merge(got, on="id")
    assert len(both) == len(pdf) and (both["t_x"] == both["t_y"]).all()
    assert (got.groupby("k")["v"].sum() == got.groupby("k")["t_total"].first()).all()


def test_row_index_without_keys(skewed):
    got = ordering.row_index(skewed, ["-v", "id"]).toPandas().sort_values("row_no")
    want = skewed.toPandas().sort_values(["v", "id"], ascending=[False, True])
    assert got["id"].tolist() == want["id"].tolist() and got["row_no"].tolist() == list(range(len(want)))


def test_quantiles_match_numpy(skewed):
    got = ordering.quantiles(skewed, "v", [0.25, 0.5, 0.9], ["k"]).toPandas().set_index("k")
    for k, g in skewed.toPandas().groupby("k"):
        assert np.allclose(got.loc[k, ["q0", "q1", "q2"]].astype(float), np.quantile(g["v"], [0.25, 0.5, 0.9]))


def test_top_per_group_limits_before_the_shuffle(skewed):
    top = ordering.top_per_group(skewed, ["k"], ["-v", "id"], 3)
    assert "WindowGroupLimit" in top._jdf.queryExecution().toString()
    want = skewed.toPandas().sort_values(["v", "id"], ascending=[False, True]).groupby("k").head(3)
    assert {r["id"] for r in top.collect()} == set(want["id"])


def test_box_stats_outliers(spark):
    df = spark.createDataFrame([("a", float(v)) for v in [1, 2, 3, 4, 100]], "c string, y double")
    row = stats.box_stats(df, "c", "y", ["a"]).first()
    assert (row["median"], row["n_outliers"], row["low_whisker"], row["high_whisker"], row["place"]) == (3.0, 1, 1.0, 4.0, 1)


def test_histogram_last_bin_is_closed_and_empty_bins_stay(spark):
    df = spark.createDataFrame([(0.0,), (0.5,), (5.0,), (4.6,), (None,)], "x double")
    got = {r["bin"]: r["n"] for r in stats.histogram(df, "x", 10, 0.0, 5.0).collect()}
    assert got[0] == 1 and got[1] == 1 and got[9] == 2 and sum(got.values()) == 4 and len(got) == 10
    assert [(r["left_edge"], r["n"]) for r in stats.histogram(df, "x", 2).orderBy("bin").collect()] == [(0.0, 2), (2.5, 2)]
    assert [r["n"] for r in stats.histogram(df.where("x = 5"), "x", 2).orderBy("bin").collect()] == [0, 1]
    assert sum(r["n"] for r in stats.histogram(df.where("x < 0"), "x", 3).collect()) == 0
    with pytest.raises(ValueError):
        stats.histogram(df, "x", 10, 0.0, 4.9)


def test_quantiles_of_a_frequent_value(spark):
    df = spark.createDataFrame([("a", 7.0)] * 90 + [("a", float(i)) for i in range(10)] + [("b", None)], "k string, x double")
    row = ordering.quantiles(df, "x", [0.05, 0.5, 0.075, 1.0], ["k"]).collect()
    values = sorted([7.0] * 90 + [float(i) for i in range(10)])
    expected = [float(np.quantile(values, q)) for q in (0.05, 0.5, 0.075, 1.0)]
    assert len(row) == 1 and row[0]["n"] == 100 and [row[0][f"q{i}"] for i in range(4)] == pytest.approx(expected)


def test_rank_results_ties_share_the_smaller_rank(spark):
    df = spark.createDataFrame([("a", 0.9), ("b", 0.8), ("c", 0.8), ("d", 0.7)], "m string, s double")
    assert rows(stats.rank_results(df, "s"), "m", "rank") == [("a", 1), ("b", 2), ("c", 2), ("d", 4)]


def test_best_param_and_union(spark):
    df = spark.createDataFrame([(2, 0.5), (4, 0.5), (6, 0.9)], "k int, s double")
    assert tuple(stats.best_param(df, "k", "s", largest=False).first()) == (2, 0.5)
    assert tuple(stats.best_param(df, "k", "s", largest=True).first()) == (6, 0.9)
    assert stats.union_all([df, df.select("s")]).where("k IS NULL").count() == 3


@pytest.mark.parametrize("make", [
    lambda d: split.with_fold(d, "id", 5, seed=1), lambda d: split.with_test_flag(d, ["id", "k"], 0.2, seed=1),
    lambda d: split.bootstrap(d, "id", 3, seed=1),
])
def test_splits_do_not_depend_on_placement(skewed, make):
    assert rows(make(skewed.coalesce(1)), "*") == rows(make(skewed.repartition(7)), "*")


def test_split_shares_and_bootstrap_mean(skewed):
    train, test = split.split(skewed, "id", 0.2, seed=3)
    assert train.count() + test.count() == 3000 and 500 < test.count() < 700
    mean = split.bootstrap(skewed, "id", 2, seed=5).agg(F.avg("weight")).first()[0]
    assert abs(mean - 1.0) < 0.06


def test_tfidf_by_hand_and_frozen_vocabulary(spark):
    docs = spark.createDataFrame([(1,), (2,), (3,)], "doc_id int")
    words = spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (2, "x")], "doc_id int, token string")
    model = vectorize.TfidfModel.fit(words, docs)
    got = {(r["doc_id"], r["term"]): r["w"] for r in model.transform(words).collect()}
    x, y = 2 * (np.log(4 / 3) + 1), np.log(4 / 2) + 1
    assert np.isclose(got[(1, "x")], x / np.hypot(x, y)) and np.isclose(got[(2, "x")], 1.0)
    new = spark.createDataFrame([(9, "z"), (9, "y")], "doc_id int, token string")
    assert [(r["term"], r["w"]) for r in model.transform(new).collect()] == [("y", 1.0)]


def test_tfidf_weights_tokens_where_their_document_lies(spark):
    docs = spark.createDataFrame([(i % 40, f"w{i % 7} w{i % 5} x{i % 3}") for i in range(100)] + [(None, "w1 w1"), (50, None)], "doc_id int, text string")
    words = docs.repartition(4, "doc_id").select("doc_id", F.explode(F.split("text", " ")).alias("token"))
    out = vectorize.tfidf(words, docs, min_df=2)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastHashJoin" in plan
    n, tf, df = 102, {}, {}
    for r in docs.collect():
        for w in (r.text or "").split():
            tf[r.doc_id, w] = tf.get((r.doc_id, w), 0) + 1
    for _, w in tf:
        df[w] = df.get(w, 0) + 1
    raw = {p: c * (np.log((1 + n) / (1 + df[p[1]])) + 1) for p, c in tf.items() if df[p[1]] >= 2}
    norm = {d: np.sqrt(sum(v * v for (e, _), v in raw.items() if e == d)) for d, _ in raw}
    got = {(r.doc_id, r.term): r.w for r in out.collect()}
    assert got.keys() == raw.keys() and all(np.isclose(got[p], v / norm[p[0]]) for p, v in raw.items())


def test_embed_keywords_skips_unknown_words_and_keeps_empty_rows(spark):
    base = spark.createDataFrame([(1,), (2,)], "id int")
    words = spark.createDataFrame([(1, "a"), (1, "b"), (1, "nope")], "id int, word string")
    vecs = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [3.0, 5.0])], "word string, v array<double>")
    assert rows(vectorize.embed_keywords(words, base, vecs, "id", 2), "id", "n_known", "f0", "f1") == [(1, 2, 4.0, 7.0), (2, 0, 0.0, 0.0)]
    assert rows(vectorize.embed_keywords(words, base, vecs, "id", 2, mean=True), "id", "f0") == [(1, 2.0), (2, 0.0)]


def test_scaler_is_population_and_survives_constant_columns(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0), (7.0, 5.0)], "a double, b double")
    got = vectorize.standard_scale(df, ["a", "b"]).toPandas()
    assert np.allclose(got["a"], (np.array([1, 2, 4, 7]) - 3.5) / np.std([1, 2, 4, 7])) and (got["b"] == 0).all()


def test_ordinal_encode_refuses_unseen_values(spark):
    df = spark.createDataFrame([("lo",), ("hi",)], "c string")
    assert rows(df.select(vectorize.ordinal_encode("c", ["lo", "hi"]).alias("e")), "e") == [(0.0,), (1.0,)]
    with pytest.raises(Exception, match="unknown category"):
        df.select(vectorize.ordinal_encode("c", ["lo"]).alias("e")).collect()


def test_polynomial_column_count():
    assert len(vectorize.polynomial_columns(["a", "b", "c"], 3)) == 19
