"""Linear models, feature scores and search tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from graniteflow.operators import monomials, regress, split, stats, tuning, vectorize
from graniteflow.plans.catalog import query
from graniteflow.plans.sqltools import sql_gram, sql_mse, sql_solve
from graniteflow.plans.table_queries import ENCODED, encoded_net_price
from graniteflow.plans.views import NET_FEATURES, NET_PRICE, TWEETS, net_price, sql_fold, sql_unit, tweets, with_sql

KEYS = ["l_orderkey", "l_linenumber", "l_partkey"]
LINEAR = ["l_extendedprice", "l_discount", "l_tax", "l_quantity"]


def _r6(df, keep, cols, digits=6):
    return df.select(*keep, *[F.round(c, digits).alias(c) for c in cols])


def scaled_prices(t, cols=LINEAR):
    """Population-standardised features and label of the price view."""
    return vectorize.standard_scale(net_price(t).select(*KEYS, *cols, "price"), [*cols, "price"])


def sql_scaled(name, source, cols, keep):
    cells = ", ".join(f"({c} - avg({c}) OVER ())/stddev_pop({c}) OVER () AS {c}" for c in cols)
    return f"{name} AS (SELECT {', '.join(keep)}, {cells} FROM {source})"


Z = sql_scaled("z", "net_price", [*LINEAR, "price"], KEYS)
GRAM = sql_gram("gram", "z", LINEAR, "price")


def _coef_rows(names, table, keep="", expr="b"):
    return " UNION ALL ".join(
        f"SELECT {keep}'{c}' AS feature, round({expr}_{i}, 6) AS coef FROM {table}" for i, c in names
    )


COEFS = [(0, "const")] + [(i + 1, c) for i, c in enumerate(LINEAR)]


@query("ols", with_sql(NET_PRICE, Z, GRAM, *sql_solve("sol", "gram", 5), _coef_rows(COEFS, "sol")))
def ols(t):
    model = regress.ols(scaled_prices(t), LINEAR, "price").stages[-1]
    rows = [("const", float(model.intercept))] + [(c, float(b)) for c, b in zip(LINEAR, model.coefficients)]
    return t.spark.createDataFrame(rows, "feature string, coef double").select("feature", (F.round("coef", 6) + 0.0).alias("coef"))


ALPHAS = [100.0, 1000.0, 10000.0, 100000.0]


@query("ridge_path", with_sql(NET_PRICE, Z, GRAM, f"path AS (SELECT *, unnest({ALPHAS})::DOUBLE AS alpha FROM gram)",
                              *sql_solve("sol", "path", 5, alpha="alpha"), _coef_rows(COEFS, "sol", "alpha, ")))
def ridge_path(t):
    gram = regress.gram_table(scaled_prices(t), LINEAR, "price")[()]
    rows = [
        (a, c, float(b)) for a in ALPHAS for c, b in zip(["const", *LINEAR], regress.ridge_from_gram(gram, a))
    ]
    out = t.spark.createDataFrame(rows, "alpha double, feature string, coef double")
    return out.select("alpha", "feature", (F.round("coef", 6) + 0.0).alias("coef"))


@query("lasso_path")
def lasso_path(t):
    gram = regress.gram_table(scaled_prices(t), LINEAR, "price")[()]
    rows = [
        (a, c, float(b)) for a in (0.01, 0.1, 1.0) for c, b in zip(["const", *LINEAR], regress.lasso_from_gram(gram, a))
    ]
    return t.spark.createDataFrame(rows, "alpha double, feature string, coef double")


@query("ols_tests", with_sql(NET_PRICE, Z, GRAM, *sql_solve("sol", "gram", 5, inverse=True),
                             f"fit AS (SELECT *, {sql_mse(5)}*g_0_0/(g_0_0-5) AS s2 FROM sol)",
                             " UNION ALL ".join(f"SELECT '{c}' AS feature, round(b_{i}, 4) AS coef, round(b_{i}/sqrt(s2*d_{i}), 4) AS t, "
                                                f"abs(b_{i}/sqrt(s2*d_{i})) > 1.96 AS significant FROM fit" for i, c in COEFS)))
def ols_tests(t):
    """The rows are so many that a p-value below 0.05 is a t beyond 1.96."""
    out = regress.ols_tests(scaled_prices(t), LINEAR, "price")
    return out.select("feature", F.round("coef", 4).alias("coef"), F.round("t", 4).alias("t"), (F.col("p_value") < 0.05).alias("significant"))


POLY_TERMS = ["l_discount", "l_tax", "dd", "dt", "tt"]


@query("poly_regression", with_sql(NET_PRICE, Z, """
zp AS (SELECT *, l_discount*l_discount AS dd, l_discount*l_tax AS dt, l_tax*l_tax AS tt FROM z)""",
       sql_gram("gram", "zp", POLY_TERMS, "price"), *sql_solve("sol", "gram", 6),
       _coef_rows([(0, "const")] + [(i + 1, c) for i, c in enumerate(POLY_TERMS)], "sol")))
def poly_regression(t):
    model = regress.poly_regression(scaled_prices(t), ["l_discount", "l_tax"], "price", 2).stages[-1]
    # Order of the expanded monomials of (d, t): d, d·d, t, d·t, t·t.
    names = ["l_discount", "dd", "l_tax", "dt", "tt"]
    rows = [("const", float(model.intercept))] + [(c, float(b)) for c, b in zip(names, model.coefficients)]
    return t.spark.createDataFrame(rows, "feature string, coef double").select("feature", (F.round("coef", 6) + 0.0).alias("coef"))


SQL_F = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(power(corr({c}, price), 2)/(1-power(corr({c}, price), 2))*(count(*)-2), 4) AS score FROM encoded"
    for c in NET_FEATURES)


@query("f_regression", with_sql(NET_PRICE, ENCODED, SQL_F))
def f_regression(t):
    return _r6(regress.f_regression(encoded_net_price(t), NET_FEATURES, "price"), ["feature"], ["score"], 4)


def _sql_bins(col):
    return f"CAST(floor((rank() OVER (ORDER BY {col}) - 1)*10/count(*) OVER ()) AS INTEGER)"


SQL_MI = with_sql(NET_PRICE, ENCODED,
    "binned AS (SELECT " + ", ".join(f"{_sql_bins(c)} AS {c}" for c in [*NET_FEATURES, "price"]) + " FROM encoded)",
    "long AS (" + " UNION ALL ".join(f"SELECT '{c}' AS feature, {c} AS bx, price AS bp FROM binned" for c in NET_FEATURES) + ")", """
cells AS (SELECT feature, bx, bp, count(*) AS c FROM long GROUP BY ALL),
tot AS (SELECT feature, sum(c) AS n FROM cells GROUP BY 1),
mx AS (SELECT feature, bx, sum(c) AS a FROM cells GROUP BY ALL), mp AS (SELECT feature, bp, sum(c) AS b FROM cells GROUP BY ALL),
mi AS (SELECT feature, round(sum(c/n*ln(c*n/(CAST(a AS DOUBLE)*b))), 6) AS score FROM cells JOIN tot USING (feature)
       JOIN mx USING (feature, bx) JOIN mp USING (feature, bp) GROUP BY 1)""", "{tail}")


@query("mutual_info", SQL_MI.replace("{tail}", "SELECT * FROM mi"))
def mutual_info(t):
    return _r6(regress.mutual_info(encoded_net_price(t), NET_FEATURES, "price", 10), ["feature"], ["score"])


@query("select_k_best", SQL_MI.replace("{tail}", "SELECT feature FROM mi ORDER BY score DESC, feature LIMIT 3"))
def select_k_best(t):
    rows = encoded_net_price(t)
    scores = mutual_info(t)
    names = regress.select_k_best(rows, NET_FEATURES, scores, 3)
    return t.spark.createDataFrame([(n,) for n in names], "feature string")


SPLIT_Z = sql_scaled("z", "net_price", [*LINEAR, "price"], [*KEYS, f"{sql_unit(42, *KEYS)} < 0.2 AS is_test"])
# Rough centre and scale in which the columns are summed; results do not depend on them.
ROUGH = {
    "l_extendedprice": (50000.0, 30000.0), "l_discount": (0.05, 0.03), "l_tax": (0.04, 0.02), "l_quantity": (25.0, 15.0),
    "p_size": (25.0, 15.0), "p_type": (2.5, 2.0), "l_returnflag": (1.0, 1.0), "price": (50000.0, 30000.0),
}


def _sql_sweep():
    ranked = "o AS (SELECT feature, row_number() OVER (ORDER BY score DESC, feature) AS k FROM mi)"
    pick = ", ".join(
        f"CASE (SELECT feature FROM o WHERE k = {k}) " + " ".join(f"WHEN '{c}' THEN ({c} - avg({c}) OVER ())/stddev_pop({c}) OVER ()" for c in NET_FEATURES) + f" END AS f{k}"
        for k in range(1, len(NET_FEATURES) + 1))
    cols = [f"f{k}" for k in range(1, len(NET_FEATURES) + 1)]
    parts = [ranked, f"z AS MATERIALIZED (SELECT {sql_unit(42, *KEYS[:2])} < 0.2 AS is_test, {pick}, (price - avg(price) OVER ())/stddev_pop(price) OVER () AS price FROM encoded)"]
    pieces = []
    for k in range(1, len(cols) + 1):
        parts += [sql_gram(f"ga{k}", "(SELECT * FROM z WHERE NOT is_test)", cols[:k], "price"), sql_gram(f"gb{k}", "(SELECT * FROM z WHERE is_test)", cols[:k], "price")]
        parts += sql_solve(f"s{k}", f"ga{k}", k + 1)
        pieces.append(f"SELECT CAST({k} AS BIGINT) AS k, (SELECT feature FROM o WHERE k = {k}) AS worst_feature, "
                      f"round(sqrt({sql_mse(k + 1, f'gb{k}.', f's{k}.')}), 6) AS rmse FROM s{k} CROSS JOIN gb{k}")
    head, tail = SQL_MI.rsplit("{tail}", 1)
    return head.rstrip() + ", " + ", ".join(parts) + " " + " UNION ALL ".join(pieces) + tail


def _split_moments(rows, cols, y, keys):
    """(total, train, test) moments of the fixed split, from one pass."""
    table = monomials.moment_table(split.with_test_flag(rows, keys, 0.2, seed=42), cols, y, 1, ["is_test"], ROUGH)
    train, test = table[(False,)], table[(True,)]
    return train + test, train, test


@query("feature_count_sweep", _sql_sweep())
def feature_count_sweep(t):
    """All seven columns, in the order of their mutual information with the price."""
    scores = {r["feature"]: r["score"] for r in mutual_info(t).collect()}
    order = sorted(NET_FEATURES, key=lambda c: (-scores[c], c))
    total, train, test = _split_moments(encoded_net_price(t), order, "price", KEYS[:2])
    unit = total.scales()
    train, test = train.rescaled(*unit), test.rescaled(*unit)
    out = []
    for k in range(1, len(order) + 1):
        coef = monomials.fit(train.gram(1, list(range(k))))
        out.append({"k": k, "worst_feature": order[k - 1], "rmse": regress.mse_from_gram(test.gram(1, list(range(k))), coef) ** 0.5})
    table = regress.result_rows(t.spark, out, "k bigint, worst_feature string, rmse double")
    return table.select("k", "worst_feature", F.round("rmse", 6).alias("rmse"))


SCALED_MODELS = [("ols", 0.0), ("ridge", 10000.0), ("lasso", 0.01), ("lasso", 0.1)]


def _sql_lasso(name, source, p, alphas, rounds=400):
    """CTEs of the minimiser of the mean squared error / 2 + alpha * sum of sizes, by coordinate steps on centred sums."""
    mean = lambda i: f"(g_0_{i}/g_0_0)"
    cells = [f"g_{i}_{j}/g_0_0 - {mean(i)}*{mean(j)} AS q_{i}_{j}" for i in range(1, p + 1) for j in range(i, p + 2)]
    q = lambda i, j: f"q_{min(i, j)}_{max(i, j)}"
    out = [f"{name}_q AS MATERIALIZED (SELECT *, {', '.join(cells)} FROM {source}, (SELECT unnest({alphas})::DOUBLE AS alpha))"]
    step, keep = f"{name}_r", ", ".join(f"b_{i}" for i in range(1, p + 1))
    inner = f"SELECT * FROM {step} JOIN {name}_q USING (alpha) WHERE step < {rounds}"
    for i in range(1, p + 1):
        rest = f"({q(i, p + 1)} - " + " - ".join(f"b_{j}*{q(i, j)}" for j in range(1, p + 1) if j != i) + ")"
        inner = f"SELECT * REPLACE (sign({rest})*greatest(abs({rest}) - alpha, 0)/{q(i, i)} AS b_{i}) FROM ({inner})"
    zero = ", ".join(f"0.0::DOUBLE AS b_{i}" for i in range(1, p + 1))
    out.append(f"{step} AS (SELECT 0 AS step, alpha, {zero} FROM {name}_q UNION ALL SELECT step + 1 AS step, alpha, {keep} FROM ({inner}))")
    base = f"{mean(p + 1)} - " + " - ".join(f"b_{i}*{mean(i)}" for i in range(1, p + 1))
    out.append(f"{name} AS MATERIALIZED (SELECT *, {base} AS b_0 FROM {step} JOIN {name}_q USING (alpha) WHERE step = {rounds})")
    return out


def _sql_scaling():
    raw = f"raw AS (SELECT *, {sql_unit(42, *KEYS)} < 0.2 AS is_test FROM net_price)"
    cells = ", ".join(f"{c}/1000 AS {c}" if c == "l_extendedprice" else c for c in LINEAR)
    unscaled = f"u AS (SELECT is_test, {cells}, (price - avg(price) OVER ())/stddev_pop(price) OVER () AS price FROM raw)"
    parts = [NET_PRICE, raw, unscaled, SPLIT_Z]
    body = []
    lassos = [a for m, a in SCALED_MODELS if m == "lasso"]
    for name, src in (("scaled", "z"), ("unscaled", "u")):
        parts += [sql_gram(f"a_{name}", f"(SELECT * FROM {src} WHERE NOT is_test)", LINEAR, "price"),
                  sql_gram(f"b_{name}", f"(SELECT * FROM {src} WHERE is_test)", LINEAR, "price"),
                  f"p_{name} AS (SELECT *, unnest([0.0, 10000.0])::DOUBLE AS alpha FROM a_{name})"]
        parts += sql_solve(f"s_{name}", f"p_{name}", 5, alpha="alpha")
        parts += _sql_lasso(f"l_{name}", f"a_{name}", 4, lassos)
        for models, source in (("CASE alpha WHEN 0 THEN 'ols' ELSE 'ridge' END", f"s_{name}"), ("'lasso'", f"l_{name}")):
            body.append(f"SELECT '{name}' AS features, {models} AS model, alpha, round(sqrt({sql_mse(5, f'b_{name}.', f'{source}.')}), 6) AS rmse FROM {source} CROSS JOIN b_{name}")
    return with_sql(*parts, " UNION ALL ".join(body))


@query("scaling_comparison", _sql_scaling())
def scaling_comparison(t):
    total, *parts = _split_moments(net_price(t), LINEAR, "price", KEYS)
    mean, std, y_mean, y_std = total.scales()
    # From the rough units back to the given ones, the price column in thousands.
    thousand = [1000.0 if c == "l_extendedprice" else 1.0 for c in LINEAR]
    plain = [-ROUGH[c][0] / ROUGH[c][1] for c in LINEAR], [u / ROUGH[c][1] for c, u in zip(LINEAR, thousand)]
    out = []
    for name, (center, scale) in (("scaled", (mean, std)), ("unscaled", plain)):
        train, test = (m.rescaled(center, scale, y_mean, y_std).gram() for m in parts)
        for model, alpha in SCALED_MODELS:
            coef = monomials.fit(train, model, alpha)
            out.append({"features": name, "model": model, "alpha": alpha, "rmse": regress.mse_from_gram(test, coef) ** 0.5})
    table = regress.result_rows(t.spark, out, "features string, model string, alpha double, rmse double")
    return table.select("features", "model", "alpha", F.round("rmse", 6).alias("rmse"))


POLY_COLS, DEGREES = ["l_extendedprice", "l_discount"], range(1, 6)


def _sql_degrees():
    terms = monomials.exponents(len(POLY_COLS), max(DEGREES))[1:]
    value = lambda e: "*".join(c for c, v in zip(POLY_COLS, e) for _ in range(v))
    cols = [f"m{i}" for i in range(len(terms))]
    last = len(cols) + 1
    parts = [
        NET_PRICE,
        sql_scaled("z", "net_price", [*POLY_COLS, "price"], [f"CAST({sql_fold(FOLDS, 8, *KEYS)} AS INTEGER) AS fold"]),
        "zp AS MATERIALIZED (SELECT fold, price, " + ", ".join(f"{value(e)} AS {c}" for e, c in zip(terms, cols)) + " FROM z)",
        sql_gram("gf", "zp", cols, "price", ["fold"]).replace("gf AS", "gf AS MATERIALIZED", 1),
    ]
    spots = [(i, j) for i in range(last + 1) for j in range(i, last + 1)]
    parts.append("gt AS MATERIALIZED (SELECT " + ", ".join(f"sum(g_{i}_{j}) AS g_{i}_{j}" for i, j in spots) + " FROM gf)")
    body = []
    for d in DEGREES:
        size = len(monomials.exponents(len(POLY_COLS), d))
        at = lambda i: last if i == size else i
        cells = [(i, j, f"g_{at(i)}_{at(j)}") for i in range(size + 1) for j in range(i, size + 1)]
        parts.append(f"te{d} AS MATERIALIZED (SELECT fold, " + ", ".join(f"{c} AS g_{i}_{j}" for i, j, c in cells) + " FROM gf)")
        parts.append(f"tr{d} AS MATERIALIZED (SELECT fold, " + ", ".join(f"gt.{c} - gf.{c} AS g_{i}_{j}" for i, j, c in cells) + " FROM gf CROSS JOIN gt)")
        parts += sql_solve(f"s{d}", f"tr{d}", size)
        body.append(f"SELECT {d} AS degree, s{d}.fold, {size - 1} AS n_terms, round({sql_mse(size, f's{d}.', f's{d}.')}, 5) AS train_mse, "
                    f"round({sql_mse(size, f'te{d}.', f's{d}.')}, 5) AS test_mse, true AS solved FROM s{d} JOIN te{d} USING (fold)")
    return with_sql(*parts, " UNION ALL ".join(body))


TWEET_LABELS = {"retweets": ["epoch", "followers", "user_id"], "epoch": ["retweets", "followers", "user_id"]}
TWEET_COLS = ["epoch", "followers", "user_id", "retweets"]


def _sql_tweet_regression():
    flag = f"flagged AS (SELECT *, {sql_unit(42, 'event_id')} < 0.2 AS is_test FROM tweets)"
    mom = "mom AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in TWEET_COLS) + " FROM flagged WHERE NOT is_test)"
    z = "z AS (SELECT is_test, " + ", ".join(f"({c} - m_{c})/s_{c} AS {c}" for c in TWEET_COLS) + " FROM flagged CROSS JOIN mom)"
    parts, body = [TWEETS, flag, mom, z], []
    for label, cols in TWEET_LABELS.items():
        parts += [sql_gram(f"a_{label}", "(SELECT * FROM z WHERE NOT is_test)", cols, label),
                  sql_gram(f"b_{label}", "(SELECT * FROM z WHERE is_test)", cols, label)]
        parts += sql_solve(f"s_{label}", f"a_{label}", 4)
        body.append(f"SELECT '{label}' AS label, round(sqrt({sql_mse(4, f'b_{label}.', f's_{label}.')}), 6) AS rmse FROM s_{label} CROSS JOIN b_{label}")
    return with_sql(*parts, " UNION ALL ".join(body))


@query("tweet_regression", _sql_tweet_regression())
def tweet_regression(t):
    train, test = split.split(tweets(t), "event_id", 0.2, seed=42)
    scaler = vectorize.scaler_stats(train, TWEET_COLS)
    train, test = vectorize.apply_scaler(train, scaler), vectorize.apply_scaler(test, scaler)
    out = []
    for label, cols in TWEET_LABELS.items():
        coef = regress.ridge_from_gram(regress.gram_table(train, cols, label)[()])
        out.append({"label": label, "rmse": regress.mse_from_gram(regress.gram_table(test, cols, label)[()], coef) ** 0.5})
    table = regress.result_rows(t.spark, out, "label string, rmse double")
    return table.select("label", F.round("rmse", 6).alias("rmse"))


# -------------------------------------------------------------- search tables
MODELS = [("ols", 0.0)] + [("ridge", a) for a in ALPHAS]
FOLDS = 5


@query("poly_degree_search", _sql_degrees())
def poly_degree_search(t):
    """Degrees 1 to 5 of two columns on five folds from one pass; ``solved``: the gradient on the training rows is 0."""
    rows = split.with_fold(net_price(t), KEYS, FOLDS, seed=8)
    table = monomials.moment_table(rows, POLY_COLS, "price", max(DEGREES), ["fold"], ROUGH)
    folds = {k[0]: m for k, m in table.items()}
    out = monomials.degree_search(folds, DEGREES)
    spread = sum(list(folds.values())[1:], start=list(folds.values())[0]).scales()[3] ** 2
    for r in out:
        r.update(train_mse=r["train_mse"] / spread, test_mse=r["test_mse"] / spread, solved=r["gradient"] < 1e-8)
    found = regress.result_rows(t.spark, out, "degree int, fold int, n_terms int, train_mse double, test_mse double, solved boolean")
    return _r6(found, ["degree", "fold", "n_terms", "solved"], ["train_mse", "test_mse"], 5)


def fold_scores(t, models=MODELS):
    rows = split.with_fold(scaled_prices(t), KEYS, FOLDS, seed=8)
    found = regress.linear_fold_scores(rows, LINEAR, "price", "fold", models)
    return regress.result_rows(t.spark, found, "model string, alpha double, fold int, train_mse double, test_mse double")


SQL_SCORES = [
    NET_PRICE,
    sql_scaled("z", "net_price", [*LINEAR, "price"], [*KEYS, f"CAST({sql_fold(FOLDS, 8, *KEYS)} AS INTEGER) AS fold"]),
    sql_gram("gf", "z", LINEAR, "price", ["fold"]), sql_gram("gt", "z", LINEAR, "price"),
    "models AS (SELECT * FROM (VALUES " + ", ".join(f"('{m}', {a}::DOUBLE)" for m, a in MODELS) + ") v(model, alpha))",
    "gtrain AS (SELECT model, alpha, fold, " + ", ".join(
        f"gt.g_{i}_{j} - gf.g_{i}_{j} AS g_{i}_{j}" for i in range(6) for j in range(i, 6)) + " FROM gf CROSS JOIN gt CROSS JOIN models)",
    *sql_solve("sol", "gtrain", 5, alpha="alpha"),
    f"scores AS (SELECT model, alpha, sol.fold, {sql_mse(5, 'sol.', 'sol.')} AS train_mse, {sql_mse(5, 'gf.', 'sol.')} AS test_mse FROM sol JOIN gf ON sol.fold = gf.fold)",
    """results AS (SELECT model, alpha, count(*) AS n_folds, round(avg(-test_mse), 9) AS mean_test, stddev_pop(-test_mse) AS std_test,
       avg(-train_mse) AS mean_train FROM scores GROUP BY ALL)""",
]


def search_results(t):
    scores = fold_scores(t).withColumns({"test_score": -F.col("test_mse"), "train_score": -F.col("train_mse")})
    return tuning.cv_results(scores, ["model", "alpha"])


@query("fold_scores", with_sql(*SQL_SCORES, "SELECT model, alpha, fold, round(train_mse, 6) AS train_mse, round(test_mse, 6) AS test_mse FROM scores"))
def fold_scores_query(t):
    return _r6(fold_scores(t), ["model", "alpha", "fold"], ["train_mse", "test_mse"])


@query("fold_mean", with_sql(*SQL_SCORES, "SELECT alpha, round(avg(test_mse), 6) AS mean_score FROM scores GROUP BY 1"))
def fold_mean(t):
    return _r6(stats.mean_by(fold_scores(t), ["alpha"], "test_mse"), ["alpha"], ["mean_score"])


@query("cv_results", with_sql(*SQL_SCORES, """
SELECT model, alpha, n_folds, round(mean_test, 6) AS mean_test, round(std_test, 6) AS std_test, round(mean_train, 6) AS mean_train,
       rank() OVER (ORDER BY mean_test DESC) AS rank FROM results"""))
def cv_results(t):
    return _r6(search_results(t), ["model", "alpha", "n_folds", "rank"], ["mean_test", "std_test", "mean_train"])


@query("best_param", with_sql(*SQL_SCORES, "SELECT alpha, round(mean_test, 6) AS mean_test FROM results WHERE model = 'ridge' ORDER BY results.mean_test DESC, alpha LIMIT 1"))
def best_param(t):
    found = search_results(t).where("model = 'ridge'")
    return _r6(stats.best_param(found, "alpha", "mean_test", largest=True), ["alpha"], ["mean_test"])


@query("search_report", with_sql(*SQL_SCORES, """
SELECT count(*) AS n_candidates, round(max(mean_test), 6) AS best_mean,
       round(max_by(std_test, mean_test), 6) AS best_std, max_by(model||'@'||CAST(CAST(alpha AS BIGINT) AS VARCHAR), mean_test) AS best_candidate FROM results"""))
def search_report(t):
    named = search_results(t).withColumn("name", F.concat_ws("@", "model", F.col("alpha").cast("bigint").cast("string")))
    out = tuning.search_report(named, "name")
    return _r6(out, ["n_candidates", "best_candidate"], ["best_mean", "best_std"])


EFFECTS = ["alpha", "mean_test", "mean_train", "gap"]


@query("param_effects", with_sql(*SQL_SCORES, "eff AS (SELECT *, abs(mean_train - mean_test) AS gap FROM results)", " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 4) AS corr FROM eff"
    for i, a in enumerate(EFFECTS) for b in EFFECTS[i:])))
def param_effects(t):
    return _r6(tuning.param_effects(search_results(t), ["alpha"]), ["col_a", "col_b"], ["corr"], 4)


@query("marginal_scores", with_sql(*SQL_SCORES, "SELECT model, round(avg(mean_test), 6) AS mean_score FROM results GROUP BY 1"))
def marginal_scores(t):
    return _r6(stats.mean_by(search_results(t), ["model"], "mean_test"), ["model"], ["mean_score"])


@query("mixed_model_grid")
def mixed_model_grid(t):
    models = [("ols", 0.0)] + [(m, a) for m in ("ridge", "lasso") for a in (0.01, 0.1, 1.0, 10.0)]
    return fold_scores(t, models).groupBy("model", "alpha").agg(F.avg("test_mse").alias("mean_mse"))
