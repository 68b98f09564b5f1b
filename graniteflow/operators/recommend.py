"""Recommenders on long rating tables (user, item, rating).

User similarity needs every pair of users with a common item. Pairs are never joined row
by row and never leave a task: users are numbered into blocks, a home block is met by all
guest blocks one after the other, and small dense matrices give the moments of all their
pairs, slice by slice of the items. What a task keeps are the best raters of its own rows,
so any number of neighbours and all folds come from one pass over the ratings.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.ml.recommendation import ALS
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from graniteflow.operators.ordering import row_index, top_per_group
from graniteflow.operators.stats import item_variance
from graniteflow.session import cut_lineage, partitions_for, small_side

#: Users of a block, items of a slice, and test rows of a home block that one task ranks.
USERS_PER_BLOCK, ITEMS_PER_SLICE, TESTS_PER_PART = 256, 4096, 20_000
#: Home blocks of a task, at most.
BLOCKS_PER_HOME = 8
TINY = 1e-9


# ------------------------------------------------------------ blocks of users
def _meetings(rows: DataFrame, run, schema: str, tested: Column) -> DataFrame:
    """``run(home, part, guests)`` for every block of users; each side is a dict of arrays.

    ``rows``: (user, item, rating, fold, train). A block with many rows to test is home to
    several tasks, which deal its items; ``part`` is (number, parts). Guests come in the
    order of the users. A block is sent as one row of arrays, to the tasks of a group of
    homes at a time.
    """
    numbered = cut_lineage(row_index(rows.select("user").distinct(), ["user"], name="no"))
    users = numbered.count()
    blocks = max(1, -(-users // USERS_PER_BLOCK))
    placed = cut_lineage(rows.join(small_side(numbered, users, 48), "user").select(
        F.floor(F.col("no") / USERS_PER_BLOCK).cast("int").alias("block"), "no", "user", "item", "rating", "fold", "train", tested.alias("tested")
    ))
    load = placed.groupBy("block").agg(F.greatest(F.lit(1), F.ceil(F.count_if("tested") / TESTS_PER_PART)).cast("int").alias("parts"))
    cores = rows.sparkSession.sparkContext.defaultParallelism
    group = max(1, min(BLOCKS_PER_HOME, blocks // (2 * cores)))  # home blocks that meet a guest block where it is sent once
    homes = load.select(F.floor(F.col("block") / group).cast("int").alias("home"), "block", "parts", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    homes = cut_lineage(homes)
    cells = ["no", "user", "item", "rating", "fold", "train", "tested"]
    packed = lambda df: df.groupBy("block").agg(F.sort_array(F.collect_list(F.struct(*cells))).alias("r")).select("block", *[F.col(f"r.{c}").alias(c) for c in cells])
    columns = ["home", "part", "guest", "block", "parts", *cells]
    own = homes.join(packed(placed), "block").withColumn("guest", F.lit(-1)).select(*columns)
    met = homes.select("home", "part").distinct().withColumn("guest", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    guests = packed(placed.where("train")).withColumnRenamed("block", "guest")
    others = met.join(guests, "guest").withColumns({"block": F.col("guest"), "parts": F.lit(0)}).select(*columns)
    stream = own.unionByName(others).repartition(partitions_for(rows), "home", "part").sortWithinPartitions("home", "part", "guest", "block")
    shape = to_arrow_schema(StructType.fromDDL(schema))

    def each(batches):
        here, key = [], None
        for now, parts, side in _sides(batches):
            if now[:2] != key:
                for one in here:
                    yield from one.finish()
                here, key = [], now[:2]
            if now[2] < 0:
                here.append(run(side, (now[1], parts), shape))
            else:
                for one in here:
                    one.meet(side)
        for one in here:
            yield from one.finish()

    return stream.mapInArrow(each, schema)


def _sides(batches):
    """((home, part, guest), parts, arrays) of rows sorted by home and part; a row is a block of users."""
    for batch in batches:
        for r in range(batch.num_rows):
            home, part, guest, parts = (batch.column(i)[r].as_py() for i in (0, 1, 2, 4))
            yield (home, part, guest), parts, {c: batch.column(i)[r].values.to_numpy(zero_copy_only=False) for i, c in enumerate(batch.schema.names[5:], 5)}


class _Side:
    """Training rows of one block as matrices over a slice of items; fold means by subtraction."""

    def __init__(self, rows: dict):
        self.no, first = np.unique(rows["no"], return_index=True)
        self.user = rows["user"][first]
        keep = rows["train"].astype(bool)
        self.at = np.searchsorted(self.no, rows["no"])
        self.u, self.item, self.rating, self.fold = self.at[keep], rows["item"][keep], rows["rating"][keep], rows["fold"][keep]

    def means(self, fold: int) -> np.ndarray:
        """Mean rating of each user over all folds but one; NaN without a rating."""
        n, total = (np.bincount(self.u, weights=w, minlength=len(self.no)) for w in (None, self.rating))
        own = self.fold == fold
        n = n - np.bincount(self.u[own], minlength=len(self.no))
        total = total - np.bincount(self.u[own], weights=self.rating[own], minlength=len(self.no))
        return np.divide(total, n, out=np.full(len(n), np.nan), where=n > 0)

    def matrices(self, items: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ratings, rated, fold) over sorted ``items``."""
        spot = np.searchsorted(items, self.item)
        here = (spot < len(items)) & (items[np.minimum(spot, len(items) - 1)] == self.item)
        r, m, f = np.zeros((len(self.no), len(items))), np.zeros((len(self.no), len(items)), dtype=bool), np.zeros((len(self.no), len(items)), dtype=np.int32)
        at = self.u[here], spot[here]
        r[at], m[at], f[at] = self.rating[here], True, self.fold[here]
        return r, m, f


def _slices(items: np.ndarray, step: int):
    for s in range(0, len(items), step):
        yield items[s : s + step]


def _similarities(home: _Side, guest: _Side, folds: list[int], step: int) -> tuple[np.ndarray, np.ndarray]:
    """(common items, similarity) per fold, home and guest user, from the rows outside the fold.

    Means run over the common items; a pair without spread there has similarity 0.
    """
    shape = (6, len(folds), len(home.no), len(guest.no))
    sums = np.zeros(shape)
    for items in _slices(np.intersect1d(home.item, guest.item), step):
        r, m, f = home.matrices(items)
        s, k, g = guest.matrices(items)
        for i, fold in enumerate(folds):
            a, b = (m & (f != fold)).astype(float), (k & (g != fold)).astype(float)
            x, y = r * a, s * b
            for total, left, right in zip(sums[:, i], (a, x, a, x * x, a, x), (b, b, y, b, y * y, y), strict=True):
                total += left @ right.T
    n, sx, sy, sxx, syy, sxy = sums
    vx, vy = n * sxx - sx * sx, n * syy - sy * sy
    live = (vx > TINY) & (vy > TINY)
    length = np.sqrt(np.multiply(vx, vy, out=np.ones(shape[1:]), where=live))
    return n, np.round(np.divide(n * sxy - sx * sy, length, out=np.zeros(shape[1:]), where=live), 9)


def _best(held: list[np.ndarray], new: list[np.ndarray], k: int, floor: float = -np.inf) -> list[np.ndarray]:
    """The ``k`` largest of the first arrays' rows that lie above ``floor``, held ones first among equals.

    Only new values above a row's k-th one are sorted in; short rows are filled up with ``floor``.
    """
    least = held[0][:, k - 1] if held[0].shape[1] >= k else np.full(len(held[0]), floor)
    row, col = np.nonzero(new[0] > np.maximum(least, floor)[:, None])
    if not len(row):
        return held
    some, first, counts = np.unique(row, return_index=True, return_counts=True)
    at, place = np.repeat(np.arange(len(some)), counts), np.arange(len(row)) - np.repeat(first, counts)
    fill, both = [floor] + [0] * (len(held) - 1), []
    for a, b, pad in zip(held, new, fill, strict=True):
        found = np.full((len(some), counts.max()), pad, dtype=a.dtype)
        found[at, place] = b[row, col]
        both.append(np.concatenate([a[some], found], axis=1))
    order = np.argsort(-both[0], axis=1, kind="stable")[:, :k]
    out = []
    for a, b, pad in zip(held, both, fill, strict=True):
        wide = np.concatenate([a, np.full((len(a), order.shape[1] - a.shape[1]), pad, dtype=a.dtype)], axis=1)
        wide[some] = np.take_along_axis(b, order, axis=1)
        out.append(wide)
    return out


class _NearestUsers:
    """The most similar users of each home user."""

    def __init__(self, home: dict, shape: pa.Schema, top: int, step: int):
        self.home, self.shape, self.top, self.step = _Side(home), shape, top, step
        n = len(self.home.no)
        self.held = [np.full((n, 0), -np.inf), np.zeros((n, 0)), np.zeros((n, 0), dtype=self.home.user.dtype)]

    def meet(self, rows: dict) -> None:
        guest = _Side(rows)
        n, sim = (x[0] for x in _similarities(self.home, guest, [-2], self.step))
        sim = np.where((n > 0) & (self.home.no[:, None] != guest.no[None, :]), sim, -np.inf)
        self.held = _best(self.held, [sim, n, np.broadcast_to(guest.user, sim.shape)], self.top)

    def finish(self):
        sim, n, peer = self.held
        u, rank = np.nonzero(sim > -np.inf)
        columns = [self.home.user[u], peer[u, rank], n[u, rank].astype(np.int64), sim[u, rank], (rank + 1).astype(np.int32)]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.shape, strict=True)], schema=self.shape)


def pearson_similarity(ratings: DataFrame, top: int) -> DataFrame:
    """The ``top`` most similar users of every user: (user, peer, n, sim, rank), ties to the smaller peer."""
    rows = ratings.select("user", "item", "rating", F.lit(-1).alias("fold"), F.lit(True).alias("train"))
    kind = dict(ratings.dtypes)["user"]
    schema, step = f"user {kind}, peer {kind}, n bigint, sim double, rank int", ITEMS_PER_SLICE
    return _meetings(rows, lambda home, part, shape: _NearestUsers(home, shape, top, step), schema, F.lit(False))


class _Raters:
    """Running best raters of the test rows of a home block, and the predictions for all k."""

    def __init__(self, home: dict, part: tuple[int, int], shape: pa.Schema, ks: list[int], step: int):
        self.home, self.shape, self.ks, self.k, self.step = _Side(home), shape, ks, max(ks), step
        mine = home["tested"].astype(bool)
        if part[1] > 1:
            mine &= _deal(home["item"], part[1]) == part[0]
        self.u = self.home.at[mine]
        self.item, self.rating, self.fold = (home[c][mine] for c in ("item", "rating", "fold"))
        self.folds = sorted({int(f) for f in self.fold})
        self.held = [np.zeros((len(self.u), 0)), np.zeros((len(self.u), 0))]

    def meet(self, rows: dict) -> None:
        if not len(self.u):
            return
        guest = _Side(rows)
        _, sim = _similarities(self.home, guest, self.folds, self.step)
        sim[:, self.home.no[:, None] == guest.no[None, :]] = 0.0
        near, gap = np.zeros((len(self.u), len(guest.no))), np.zeros((len(self.u), len(guest.no)))
        means = {f: guest.means(f) for f in self.folds}
        for items in _slices(np.intersect1d(self.item, guest.item), self.step):
            r, m, g = guest.matrices(items)
            spot = np.minimum(np.searchsorted(items, self.item), len(items) - 1)
            here = items[spot] == self.item
            for i, fold in enumerate(self.folds):
                at = np.flatnonzero(here & (self.fold == fold))
                rated = m[:, spot[at]].T & (g[:, spot[at]].T != fold)
                near[at] = np.where(rated, np.maximum(sim[i][self.u[at]], 0.0), 0.0)
                gap[at] = np.where(rated, r[:, spot[at]].T - means[fold], 0.0)
        self.held = _best(self.held, [near, gap], self.k, 0.0)

    def finish(self):
        if not len(self.u):
            return
        sim, gap = self.held
        n, lifts = (sim > 0).sum(axis=1), np.zeros((len(self.u), len(self.ks)))
        if sim.shape[1]:
            num, den = np.cumsum(sim * gap, axis=1), np.cumsum(sim, axis=1)
            rows = np.flatnonzero(n)
            for j, k in enumerate(self.ks):
                last = np.minimum(k, n[rows]) - 1
                lifts[rows, j] = num[rows, last] / den[rows, last]
        means = {f: self.home.means(f) for f in self.folds}
        mean = np.array([means[int(f)][u] for f, u in zip(self.fold, self.u, strict=True)])
        columns = [self.home.user[self.u], self.item, self.rating, self.fold, mean]
        flat = pa.ListArray.from_arrays(pa.array(np.arange(len(self.u) + 1) * len(self.ks), pa.int32()), pa.array(lifts.ravel()))
        arrays = [pa.array(c, f.type, from_pandas=True) for c, f in zip(columns, self.shape, strict=False)]
        yield pa.RecordBatch.from_arrays([*arrays, flat], schema=self.shape)


def _deal(items: np.ndarray, parts: int) -> np.ndarray:
    """Part of each item, the same wherever it is."""
    return np.array([crc32(str(i).encode()) % parts for i in items.tolist()], dtype=np.int64)


def knn_folds(rows: DataFrame, ks: list[int], low: float = 0.5, high: float = 5.0) -> DataFrame:
    """Prediction ``est`` of every tested row for every k: (user, item, rating, fold, k, est, impossible).

    ``rows``: (user, item, rating, fold, train). A row with a fold of 0 or more is predicted
    from the training rows of all other folds; rows of fold −1 are only trained on, rows
    without ``train`` only tested. est = user mean + Σ sim·deviation / Σ sim over the k
    nearest raters with sim > 0; the user mean without such raters; the global mean for an
    unknown user or item. Means and counts of a fold's training rows are those of all rows
    less the fold's. A user rates an item once at most.
    """
    kinds = dict(rows.dtypes)
    schema = f"user {kinds['user']}, item {kinds['item']}, rating double, fold int, mean double, lifts array<double>"
    rows = cut_lineage(rows.select("user", "item", F.col("rating").cast("double").alias("rating"), F.col("fold").cast("int").alias("fold"), "train"))
    step = ITEMS_PER_SLICE
    found = _meetings(rows, lambda home, part, shape: _Raters(home, part, shape, list(ks), step), schema, F.col("fold") >= 0)
    trained = cut_lineage(rows.where("train").groupBy("item", "fold").agg(F.count(F.lit(1)).alias("n"), F.sum("rating").alias("s")))
    cells = trained.count()
    per_fold = {r["fold"]: (r["n"], r["s"]) for r in trained.groupBy("fold").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()}
    n, s = (sum(v[i] for v in per_fold.values()) for i in (0, 1))
    left = {f: (n - per_fold.get(f, (0, 0.0))[0], s - per_fold.get(f, (0, 0.0))[1]) for f in [r[0] for r in rows.where("fold >= 0").select("fold").distinct().collect()]}
    overall = F.lit(None).cast("double")
    for fold, (many, total) in left.items():
        overall = F.when(F.col("fold") == fold, F.lit(total / many if many else None)).otherwise(overall)
    total = small_side(trained.groupBy("item").agg(F.sum("n").alias("_all")), cells, 48)
    own = small_side(trained.select("item", "fold", F.col("n").alias("_own")), cells, 48)
    known = found.join(total, "item", "left").join(own, ["item", "fold"], "left")
    unknown = F.col("mean").isNull() | (F.coalesce("_all", F.lit(0)) - F.coalesce("_own", F.lit(0)) <= 0)
    each = known.select("user", "item", "rating", "fold", "mean", unknown.alias("impossible"), F.posexplode("lifts").alias("_j", "lift"))
    est = F.when(F.col("impossible"), overall).otherwise(F.col("mean") + F.col("lift"))
    return each.select(
        "user", "item", "rating", "fold", F.element_at(F.array(*[F.lit(k) for k in ks]), F.col("_j") + 1).alias("k"),
        F.greatest(F.lit(low), F.least(F.lit(high), est)).alias("est"), "impossible",
    )


def knn_sweep(train: DataFrame, test: DataFrame, ks: list[int], low: float = 0.5, high: float = 5.0) -> DataFrame:
    """``knn_folds`` of test rows against separate training rows: (user, item, rating, k, est, impossible)."""
    columns = ["user", "item", "rating"]
    rows = train.select(*columns, F.lit(-1).alias("fold"), F.lit(True).alias("train"))
    rows = rows.unionByName(test.select(*columns, F.lit(0).alias("fold"), F.lit(False).alias("train")))
    return knn_folds(rows, ks, low, high).drop("fold")


def knn_predict(train: DataFrame, test: DataFrame, k: int) -> DataFrame:
    return knn_sweep(train, test, [k])


def user_mean_filter(ratings: DataFrame, test_flag: Column, train_only: bool = True) -> DataFrame:
    """Prediction = the user's mean, from training rows only or from all rows."""
    known = ratings.where(~test_flag) if train_only else ratings
    means = known.groupBy("user").agg(F.avg("rating").alias("est"))
    fallback = known.agg(F.avg("rating")).scalar()
    return ratings.where(test_flag).join(means, "user", "left").withColumn("est", F.coalesce("est", fallback))


def subset_items(
    ratings: DataFrame, popular_above: int = 2, variance_count: int = 5, variance_from: float = 2.0,
) -> DataFrame:
    """(item, subset): popular, unpopular and high-variance items, counted on all data."""
    n = F.col("n")
    rules = {
        "popular": n > popular_above, "unpopular": n <= popular_above,
        "high_variance": (n >= variance_count) & (F.round("variance", 9) >= variance_from),
    }
    names = F.array_compact(F.array(*[F.when(rule, F.lit(name)) for name, rule in rules.items()]))
    return item_variance(ratings).select("item", F.explode(names).alias("subset"))


def subset_filter(test: DataFrame, subsets: DataFrame, subset: str) -> DataFrame:
    """Test rows whose item belongs to one subset."""
    return test.join(subsets.where(F.col("subset") == subset).select("item"), "item", "left_semi")


def subset_rmse(preds: DataFrame, subsets: DataFrame, keys: list[str]) -> DataFrame:
    """RMSE per keys and subset from one prediction table (rating, est)."""
    gap = F.col("rating") - F.col("est")
    return preds.join(subsets, "item").groupBy(*keys, "subset").agg(
        F.count(F.lit(1)).alias("n"), F.sqrt(F.avg(gap * gap)).alias("rmse")
    )


def user_counters(ratings: DataFrame, threshold: float, keys: list[str] | None = None) -> DataFrame:
    return ratings.groupBy(*(keys or []), "user").agg(
        F.count(F.lit(1)).alias("n_rated"), F.count_if(F.col("rating") >= threshold).alias("n_liked")
    )


def filter_users(test: DataFrame, t: int, threshold: float) -> DataFrame:
    """Rows of users with at least ``t`` rows and one liked item."""
    good = user_counters(test, threshold).where((F.col("n_rated") >= t) & (F.col("n_liked") > 0))
    return test.join(good.select("user"), "user", "left_semi")


def precision_recall_at_t(preds: DataFrame, max_t: int, threshold: float, keys: list[str] | None = None) -> DataFrame:
    """Mean precision and recall over users for every t up to ``max_t``.

    Only a user's first ``max_t`` rows are shuffled; row t carries the hits among
    the first t, and exists exactly for users with at least t rows.
    """
    keys = list(keys or [])
    counters = user_counters(preds, threshold, keys).where("n_liked > 0")
    top = top_per_group(preds, [*keys, "user"], ["-est", "item"], max_t, "t")
    upto = Window.partitionBy(*keys, "user").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    hits = top.withColumn("hits", F.sum((F.col("rating") >= threshold).cast("bigint")).over(upto))
    return hits.join(counters, [*keys, "user"]).groupBy(*keys, "t").agg(
        F.count(F.lit(1)).alias("n_users"), F.avg(F.col("hits") / F.col("t")).alias("precision"),
        F.avg(F.col("hits") / F.col("n_liked")).alias("recall"),
    )


# ------------------------------------------------------- matrix factorisation
def bias_tables(train: DataFrame, reg_user: float = 15.0, reg_item: float = 10.0, rounds: int = 2):
    """(mean, item biases, user biases) by alternating shrunken means.

    Users start at 0, without a join; the biases of every half round are stored, so none is worked out again.
    """
    mean = train.agg(F.avg("rating")).first()[0]
    by_user = train.where(F.col("user").isNotNull()).withColumn("bu", F.lit(0.0))
    for i in range(rounds):
        rest = F.col("rating") - mean - F.col("bu")
        by_user = train.join(users, "user") if i else by_user
        items = cut_lineage(by_user.groupBy("item").agg((F.sum(rest) / (reg_item + F.count(F.lit(1)))).alias("bi")))
        rest = F.col("rating") - mean - F.col("bi")
        users = cut_lineage(train.join(items, "item").groupBy("user").agg((F.sum(rest) / (reg_user + F.count(F.lit(1)))).alias("bu")))
    return mean, items, users


def _als(rank: int, nonnegative: bool, seed: int, iterations: int) -> ALS:
    return ALS(
        rank=rank, nonnegative=nonnegative, seed=seed, maxIter=iterations, regParam=0.06, userCol="user", itemCol="item",
        ratingCol="rating", coldStartStrategy="nan",
    ).setPredictionCol("est")


def nmf_recommender(train: DataFrame, rank: int, seed: int = 0, iterations: int = 15):
    """Fitted non-negative factor model (user and item factors are tables)."""
    return _als(rank, True, seed, iterations).fit(train)


def nmf_predict(model, train: DataFrame, test: DataFrame, low: float = 0.5, high: float = 5.0) -> DataFrame:
    """Predictions with the global mean for unknown users and items, clipped."""
    mean = train.agg(F.avg("rating")).scalar()
    est = F.when(F.isnan("est") | F.col("est").isNull(), mean).otherwise(F.col("est").cast("double"))
    return model.transform(test).withColumn("est", F.greatest(F.lit(low), F.least(F.lit(high), est)))


def biased_mf(train: DataFrame, test: DataFrame, rank: int, seed: int = 0, iterations: int = 10) -> DataFrame:
    """μ + user bias + item bias + factors fitted on what the biases leave over."""
    mean, items, users = bias_tables(train)
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    with_bias = lambda d: d.join(users, "user", "left").join(items, "item", "left").withColumn(
        "base", F.lit(mean) + zero(F.col("bu")) + zero(F.col("bi"))
    )
    rest = with_bias(train).select("user", "item", (F.col("rating") - F.col("base")).alias("rating"))
    model = _als(rank, False, seed, iterations).fit(rest)
    scored = model.transform(with_bias(test))
    lift = F.when(F.isnan("est") | F.col("est").isNull(), 0.0).otherwise(F.col("est").cast("double"))
    return scored.withColumn("est", F.greatest(F.lit(0.5), F.least(F.lit(5.0), F.col("base") + lift))).drop("bu", "bi", "base")


def top_factor_items(item_factors: DataFrame, items: DataFrame, n: int = 10) -> DataFrame:
    """Highest items of every latent factor with their item attributes, joined by key."""
    long = item_factors.select(F.col("id").alias("item"), F.posexplode("features").alias("factor", "weight"))
    return top_per_group(long, ["factor"], ["-weight", "item"], n).join(items, "item")
