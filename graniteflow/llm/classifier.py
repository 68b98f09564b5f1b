"""Quality scores by Bradley-Terry pairwise ranking on text features.

Pairs of a better and a worse labelled document are drawn from a bounded sample; the
weights minimise the logistic loss on their feature differences. The threshold is a
quantile of the sample's scores, chosen by the labels, and is mapped to ``CUT`` of the
0-to-1 score. Features come from the text alone and are computed for whole texts.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from graniteflow.llm.batches import add_columns, keep_rows

#: Labelled documents read for training at most, and preference pairs drawn from them.
SAMPLE_ROWS, PAIRS = 20_000, 60_000
CUT = 0.3
FOLDS = 5
_UPPER, _DIGITS, _SYMBOLS, _STOPS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&<>@^~=_+\\{}[]", b".,;:"


def _features(text: bytes) -> list[float]:
    n = max(1, len(text))
    words = text.split()
    m = max(1, len(words))
    pairs = max(1, len(words) - 1)
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    share = lambda chars: (len(text) - len(text.translate(None, chars))) / n
    parts = [
        share(_SYMBOLS), share(b"!?"), share(b"|"), share(_UPPER), share(_DIGITS), share(_STOPS),
        sum(w.isupper() for w in words) / m,
        sum(a == b for a, b in zip(words, words[1:])) / pairs,
        1 - len(set(zip(words, words[1:]))) / pairs if len(words) > 1 else 0.0,
        1 - len(set(lines)) / max(1, len(lines)),
        sum(len(w) < 2 or len(w) > 25 for w in words) / m,
    ]
    return [*parts, *(math.sqrt(max(0.0, p)) for p in parts), math.log1p(len(words)), math.log1p(n), n / m / 10]


N_FEATURES = len(_features(b""))


def held_out(key: Column) -> Column:
    """True for rows whose crc32 of the id as text is divisible by ``FOLDS``; a null id counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


@dataclass
class Ranker:
    """Scores of standardised features; ``threshold`` is the raw score that maps to ``CUT``."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    threshold: float

    def score(self, features: np.ndarray) -> np.ndarray:
        raw = ((features - self.mean) / self.scale).clip(-20, 20) @ self.weights
        z = raw - self.threshold + math.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-z.clip(-60, 60)))


def fit_pairs(x: np.ndarray, y: np.ndarray, pairs: int = PAIRS, penalty: float = 1e-3, seed: int = 7, steps: int = 50) -> Ranker:
    """Bradley-Terry weights by Newton steps, and the best score quantile as threshold.

    With one class only there is no pair: the weights are 0 and every row scores 0.5.
    """
    width = x.shape[1] if x.ndim == 2 else N_FEATURES
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    if not len(good) or not len(bad):
        return Ranker(np.zeros(width), np.ones(width), np.zeros(width), math.log(CUT / (1 - CUT)))
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = ((x - mean) / scale).clip(-20, 20)
    rng = np.random.default_rng(seed)
    d = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
    w = np.zeros(width)
    for _ in range(steps):
        p = 1 / (1 + np.exp((d @ w).clip(-60, 60)))  # chance that the worse one wins
        gradient = -(d * p[:, None]).mean(0) + penalty * w
        step = np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d / pairs + penalty * np.eye(width), gradient)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    raw = z @ w
    levels = np.unique(np.quantile(raw, np.linspace(0, 1, 2001)))
    order = np.argsort(raw)
    sorted_raw, sorted_y = raw[order], y[order]
    zeros = np.append(0, np.cumsum(sorted_y == 0))
    below = np.searchsorted(sorted_raw, levels)
    right = zeros[below] + (len(good) - (below - zeros[below]))
    best = np.flatnonzero(right == right.max())
    return Ranker(mean, scale, w, float((levels[best[0]] + levels[best[-1]]) / 2))


def _text_features(df: DataFrame, text_col: str, keep: list[str]) -> DataFrame:
    """``keep`` and ``features``."""
    return add_columns(df, text_col, "features array<double>", lambda: lambda texts: [[_features(t) for t in texts]], keep)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", rows: int = SAMPLE_ROWS) -> Ranker:
    """Ranker from the labelled documents outside the held-out fold.

    Labels with a null are not used; of repeated ones the mean counts, and documents with
    the same id are averaged. At most ``rows`` labelled ids are read, in the order of a hash.
    """
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(F.col(id_col)))
    known = known.groupBy(F.col(id_col).alias("_id")).agg((F.avg(label_col) >= 0.5).cast("int").alias("_y"))
    known = known.orderBy(F.xxhash64("_id"), "_id").limit(rows)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(known), "_id")
    found = _text_features(texts, "_text", ["_id", "_y"])
    means = [F.avg(F.element_at("features", i + 1)).alias(f"f{i}") for i in range(N_FEATURES)]
    table = found.groupBy("_id", "_y").agg(*means).orderBy("_id").toPandas()
    return fit_pairs(table[[f"f{i}" for i in range(N_FEATURES)]].to_numpy(float).reshape(-1, N_FEATURES), table["_y"].to_numpy())


def classify(docs: DataFrame, ranker: Ranker, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (default: id and held_out), score and predicted (1 from ``CUT`` on) for every row.

    Null and empty texts have the score of the empty text. Rows are neither moved nor merged.
    """

    def make():
        def compute(texts):
            score = ranker.score(np.array([_features(t) for t in texts]).reshape(len(texts), -1))
            return [score, (score >= CUT).astype(np.int32)]

        return compute

    source = docs if keep is not None else docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), F.col(text_col))
    return add_columns(source, text_col, "score double, predicted int", make, keep if keep is not None else [id_col, "held_out"])


def keep_good(docs: DataFrame, ranker: Ranker, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``classify`` predicts as 1, with all their columns."""
    return keep_rows(docs, text_col, lambda: lambda texts: ranker.score(np.array([_features(t) for t in texts]).reshape(len(texts), -1)) >= CUT)
