"""Least squares on polynomials from one table of moments.

The product of two monomials is a monomial, so the sums of all monomials up to degree 2d,
with those of the label times the monomials up to degree d, hold the matrix of sums of
products of every polynomial model up to degree d. ``moment_table`` takes them in one pass,
per fold or split if wanted. Degrees, column subsets, training folds (total − fold),
penalties and exact rescalings of the columns are then algebra on a few numbers per key.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import combinations_with_replacement
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from graniteflow.operators.regress import lasso_from_gram, mse_from_gram, ridge_from_gram

#: Rows multiplied at once; a task holds this many times the monomials up to degree d.
CHUNK = 8192


@lru_cache(maxsize=None)
def exponents(p: int, degree: int) -> tuple[tuple[int, ...], ...]:
    """Exponents of all monomials of ``p`` columns up to ``degree``, by degree; the constant first."""
    out = []
    for d in range(degree + 1):
        for pick in combinations_with_replacement(range(p), d):
            out.append(tuple(pick.count(i) for i in range(p)))
    return tuple(out)


@lru_cache(maxsize=None)
def _places(p: int, degree: int) -> dict[tuple[int, ...], int]:
    return {e: i for i, e in enumerate(exponents(p, degree))}


def _plus(a: tuple[int, ...], b: tuple[int, ...]) -> tuple[int, ...]:
    return tuple(x + y for x, y in zip(a, b))


def monomial_values(x: np.ndarray, degree: int) -> np.ndarray:
    """Rows × monomials; each is a monomial of one degree less times a column."""
    n, p = x.shape
    terms, place = exponents(p, degree), _places(p, degree)
    out = np.ones((n, len(terms)))
    for i, e in enumerate(terms[1:], 1):
        j = next(k for k in range(p) if e[k])
        out[:, i] = out[:, place[tuple(v - (k == j) for k, v in enumerate(e))]] * x[:, j]
    return out


class Moments:
    """Sums over rows: monomials up to degree 2d (``x``), label times monomials up to d (``y``), squared label (``yy``)."""

    def __init__(self, p: int, degree: int, x: np.ndarray, y: np.ndarray, yy: float):
        self.p, self.degree, self.x, self.y, self.yy = p, degree, x, y, yy

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.p, self.degree, self.x + other.x, self.y + other.y, self.yy + other.yy)

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.p, self.degree, self.x - other.x, self.y - other.y, self.yy - other.yy)

    def gram(self, degree: int | None = None, use: list[int] | None = None) -> np.ndarray:
        """Sums of products of [1, monomials…, label] up to ``degree`` in the columns ``use``."""
        degree = self.degree if degree is None else degree
        if degree > self.degree:
            raise ValueError(f"moments are of degree {self.degree}")
        free = set(range(self.p) if use is None else use)
        terms = [e for e in exponents(self.p, degree) if all(i in free for i, v in enumerate(e) if v)]
        place = _places(self.p, 2 * self.degree)
        out = np.empty((len(terms) + 1, len(terms) + 1))
        out[:-1, :-1] = [[self.x[place[_plus(a, b)]] for b in terms] for a in terms]
        out[-1, :-1] = out[:-1, -1] = [self.y[place[e]] for e in terms]
        out[-1, -1] = self.yy
        return out

    def scales(self) -> tuple[np.ndarray, np.ndarray, float, float]:
        """Means and population deviations of the columns and of the label."""
        n, first, place = self.x[0], self.x[1 : self.p + 1], _places(self.p, 2 * self.degree)
        squares = np.array([self.x[place[tuple(2 * (k == i) for k in range(self.p))]] for i in range(self.p)])
        mean, label = first / n, self.y[0] / n
        return mean, np.sqrt(np.maximum(squares / n - mean**2, 0)), label, float(np.sqrt(max(self.yy / n - label**2, 0)))

    def rescaled(self, center, scale, y_center: float = 0.0, y_scale: float = 1.0) -> Moments:
        """The moments of (column − center) / scale and (label − y_center) / y_scale, by the binomial theorem."""
        def table(degree: int) -> np.ndarray:
            terms, place = exponents(self.p, degree), _places(self.p, degree)
            out = np.zeros((len(terms), len(terms)))
            for i, a in enumerate(terms):
                parts = [((), 1.0)]
                for k, power in enumerate(a):
                    parts = [
                        ((*b, j), c * comb(power, j) * (-center[k]) ** (power - j) / scale[k] ** power)
                        for b, c in parts for j in range(power + 1)
                    ]
                for b, c in parts:
                    out[i, place[b]] += c
            return out

        low = table(self.degree)
        y = low @ (self.y - y_center * self.x[: len(low)]) / y_scale
        yy = (self.yy - 2 * y_center * self.y[0] + y_center**2 * self.x[0]) / y_scale**2
        return Moments(self.p, self.degree, table(2 * self.degree) @ self.x, y, yy)


def moment_table(
    df: DataFrame, cols: list[str], y: str, degree: int = 1, keys: list[str] | None = None,
    rough: dict[str, tuple[float, float]] | None = None,
) -> dict[tuple, Moments]:
    """Key → ``Moments`` in one pass and one shuffle of one row per task and key.

    ``rough`` maps a column to (center, scale) that it is summed in, ``(x − center) / scale``,
    to keep the sums well conditioned; ``rescaled`` leads to any other unit. Rows with a
    null column or label are left out; keys should be few.
    """
    keys, p = list(keys or []), len(cols)
    low, high = exponents(p, degree), exponents(p, 2 * degree)
    place = _places(p, degree)

    def halves(e: tuple[int, ...]) -> tuple[int, int]:
        left, a = degree, []
        for v in e:
            a.append(min(v, left))
            left -= a[-1]
        return place[tuple(a)], place[tuple(v - w for v, w in zip(e, a))]

    rows_at, cols_at = (np.array(v) for v in zip(*map(halves, high)))
    names = [*cols, y]
    unit = {**{c: (0.0, 1.0) for c in names}, **(rough or {})}
    plain = df.select(*keys, *[((F.col(c).cast("double") - unit[c][0]) / unit[c][1]).alias(f"_v{i}") for i, c in enumerate(names)])
    plain = plain.na.drop(subset=[f"_v{i}" for i in range(p + 1)])
    kinds = {f.name: f.dataType.simpleString() for f in plain.select(*keys).schema.fields}

    def partial(batches):
        sums: dict[tuple, np.ndarray] = {}
        for batch in batches:
            values = np.column_stack([batch.column(len(keys) + i).to_numpy(zero_copy_only=False) for i in range(p + 1)])
            found = list(zip(*[batch.column(i).to_pylist() for i in range(len(keys))])) if keys else [()] * len(values)
            numbers: dict[tuple, int] = {}
            owner = np.array([numbers.setdefault(k, len(numbers)) for k in found], int)
            for key, number in numbers.items():
                mine = values[owner == number]
                for at in range(0, len(mine), CHUNK):
                    part = mine[at : at + CHUNK]
                    m, label = monomial_values(part[:, :p], degree), part[:, p]
                    new = np.concatenate([(m.T @ m)[rows_at, cols_at], m.T @ label, [label @ label]])
                    sums[key] = sums[key] + new if key in sums else new
        if sums:
            columns = [pa.array([k[i] for k in sums], type=batch.schema.field(i).type) for i in range(len(keys))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([s.tolist() for s in sums.values()], pa.list_(pa.float64()))], [*keys, "_m"])

    ddl = "".join(f"`{k}` {kind}, " for k, kind in kinds.items()) + "_m array<double>"
    parts = plain.mapInArrow(partial, ddl).withColumn("_m", array_to_vector("_m"))
    rows = parts.groupBy(*keys).agg(vector_to_array(Summarizer.sum(F.col("_m"))).alias("_m")).collect()
    out = {}
    for row in rows:
        if row["_m"] is not None and len(row["_m"]):
            m = np.array(row["_m"])
            out[tuple(row[k] for k in keys)] = Moments(p, degree, m[: len(high)], m[len(high) : len(high) + len(low)], float(m[-1]))
    return out


def fit(gram: np.ndarray, kind: str = "ols", alpha: float = 0.0) -> np.ndarray:
    """[intercept, coefficients…] of an ols, ridge or lasso model on sums of products."""
    return lasso_from_gram(gram, alpha) if kind == "lasso" else ridge_from_gram(gram, 0.0 if kind == "ols" else alpha)


def degree_search(folds: dict[int, Moments], degrees, models=(("ols", 0.0),), use: list[int] | None = None) -> list[dict]:
    """Train and test MSE of every (degree, kind, alpha) on every fold, with no further pass over the rows.

    ``gradient`` is the largest mean product of a monomial and the residual on the training rows: 0 for ols.
    """
    total = sum(folds.values(), start=next(iter(folds.values())) - next(iter(folds.values()))) if folds else None
    out = []
    for degree in degrees:
        for fold, test in sorted(folds.items()):
            train = (total - test).gram(degree, use)
            held = test.gram(degree, use)
            for kind, alpha in models:
                coef = fit(train, kind, alpha)
                out.append({
                    "degree": int(degree), "model": kind, "alpha": float(alpha), "fold": int(fold), "n_terms": len(coef) - 1,
                    "train_mse": mse_from_gram(train, coef), "test_mse": mse_from_gram(held, coef),
                    "gradient": float(np.abs(train[:-1, -1] - train[:-1, :-1] @ coef).max() / train[0, 0]),
                })
    return out
