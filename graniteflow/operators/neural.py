"""Data-parallel training of small dense networks.

The rows are turned once into blocks, each a matrix of inputs and one of targets. Each
step ships the weights (a size fixed by the layer list) to the tasks, every task runs its
blocks and returns one summed gradient, and the sums are added in two levels.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from graniteflow.functions.hashing import hash_int

#: Rows of a block, and numbers of its wider matrix, at most (unless one row has more).
BLOCK_ROWS, BLOCK_VALUES = 4096, 1 << 18


def initial_weights(layers: list[int], seed: int = 0) -> list[np.ndarray]:
    """Glorot-uniform matrices with the bias as the last row."""
    rng = np.random.default_rng(seed)
    out = []
    for a, b in zip(layers, layers[1:]):
        span = np.sqrt(6.0 / (a + b))
        out.append(np.vstack([rng.uniform(-span, span, (a, b)), np.zeros(b)]))
    return out


def _forward(weights, x):
    states = [x]
    for i, w in enumerate(weights):
        z = states[-1] @ w[:-1] + w[-1]
        states.append(np.maximum(z, 0.0) if i < len(weights) - 1 else z)
    return states


def loss_and_gradient(weights, x, y, loss: str):
    """Summed loss and gradients over a batch. ``loss``: squared or softmax (y = class index)."""
    states = _forward(weights, x)
    out = states[-1]
    if loss == "softmax":
        z = out - out.max(axis=1, keepdims=True)
        prob = np.exp(z)
        prob /= prob.sum(axis=1, keepdims=True)
        rows = np.arange(len(out))
        cls = y[:, 0].astype(int)
        value = -np.log(np.maximum(prob[rows, cls], 1e-300)).sum()
        delta = prob
        delta[rows, cls] -= 1.0
    else:
        delta = out - y
        value = 0.5 * (delta**2).sum()
    grads = [None] * len(weights)
    for i in range(len(weights) - 1, -1, -1):
        grads[i] = np.vstack([states[i].T @ delta, delta.sum(axis=0)])
        if i:
            delta = (delta @ weights[i][:-1].T) * (states[i] > 0)
    return value, grads


class NetworkModel:
    """Fitted weights and the loss after every step."""

    def __init__(self, weights, history):
        self.weights = weights
        self.history = history

    def predict(self, features: Column | str, from_layer: int = 0, to_layer: int | None = None) -> Column:
        """Output array of a span of layers (an inner layer gives a code)."""
        weights = self.weights[from_layer:to_layer]
        last_is_output = to_layer is None or to_layer == len(self.weights)

        @F.pandas_udf(ArrayType(DoubleType()))
        def run(x: pd.Series) -> pd.Series:
            z = np.vstack(x.to_numpy()) if len(x) else np.zeros((0, weights[0].shape[0] - 1))
            for i, w in enumerate(weights):
                z = z @ w[:-1] + w[-1]
                if i < len(weights) - 1 or not last_is_output:
                    z = np.maximum(z, 0.0)
            return pd.Series(list(z))

        return run(features)

    def predict_class(self, features) -> Column:
        out = self.predict(features)
        return (F.array_position(out, F.array_max(out)) - 1).cast("int")


def _matrix(column: pa.Array) -> np.ndarray:
    """The arrays of a batch as float rows; null numbers become NaN, which no step accepts; a null array is an error."""
    widths = np.unique(np.asarray(column.value_lengths().fill_null(-1)))
    if len(widths) != 1 or widths[0] < 0:
        raise ValueError(f"rows need arrays of one length, found {widths.tolist()} (-1: null)")
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def _blocks(rows: DataFrame) -> DataFrame:
    """(_b, n, x, y): inputs and targets of ``n`` rows of a batch number as the bytes of two matrices."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            number, x, y = np.asarray(batch.column(0)), _matrix(batch.column(1)), _matrix(batch.column(2))
            size = max(1, min(BLOCK_ROWS, BLOCK_VALUES // max(1, x.shape[1], y.shape[1])))
            for b in np.unique(number):
                own = np.flatnonzero(number == b)
                for part in (own[i : i + size] for i in range(0, len(own), size)):
                    cells = [[int(b)], [len(part)], [x[part].tobytes()], [y[part].tobytes()]]
                    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds, strict=True)], names=["_b", "n", "x", "y"])

    return rows.select("_b", "x", "y").mapInArrow(run, "_b int, n int, x binary, y binary")


def _gradient_sum(blocks: DataFrame, weights, loss: str, width: int) -> tuple[float, float, np.ndarray]:
    """(rows, loss, flat gradient) over all rows of the blocks."""
    shared = blocks.sparkSession.sparkContext.broadcast(weights)

    def task(batches):
        total = None
        for batch in batches:
            for n, x, y in zip(*batch.columns, strict=True):
                n, x, y = n.as_py(), np.frombuffer(x.as_buffer()), np.frombuffer(y.as_buffer())
                value, grads = loss_and_gradient(shared.value, x.reshape(n, -1), y.reshape(n, -1), loss)
                flat = np.concatenate([[n, value], *[g.ravel() for g in grads]])
                total = flat if total is None else total + flat
        if total is not None and np.isnan(total).any():
            raise ValueError("the gradient is not a number: rows hold nulls or NaN, or the steps diverge")
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.float64()))], names=["g"])

    parts = blocks.select("n", "x", "y").mapInArrow(task, "g array<double>").withColumn("v", array_to_vector("g"))
    middle = parts.groupBy((F.spark_partition_id() % width).alias("_m")).agg(Summarizer.sum(F.col("v")).alias("v"))
    row = middle.agg(vector_to_array(Summarizer.sum(F.col("v"))).alias("g")).first()
    shared.unpersist()
    flat = np.array(row["g"] if row["g"] is not None else [0.0, 0.0])
    return flat[0], flat[1], flat[2:]


def train_network(
    df: DataFrame, x: str, y: str, layers: list[int], key: str | None = None, loss: str = "squared", alpha: float = 1e-4,
    rate: float = 1e-3, steps: int = 200, batches: int = 1, tol: float = 0.0, seed: int = 0,
) -> NetworkModel:
    """Adam on ``steps`` batches. ``x`` and ``y`` are array columns (``y``: one class index for softmax).

    With ``batches`` > 1 rows are dealt by a hash of ``key`` and taken in turn.
    ``alpha`` is the L2 penalty, divided by the rows of the step.
    """
    number = (hash_int(key, seed=seed) % batches).cast("int") if batches > 1 else F.lit(0)
    rows = _blocks(df.select(number.alias("_b"), F.col(x).alias("x"), F.col(y).alias("y"))).persist()
    width = max(1, int(np.sqrt(rows.sparkSession.sparkContext.defaultParallelism)))
    weights = initial_weights(layers, seed)
    shapes = [w.shape for w in weights]
    cuts = np.cumsum([w.size for w in weights])[:-1]
    flat = np.concatenate([w.ravel() for w in weights])
    decay = np.concatenate([np.vstack([np.ones_like(w[:-1]), np.zeros((1, w.shape[1]))]).ravel() for w in weights])
    m, v, history = np.zeros_like(flat), np.zeros_like(flat), []
    try:
        for step in range(1, steps + 1):
            weights = [p.reshape(s) for p, s in zip(np.split(flat, cuts), shapes)]
            part = rows.where(F.col("_b") == (step - 1) % batches) if batches > 1 else rows
            n, value, grad = _gradient_sum(part, weights, loss, width)
            if n == 0:
                continue
            grad = (grad + alpha * decay * flat) / n
            history.append(value / n + 0.5 * alpha * float((decay * flat**2).sum()) / n)
            m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
            flat = flat - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            if tol and len(history) > 10 * batches and history[-10 * batches] - history[-1] < tol:
                break
    finally:
        rows.unpersist()
    return NetworkModel([p.reshape(s) for p, s in zip(np.split(flat, cuts), shapes)], history)


def mlp_regressor(df: DataFrame, x: str, y: str, inputs: int, hidden: list[int], **kw) -> NetworkModel:
    return train_network(df.withColumn("_y", F.array(F.col(y).cast("double"))), x, "_y", [inputs, *hidden, 1], **kw)


def mlp_classifier(df: DataFrame, x: str, y: str, inputs: int, hidden: list[int], classes: int, **kw) -> NetworkModel:
    return train_network(
        df.withColumn("_y", F.array(F.col(y).cast("double"))), x, "_y", [inputs, *hidden, classes], loss="softmax", **kw
    )


def autoencoder(df: DataFrame, x: str, inputs: int, hidden: list[int], k: int, **kw) -> tuple[NetworkModel, int]:
    """Network trained to return its input; also the layer number whose output is the k-wide code."""
    layers = [inputs, *hidden, k, *reversed(hidden), inputs]
    return train_network(df, x, x, layers, **kw), len(hidden) + 1
