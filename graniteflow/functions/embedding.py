"""Batch inference columns with a caller's model."""

from __future__ import annotations

from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType


def embed_batch(col, model_factory, input_size: int, batch_size: int = 64) -> Column:
    """Vector of every row from a model loaded once per Python worker.

    ``model_factory()`` returns a function from a (rows × input_size) array to a
    (rows × k) array.
    """
    run = predict_batch_udf(
        model_factory, return_type=ArrayType(DoubleType()), batch_size=batch_size, input_tensor_shapes=[[input_size]]
    )
    return run(col)


def pool_layers(states, last: int = 4) -> Column:
    """Mean over tokens of each of the last layers, last layer first, joined to one vector.

    ``states`` is an array (layer) of arrays (token) of number arrays.
    """
    layers = F.slice(F.reverse(F.col(states) if isinstance(states, str) else states), 1, last)

    def mean(layer):
        width = F.size(layer[0])
        at = F.sequence(F.lit(1), width)
        total = lambda j: F.aggregate(layer, F.lit(0.0), lambda s, token: s + F.element_at(token, j))
        return F.transform(at, lambda j: total(j) / F.size(layer))

    return F.flatten(F.transform(layers, mean))
