"""Per-document Python over Arrow batches, in slices of bounded size."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: A slice has at most so many rows, and ends at the row that brings it to so many bytes.
SLICE_ROWS, SLICE_BYTES = 500, 1_000_000

_held: dict[str, object] = {}


def held(name: str, make: Callable[[], object]) -> object:
    """An object that a Python worker keeps from task to task; it keeps one, the last asked for."""
    if name not in _held:
        _held.clear()
        _held[name] = make()
    return _held[name]


def release() -> None:
    """Drop what ``held`` keeps."""
    _held.clear()


def _slices(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, n in enumerate(lengths):
        size += int(n)
        if size >= SLICE_BYTES or i - start + 1 >= SLICE_ROWS:
            yield start, i + 1
            start, size = i + 1, 0
    if start < len(lengths):
        yield start, len(lengths)


def text_slices(batch: pa.RecordBatch, at: int) -> Iterator[tuple[int, int, list[bytes]]]:
    """(first row, end, UTF-8 texts) of the string column ``at``; null is empty."""
    column = batch.column(at).cast(pa.large_binary())
    lengths = np.diff(np.frombuffer(column.buffers()[1], np.int64, len(column) + 1 + column.offset)[column.offset:]) if len(column) else []
    for a, b in _slices(lengths):
        yield a, b, [t or b"" for t in column.slice(a, b - a).to_pylist()]


def add_columns(df: DataFrame, text_col: str, schema: str, make: Callable[[], Callable[[list[bytes]], list]], keep: list[str]) -> DataFrame:
    """``keep`` columns and those of ``schema``, computed from the texts of each slice.

    ``make`` runs once per task and returns a function from texts to one sequence per
    column of ``schema``. No rows are shuffled.
    """
    added = StructType.fromDDL(schema)
    source = df.select(*keep, F.col(text_col).cast("string").alias("_text_"))
    out = StructType([*source.select(*keep).schema.fields, *added.fields])
    names, n = [f.name for f in out.fields], len(keep)

    def run(batches):
        release()
        compute = make()
        for batch in batches:
            for a, b, texts in text_slices(batch, n):
                new = [pa.array(c) for c in compute(texts)]
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(a, b - a) for i in range(n)), *new], names=names)

    return source.mapInArrow(run, out)


def keep_rows(df: DataFrame, text_col: str, make: Callable[[], Callable[[list[bytes]], np.ndarray]]) -> DataFrame:
    """The rows of ``df`` whose text gives true, with all their columns; no rows are shuffled."""
    at = df.columns.index(text_col)

    def run(batches):
        release()
        compute = make()
        for batch in batches:
            for a, b, texts in text_slices(batch, at):
                yield batch.slice(a, b - a).filter(pa.array(np.asarray(compute(texts), bool)))

    return df.mapInArrow(run, df.schema)
