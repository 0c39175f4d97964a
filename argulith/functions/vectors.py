"""Column functions on dense vectors (``array<float>`` or ``array<double>``), in double precision."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F


def as_double(vector: Column) -> Column:
    return vector.cast("array<double>")


def dot_score(a: Column, b: Column) -> Column:
    """Inner product; the cosine when both vectors have unit length."""
    products = F.zip_with(as_double(a), as_double(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda total, p: total + p)


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(as_double(vector), F.lit(0.0), lambda total, x: total + x * x))


def _with_each(vector: Column, value: Column, combine: Callable[[Column, Column], Column]) -> Column:
    """Combine every element with one value of the row.

    The value is repeated into an array: inside the lambda it would be computed for every element.
    """
    return F.zip_with(vector, F.array_repeat(value, F.size(vector)), combine)


def l2_normalize(vector: Column) -> Column:
    """Unit length; the zero vector stays as it is."""
    length = norm(vector)
    divisor = F.when(length > 0, length).otherwise(1.0)
    return _with_each(as_double(vector), divisor, lambda x, n: x / n)


def softmax(logits: Column) -> Column:
    powers = _with_each(logits, F.array_max(logits), lambda x, top: F.exp(x - top))
    total = F.aggregate(powers, F.lit(0.0), lambda t, p: t + p)
    return _with_each(powers, total, lambda p, t: p / t)


def argmax(values: Column) -> Column:
    """Zero-based position of the first largest value."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def matrix_of(vectors: pa.Array | pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """Vectors without nulls among them as the rows of a matrix; all have ``width`` components, or it is an error.

    A vector is a list, or a struct ``(size, indices, values)`` that names its components other than 0.
    """
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    if not len(vectors):
        return np.empty((0, width or 0))
    sparse = pa.types.is_struct(vectors.type)
    lengths = pc.unique(pc.struct_field(vectors, "size") if sparse else pc.list_value_length(vectors)).to_pylist()
    if lengths != [lengths[0] if width is None else width]:
        raise ValueError(f"vectors of {lengths} dimensions" + ("" if width is None else f" against {width}"))
    if sparse:
        rows = np.zeros((len(vectors), lengths[0]))
        indices, values = pc.struct_field(vectors, "indices"), pc.struct_field(vectors, "values")
        row = np.repeat(np.arange(len(vectors)), pc.list_value_length(indices).to_numpy(zero_copy_only=False))
        rows[row, indices.flatten().to_numpy(zero_copy_only=False)] = values.flatten().to_numpy(zero_copy_only=False)
        return rows
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False).reshape(len(vectors), -1)
