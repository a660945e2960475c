"""Vectors as integers, for the operators on embeddings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Scaled components stay within this bound, so that integer scores and distances fit a long.
BOUND = float(1 << 26)


def usable(vector: Column) -> Column:
    """Neither null nor with null, NaN or infinite components."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def scaled(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component in doubles, within BOUND."""
    return F.transform(vector, lambda x: F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(BOUND)), F.lit(-BOUND))).cast("int"))


def integer_vectors(vectors: DataFrame, scale: int, id_col: str, vector_col: str, *rest: str) -> DataFrame:
    """(vid, v, rest ..) of the usable rows; other columns are left out, so their names can't clash."""
    v = F.col(f"`{vector_col}`")
    kept = vectors.filter(usable(v))
    return kept.select(F.col(f"`{id_col}`").cast("long").alias("vid"), scaled(v, scale).alias("v"), *(F.col(f"`{c}`").alias(f"rest_{i}") for i, c in enumerate(rest)))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column as a matrix of `width` columns; shorter rows end in zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    size = np.diff(offsets)
    if len(size) and (size == width).all():
        return values[offsets[0] : offsets[-1]].reshape(-1, width)
    out = np.zeros((len(size), width), dtype=np.int32)
    row = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
    out[row, at] = values[offsets[0] : offsets[-1]]
    return out
