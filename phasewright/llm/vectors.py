"""Vectors of whole numbers: which rows take part, and their components as integers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """False for a null vector and for one with a null, NaN or infinite component; an empty vector is usable."""
    value = lambda x: x.cast("double")
    infinite = F.lit(float("inf"))
    fine = F.forall(vector, lambda x: F.coalesce(~F.isnan(value(x)) & (F.abs(value(x)) < infinite), F.lit(False)))
    return F.coalesce(vector.isNotNull() & fine, F.lit(False))


def scaled(vector: Column, scale: int) -> Column:
    """floor(``scale`` * x) of every component, x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def reach(rows: DataFrame, column: str) -> tuple[int, int, int]:
    """Number of rows, the greatest length and the greatest absolute component of an array column, by one aggregate."""
    size = F.greatest(F.coalesce(F.array_max(column), F.lit(0)), -F.coalesce(F.array_min(column), F.lit(0)))
    n, longest, largest = rows.agg(F.count(F.lit(1)), F.max(F.size(column)), F.max(size)).first()
    return n, longest or 0, largest or 0


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column as an int64 matrix of ``width`` columns; shorter rows end in zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    lengths = np.asarray(column.value_lengths().fill_null(0), dtype=np.int64)
    values = np.asarray(column.flatten(), dtype=np.int64)
    if len(lengths) and (lengths == width).all():
        return values.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width), np.int64)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    out[owner, np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    return out
