"""Distances on array columns, evaluated inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def squared_distance(a: Column | str, b: Column | str) -> Column:
    x = F.col(a) if isinstance(a, str) else a
    y = F.col(b) if isinstance(b, str) else b
    squares = F.zip_with(x, y, lambda p, q: (p - q) * (p - q))
    return F.aggregate(squares, F.lit(0.0), lambda total, s: total + s)


def distance(a: Column | str, b: Column | str) -> Column:
    return F.sqrt(squared_distance(a, b))


def as_array(df: DataFrame, column: str) -> Column:
    """An ML vector or a numeric array as array<double>."""
    if isinstance(df.schema[column].dataType, VectorUDT):
        return vector_to_array(column)
    return F.col(column).cast("array<double>")


def as_vector(df: DataFrame, column: str) -> Column:
    if isinstance(df.schema[column].dataType, VectorUDT):
        return F.col(column)
    return array_to_vector(F.col(column).cast("array<double>"))


def packed(columns: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("double") for c in columns])


def complete(column: str) -> Column:
    """Whether an array has no missing, NaN or infinite component; false for a missing array."""
    return F.expr(f"`{column}` IS NOT NULL AND forall(`{column}`, x -> coalesce(abs(x) < double('infinity'), false))")


def matrix(column: pa.Array) -> np.ndarray:
    """An Arrow column of equally long arrays, one row each."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 0)
