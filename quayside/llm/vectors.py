"""Rows of vector tables that can take part in a search."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) of rows with an id and a vector of finite components, as doubles."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    return rows.where(F.col("id").isNotNull() & (F.size("vector") > 0)).where(finite(F.col("vector")))


def finite(vector: Column) -> Column:
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))


def matrix(column: pa.Array) -> np.ndarray:
    """Lists of one length as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)
