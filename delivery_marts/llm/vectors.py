"""Embeddings as rows of numbers: which take part, and their matrix in Python."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def takes_part() -> Column:
    """True for rows with a vec_id whose embedding is not NULL, empty or zero and whose
    components are all finite."""
    vector = F.col("embedding")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    usable = finite & F.exists(vector, lambda x: x != 0)
    return F.col("vec_id").isNotNull() & F.coalesce(usable, F.lit(False))


def usable_rows(df: DataFrame) -> DataFrame:
    """vec_id, embedding and dim of the rows that take part."""
    return df.where(takes_part()).select(
        F.col("vec_id").cast("bigint").alias("vec_id"), "embedding", F.size("embedding").alias("dim")
    )


def matrix(column: pd.Series | np.ndarray) -> np.ndarray:
    """Vectors of one dimension as rows of doubles."""
    return np.stack(list(column)).astype(np.float64) if len(column) else np.zeros((0, 0))
