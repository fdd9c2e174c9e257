"""Vector helpers of this subpackage."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """True for vectors without null, infinite or NaN components that are not all zero."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    fine = ~F.exists(vector, odd) & F.exists(vector, lambda x: x != 0)
    return F.coalesce(fine, F.lit(False))


def matrix(column) -> np.ndarray:
    """Rows of equal length as a matrix of doubles."""
    return np.stack([np.asarray(v, np.float64) for v in column])


def unit_rows(m: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaled by the largest component first, against overflow."""
    m = m / np.abs(m).max(axis=1, keepdims=True)
    return m / np.sqrt((m * m).sum(axis=1, keepdims=True))


def bucket_of(count: Column, rows: int, *key: str) -> Column:
    """A hash bucket so that ``count`` rows fall into buckets of about ``rows``."""
    return F.pmod(F.xxhash64(*key), F.ceil(count / rows)).cast("int")


def with_id(df: DataFrame, id_column: str, vector: str) -> DataFrame:
    return df.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).alias("v"))
