"""Top-k rows of each group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def top_k_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int = 10
) -> DataFrame:
    """The first ``k`` rows of each group.

    ``row_number() <= k`` becomes a partial group limit below the shuffle, so a group that holds a
    third of the rows still moves only ``k`` rows per task.
    """
    window = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) <= k).drop(_RANK)


def top_items(
    df: DataFrame, units: str, k: int = 10, group: Sequence[str] = ("category",)
) -> DataFrame:
    """Best-selling items of each category; equal totals are ordered by item id, then name."""
    order = [F.col(units).desc_nulls_last(), F.col("item_id").asc(), F.col("item_name").asc()]
    return top_k_per_group(df, group, order, k)
