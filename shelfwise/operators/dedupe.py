"""Keep-one and distinct operators."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def keep_one(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """One row per key, the first by ``order`` and then by all other columns ascending.

    NULL keys count as equal. The order is total over the row's values, so the choice does not
    depend on partitioning. ``row_number() = 1`` is planned with a partial group limit ahead of the
    shuffle: each task sends at most one row per key, however hot the key is.
    """
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in keys]
    window = Window.partitionBy(*keys).orderBy(*order, *rest)
    return df.withColumn(_RANK, F.row_number().over(window)).where(F.col(_RANK) == 1).drop(_RANK)


def losers(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """The rows ``keep_one`` leaves out, each different one once with its number in ``n_copies``.

    Ranking all rows of a key would bring a hot key into one task. Equal rows are counted instead,
    and the kept row of each key is taken off its count, so all that meets is whole rows.
    """
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("__n"))
    kept = keep_one(df, keys, order).select(*[F.col(c).alias(f"__{c}") for c in df.columns])
    same = reduce(lambda a, b: a & b, [counted[c].eqNullSafe(kept[f"__{c}"]) for c in df.columns])
    kept = kept.withColumn("__kept", F.lit(1))
    lost = counted.join(kept, same, "left").withColumn("n_copies", F.col("__n") - F.coalesce("__kept", F.lit(0)))
    return lost.where("n_copies > 0").select(*df.columns, "n_copies")


def latest_per_key(df: DataFrame, keys: Sequence[str], ordering: str) -> DataFrame:
    """One row per key, greatest ``ordering`` first; ties go to the greatest other values."""
    rest = [F.col(c).desc_nulls_last() for c in df.columns if c not in (*keys, ordering)]
    return keep_one(df, keys, [F.col(ordering).desc_nulls_last(), *rest])


def distinct_rows(df: DataFrame, *columns: str) -> DataFrame:
    return (df.select(*columns) if columns else df).distinct()
