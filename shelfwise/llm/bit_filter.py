"""A filter of fixed size before joins whose keys are too many for a broadcast.

A key's hash names one of ``slots`` words and a bit in it. The words of all keys are broadcast, so their
size does not grow with the keys; a row whose bit is not set has none of them. The more keys, the more
other rows pass as well, so a join by the keys themselves has to follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _place(on: list[Column], slots: int) -> tuple[Column, Column]:
    key = F.xxhash64(*on)
    return F.pmod(key, F.lit(slots)), F.pmod(F.shiftrightunsigned(key, 40), F.lit(64)).cast("int")


def maybe_in(
    rows: DataFrame, on: list[Column], keys: DataFrame, keys_on: list[Column], slots: int
) -> tuple[DataFrame, DataFrame]:
    """The rows that may have one of the ``keys``, and those that surely have none.

    Both sides give their columns in one order and of the same types; nulls count as equal.
    """
    slot, bit = _place(keys_on, slots)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), bit)
    words = keys.select(slot.alias("slot"), one.alias("bit")).groupBy("slot")
    words = words.agg(F.bit_or("bit").alias("bits"))
    slot, bit = _place(on, slots)
    # As one column, the given ones meet no name used here.
    whole = rows.select(F.struct(*rows.columns).alias("_in"), slot.alias("_slot"), bit.alias("_bit"))
    whole = whole.join(F.broadcast(words), F.col("_slot") == F.col("slot"), "left")
    may = F.coalesce(F.getbit("bits", F.col("_bit")) == 1, F.lit(False))
    back = [F.col("_in")[c].alias(c) for c in rows.columns]
    return whole.filter(may).select(*back), whole.filter(~may).select(*back)
