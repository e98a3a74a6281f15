"""Which rows may have one of many keys, told by a bit map of bounded size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Two to this number bits tell which keys are in use; the table of them has 1/64 as many rows, 4 MB at most.
FILTER_BITS = 24


def maybe_among(df: DataFrame, keys: DataFrame, of: str, bits: int = FILTER_BITS) -> DataFrame:
    """``df`` with ``maybe``: false only where the 64-bit hash ``of`` is none of ``keys`` (its only column).

    A bit map of bounded size is broadcast, however many keys there are; with very many it only spares less.
    """
    place = lambda c: (F.shiftrightunsigned(c, 64 - bits + 6).alias("_slot"), F.expr(
        f"shiftleft(1L, cast(shiftrightunsigned(`{c}`, {64 - bits}) & 63 as int))").alias("_bit"))
    bits_in_use = keys.select(*place(keys.columns[0])).groupBy("_slot").agg(F.bit_or("_bit").alias("_bits"))
    found = df.select("*", *place(of)).join(F.broadcast(bits_in_use), "_slot", "left")
    maybe = F.coalesce(F.col("_bits").bitwiseAND(F.col("_bit")) != 0, F.lit(False))
    return found.withColumn("maybe", maybe).drop("_slot", "_bit", "_bits")
