"""Stacking tables whose columns differ."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame


def union_by_name(*frames: DataFrame) -> DataFrame:
    """All rows of all frames; a column a frame lacks is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
