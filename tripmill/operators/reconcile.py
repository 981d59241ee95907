"""Comparing row counts of two copies of a dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.functions.numbers import match_status

DAY_KEYS = ("year", "month", "day")


def daily_counts(df: DataFrame, name: str, keys: Sequence[str] = DAY_KEYS) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def reconcile(left: DataFrame, right: DataFrame, keys: Sequence[str] = DAY_KEYS) -> DataFrame:
    """Counts per key on both sides with a status; a key on one side only is a mismatch."""
    both = daily_counts(left, "left_count", keys).join(
        daily_counts(right, "right_count", keys), list(keys), "full_outer"
    )
    status = match_status(F.col("left_count"), F.col("right_count"))
    return both.select(*keys, "left_count", "right_count", status.alias("status")).orderBy(*keys)
