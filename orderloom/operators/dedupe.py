"""One row per key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: list[str], order: list[Column], ties: list[str] | None = None
) -> DataFrame:
    """The first row of each key in the given order.

    `row_number() = 1` makes Catalyst put a group limit before the shuffle as well: every map
    task forwards at most one row per key, so a key holding a third of all rows is no hot spot.
    The order should be total within a key. Where the data has no such order, `ties` names the
    columns whose hash decides last, so that every attempt of a task makes the same choice; all
    of them are then read, whatever the query selects.
    """
    last = [F.xxhash64(*[F.col(f"`{c}`") for c in ties])] if ties else []
    window = Window.partitionBy(*keys).orderBy(*order, *last)
    return (
        df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
    )


def preferred_first(column: str, value: str) -> Column:
    """Sort key that puts rows holding `value` before all others."""
    return F.when(F.col(column) == value, 0).otherwise(1).asc()
