"""Ordered computations over keys too large for one task.

A window partitioned by the key alone sends all events of a key to one task. Here a key's
events are cut into time slices; each slice is a window partition of its own, and what has to
flow from one slice to the next is worked out on one summary row per slice. A key then has as
many summary rows as slices with events, whatever the number of its events.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from orderloom.functions.text import col

SLICE = "_slice"


def slice_of(ts: Column | str, minutes: int) -> Column:
    return F.floor(F.unix_seconds(col(ts)) / (minutes * 60))


def within_slice(keys: list[str], *order: Column | str) -> WindowSpec:
    return Window.partitionBy(*keys, SLICE).orderBy(*order)


def across_slices(keys: list[str]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(SLICE)


def up_to_here(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def before_here(window: WindowSpec) -> WindowSpec:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def latest_before(
    marks: DataFrame, keys: list[str], order: list[str], values: dict[str, Column]
) -> DataFrame:
    """For each row, the latest earlier non-NULL value of every expression in `values`.

    `marks` must carry the slice column. Each value is found in the row's own slice first, and
    otherwise in the last earlier slice that has one. The join reuses the windows' partitioning
    and sort order, so only the summary rows move. Rows with a NULL key find nothing beyond
    their own slice.
    """
    when = F.struct(*order)
    summary = marks.groupBy(*keys, SLICE).agg(
        *[
            F.max_by(value, F.when(value.isNotNull(), when)).alias(name)
            for name, value in values.items()
        ]
    )
    previous = before_here(across_slices(keys))
    carried = summary.select(
        *[F.col(k).alias(f"_c_{k}") for k in (*keys, SLICE)],
        *[F.last(name, ignorenulls=True).over(previous).alias(f"_c_{name}") for name in values],
    )
    inside = before_here(within_slice(keys, *order))
    local = marks.select(
        "*", *[F.last(v, ignorenulls=True).over(inside).alias(n) for n, v in values.items()]
    )
    same = [F.col(k) == F.col(f"_c_{k}") for k in (*keys, SLICE)]
    joined = local.join(carried, same, "left")
    return joined.select(
        *marks.columns, *[F.coalesce(n, f"_c_{n}").alias(n) for n in values]
    )
