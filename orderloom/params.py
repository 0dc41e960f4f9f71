"""Thresholds of the analytics models, as one immutable value passed to the plans."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Params:
    # Production defaults of the thresholds.
    cycle_gap_minutes: int = 60
    cycle_abandon_days: int = 7
    churn_consecutive_weeks: int = 3
    go_live: datetime = datetime(2026, 1, 22)
    min_demand_events: int = 10
    oos_min_days: int = 4
    promote_max_events: int = 2
    trend_ratio: float = 1.5
    trend_min_base_views: int = 5
    late_window_days: int = 3

    # "Now" for open cycles and clock-skew clamping; None means the query's own wall clock.
    as_of: datetime | None = None

    # Width of the time slices that split one key's event sequence over several tasks.
    slice_minutes: int = 60

    def now(self) -> Column:
        return F.current_timestamp() if self.as_of is None else F.lit(self.as_of)
