from datetime import date, datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderloom.functions import classify, clock, text


def one(spark, column, **values):
    row = spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values))
    return row.select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "payload, expected",
    [
        ("category:8888,visits_num:2,time:15", "2"),
        ("a:1, visits_num : 7 , time:1", "7"),
        ("visits_num:", None),
        ("other_visits_num:3", None),
        ("visits_num:1,visits_num:2", "1"),
        ("", None),
        (None, None),
    ],
)
def test_kv_value(spark, payload, expected):
    assert one(spark, text.kv_value("p", "visits_num"), p=payload) == expected


@pytest.mark.parametrize(
    "payload, position, expected",
    [("54309, 3 ,CAT", 2, "3"), ("54309", 2, None), ("a,,c", 2, None), (None, 1, None)],
)
def test_list_part(spark, payload, position, expected):
    assert one(spark, text.list_part("p", position), p=payload) == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        ("1704067200", datetime(2024, 1, 1)),
        ("1704067200123", datetime(2024, 1, 1, 0, 0, 0, 123000)),
        (" 2024-01-01 10:20:30 ", datetime(2024, 1, 1, 10, 20, 30)),
        ("2024-01-01", datetime(2024, 1, 1)),
        ("2026-02", datetime(2026, 2, 1)),
        ("2024-1-5 1:02:03", datetime(2024, 1, 5, 1, 2, 3)),
        ("2024-01-01T10:20:30Z", datetime(2024, 1, 1, 10, 20, 30)),
        ("2024-01-01 10:20:30.1234567", datetime(2024, 1, 1, 10, 20, 30, 123456)),
        ("2024-13-01 00:00:00", None),
        ("2024-01-01 10:20:30+08:00", datetime(2024, 1, 1, 2, 20, 30)),
        ("999999999999", datetime(2001, 9, 9, 1, 46, 39, 999000)),
        ("99999999999999999999", None),
        ("999999999999999999", None),
        ("garbage", None),
        ("", None),
        (None, None),
    ],
)
def test_event_time(spark, value, expected):
    assert one(spark, clock.event_time("t"), t=value) == expected


@pytest.mark.parametrize(
    "value, expected",
    [("GMT+8", 8), ("GMT-11", -11), ("GMT+5:30", 5), ("UTC", None), ("", None), (None, None)],
)
def test_offset_hours(spark, value, expected):
    assert one(spark, clock.offset_hours("t"), t=value) == expected


@pytest.mark.parametrize(
    "value, whole, decimal",
    [
        ("+8", 8, 8.0),
        ("3.7", None, 3.7),
        ("1e3", None, 1000.0),
        ("1.5d", None, None),
        ("nan", None, None),
        ("x", None, None),
    ],
)
def test_numbers(spark, value, whole, decimal):
    assert one(spark, text.whole_number("n"), n=value) == whole
    assert one(spark, text.decimal_number("n"), n=value) == decimal


def test_minutes_count_boundaries(spark):
    start, end = "2024-01-01 00:00:59", "2024-01-01 00:01:00"
    minutes = clock.minutes_between(F.to_timestamp("a"), F.to_timestamp("b"))
    assert one(spark, minutes, a=start, b=end) == 1
    assert one(spark, minutes, a="2024-01-01 00:01:00", b="2024-01-01 00:01:59") == 0


def test_week_starts_on_monday(spark):
    assert one(spark, clock.week_start(F.to_date("d")), d="2024-01-07") == date(2024, 1, 1)
    assert one(spark, clock.week_start(F.to_date("d")), d="2024-01-08") == date(2024, 1, 8)


@given(
    st.lists(
        st.datetimes(datetime(2024, 1, 1), datetime(2024, 1, 3)), min_size=2, max_size=8
    ).map(sorted)
)
@settings(
    max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
def test_minutes_add_up_over_steps(spark, times):
    pairs = [*zip(times, times[1:]), (times[0], times[-1])]
    rows = (
        spark.createDataFrame(pairs, "a timestamp, b timestamp")
        .select(clock.minutes_between("a", "b"))
        .collect()
    )
    *steps, whole = [r[0] for r in rows]
    assert sum(steps) == whole


@pytest.mark.parametrize(
    "adds, removes, submitted, features, minutes, expected",
    [
        (1, 2, True, 0, 0, "churner"),
        (2, 1, True, 1, 15, "quick_reorder"),
        (2, 1, True, 1, 16, "mixed"),
        (2, 1, False, 3, 0, "browser"),
        (2, 1, True, 3, 0, "browser"),
        (0, 0, False, 0, 0, "mixed"),
    ],
)
def test_cycle_segment(spark, adds, removes, submitted, features, minutes, expected):
    segment = classify.cycle_segment(*[F.lit(v) for v in (adds, removes, submitted, features, minutes)])
    assert one(spark, segment, x="") == expected


@pytest.mark.parametrize(
    "days, bucket",
    [(0, "same-day"), (1, "1-3d"), (3, "1-3d"), (4, "4-7d"), (8, "8-14d"), (15, "14d+"), (-1, "14d+"), (None, "14d+")],
)
def test_days_bucket(spark, days, bucket):
    assert one(spark, classify.days_bucket(F.lit(days).cast("int")), x="") == bucket


@pytest.mark.parametrize(
    "ratio, days, segment",
    [
        (0.3, 0, "High Editor"),
        (0.05, 1, "Decisive"),
        (0.05, 2, "Slow Sender"),
        (0.2, 4, "Planner"),
        (None, 0, "Slow Sender"),
        (None, 9, "Planner"),
    ],
)
def test_journey_segment(spark, ratio, days, segment):
    column = classify.journey_segment(F.lit(ratio).cast("double"), F.lit(days))
    assert one(spark, column, x="") == segment


def test_service_mode_limits(spark):
    def mode(own, total):
        return one(spark, classify.service_mode(F.lit(own), F.lit(total)), x="")

    assert [mode(8, 10), mode(79, 100), mode(2, 10), mode(21, 100)] == [
        "self_service",
        "mixed",
        "sales_assisted",
        "mixed",
    ]
