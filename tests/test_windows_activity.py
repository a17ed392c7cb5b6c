import pytest

from helpers import seconds, ticks
from tidegauge.operators import (
    SkewPolicy,
    inactive_keys,
    latest_by_key,
    latest_per_tick,
    window_average_row,
    window_count,
    window_rows,
    window_sum,
)

EARLY = SkewPolicy(hot_rows=2, run_rows=2)


def rows(df):
    return sorted(map(tuple, seconds(df).collect()))


def test_sum_is_a_long_and_edges_belong_to_the_later_window(spark):
    frame = ticks(spark, [("S", 0, 0.0), ("S", 59.999, 0.0), ("S", 60, 0.0)]).selectExpr(
        "symbol as seller_id", "2000000000 as amount_usd", "event_time"
    )
    assert rows(window_sum(frame)) == [("S", 0.0, 60.0, 4_000_000_000), ("S", 60.0, 120.0, 2_000_000_000)]


def test_count_with_and_without_slide(spark):
    frame = ticks(spark, [("A", 0, 1.0), ("A", 30, 1.0), ("A", 31, None), ("B", 30, 1.0)])
    assert rows(window_count(frame)) == [("A", 0.0, 30.0, 1), ("A", 30.0, 60.0, 2), ("B", 30.0, 60.0, 1)]
    sliding = rows(window_count(frame, size="1 minute", slide="30 seconds"))
    assert [r for r in sliding if r[0] == "A"] == [("A", -30.0, 30.0, 1), ("A", 0.0, 60.0, 3), ("A", 30.0, 90.0, 2)]


def test_mean_on_the_first_row(spark):
    frame = ticks(spark, [("A", 5, 30.0), ("A", 1, 10.0), ("A", 1, 26.0), ("A", 61, 7.0)])
    got = window_average_row(frame.withColumnRenamed("close", "temperature"), "symbol", "temperature", "60 seconds")
    assert rows(got) == [("A", 0.0, 60.0, 1.0, 1, 22.0), ("A", 60.0, 120.0, 61.0, 3, 7.0)]


def test_rows_of_windows(spark):
    frame = ticks(spark, [("A", 29, 1.0), ("A", 30, 2.0)])
    got = rows(window_rows(frame, "1 minute", "30 seconds"))
    assert [(r[1], r[4]) for r in got] == [(-30.0, 0), (0.0, 0), (0.0, 1), (30.0, 1)]


def test_latest(spark):
    frame = ticks(spark, [("A", 5, 3.0), ("A", 1, 1.0), ("A", 5, 4.0), ("A", 9, None), ("B", 2, 8.0)])
    assert rows(latest_by_key(frame)) == [("A", 1.0, 5.0, 4.0), ("B", 2.0, 2.0, 8.0)]
    expected = [("A", 1.0, 1.0, 1, 1.0), ("A", 1.0, 5.0, 0, 3.0), ("A", 1.0, 5.0, 2, 4.0), ("B", 2.0, 2.0, 4, 8.0)]
    assert rows(latest_per_tick(frame)) == expected
    assert rows(latest_per_tick(frame, EARLY)) == expected


@pytest.mark.parametrize("policy", [SkewPolicy(), EARLY, SkewPolicy(hot_rows=2, run_rows=1)])
def test_silence(spark, policy):
    frame = ticks(spark, [("A", t, t) for t in (0.0, 9.999, 19.999, 30.0, 30.0)] + [("B", 3.0, 1.0)])
    got = [(r[0], r[1], r[2], r[5]) for r in rows(inactive_keys(frame, policy=policy))]
    assert got == [
        ("A", 0.0, pytest.approx(9.999), pytest.approx(19.999)),
        ("A", 0.0, pytest.approx(19.999), pytest.approx(29.999)),
        ("A", 0.0, 30.0, 40.0),
        ("B", 3.0, 3.0, 13.0),
    ]
