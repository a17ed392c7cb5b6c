"""Exponential smoothing and crossover advice as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def alpha(span: float) -> float:
    """Weight of the newest price in an average over ``span`` periods."""
    if span < 1:
        raise ValueError("a span is at least 1")
    return 2 / (span + 1)


def to_number(column: Column) -> Column:
    """Text or any numeric type as double; null where it is no finite number.

    A NaN or an infinity would stay in a running average for good, so both
    count as missing.
    """
    number = column.try_cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def ema_step(price: Column, previous: Column, span: float) -> Column:
    """One smoothing step, rounded in the order every form here uses."""
    weight = alpha(span)
    return F.lit(weight) * price + F.lit(1 - weight) * previous


def advice(fast: Column, slow: Column, fast_before: Column, slow_before: Column, eps: float = 0.0) -> Column:
    """Buy when the fast average crosses above the slow one, Sell below, else Stay.

    With ``eps`` a gap not above it counts as none, which silences crossings
    that are only rounding noise.
    """
    before, now = fast_before - slow_before, fast - slow
    if eps:
        before = F.when(F.abs(before) <= eps, 0.0).otherwise(before)
        now = F.when(F.abs(now) <= eps, 0.0).otherwise(now)
    return F.when(now * before >= 0, "Stay").when(now > before, "Buy").otherwise("Sell")


def fold_window(entries: Column, spans: Sequence[float]) -> Column:
    """Averages of one collected window as a struct ``ema<span>...``.

    ``entries`` holds structs (event_time, seq, close). The first price seeds,
    the others are folded in order. For windows whose size is bounded, such as
    the open windows of a stream; tables use ``operators.window_averages``.
    """
    ordered = F.array_sort(entries)
    seed = F.element_at(ordered, 1)["close"]

    def merge(state: Column, entry: Column) -> Column:
        return F.struct(
            *[ema_step(entry["close"], state[f"ema{span}"], span).alias(f"ema{span}") for span in spans]
        )

    return F.aggregate(
        F.slice(ordered, 2, F.size(ordered)),
        F.struct(*[seed.alias(f"ema{span}") for span in spans]),
        merge,
    )


def usable(time: Column, close: Column) -> Column:
    """Whether a tick counts: it has a time and a finite price. The same in all forms, tables and streams."""
    return time.isNotNull() & close.isNotNull() & (F.abs(close) < float("inf"))
