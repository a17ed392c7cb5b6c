"""The latest value of each key, and keys that have gone silent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.smoothing import usable
from ..schemas import TICK_ORDER
from .skew import RUN, HotGroups, SkewPolicy, find_hot, may_be_hot, ordered_runs

FIRST_TIME = "first_time"


def latest_by_key(ticks: DataFrame) -> DataFrame:
    """One row per symbol: time of its first tick, last close and its time.

    An average over one period is the price itself, so ``ema`` is the close.
    """
    known = ticks.filter(usable(F.col("event_time"), F.col("close")))
    place = F.struct(*TICK_ORDER)
    return known.groupBy("symbol").agg(
        F.min("event_time").alias(FIRST_TIME),
        F.max("event_time").alias("event_time"),
        F.max_by("close", place).alias("ema"),
    )


def latest_per_tick(ticks: DataFrame, policy: SkewPolicy = SkewPolicy()) -> DataFrame:
    """For each tick the time of its symbol's first tick and the latest close."""
    known = ticks.filter(usable(F.col("event_time"), F.col("close"))).select("symbol", "event_time", "seq", F.col("close").alias("ema"))
    hot = _hot_symbols(ticks, known, policy)
    cold = known if hot is None else hot.without(known)
    result = cold.withColumn(FIRST_TIME, F.first("event_time").over(_so_far()))
    if hot is not None:
        spread = hot.attach(known, FIRST_TIME).withColumn(FIRST_TIME, F.timestamp_micros(FIRST_TIME))
        result = result.unionByName(spread)
    return result.select("symbol", FIRST_TIME, "event_time", "seq", "ema")


def inactive_keys(ticks: DataFrame, timeout: str = "10 seconds", policy: SkewPolicy = SkewPolicy()) -> DataFrame:
    """Ticks that no tick of their symbol follows within ``timeout``.

    Gives the time of the symbol's first tick, the close that was left
    standing, its time, and when the timeout fired. A gap of exactly the
    timeout is silence: the timer is due when the next tick arrives.
    """
    known = ticks.filter(usable(F.col("event_time"), F.col("close")))
    known = known.select("symbol", "event_time", "seq", "close")
    hot = _hot_symbols(ticks, known, policy)
    cold = known if hot is None else hot.without(known)
    following = Window.partitionBy("symbol").orderBy(*TICK_ORDER)
    result = _silent(
        cold.withColumns(
            {FIRST_TIME: F.first("event_time").over(_so_far()), "_next": F.lead("event_time").over(following)}
        ),
        timeout,
    )
    if hot is not None:
        runs = ordered_runs(hot.attach(known, FIRST_TIME), ("symbol",), TICK_ORDER, hot.rows, policy)
        followed = _next_in_runs(runs.withColumn(FIRST_TIME, F.timestamp_micros(FIRST_TIME)))
        result = result.unionByName(_silent(followed, timeout))
    return result


def _hot_symbols(ticks: DataFrame, known: DataFrame, policy: SkewPolicy) -> HotGroups | None:
    if not may_be_hot(ticks, policy):
        return None
    return find_hot(known, ("symbol",), policy, **{FIRST_TIME: F.unix_micros(F.min("event_time"))})


def _so_far():
    return Window.partitionBy("symbol").orderBy(*TICK_ORDER).rowsBetween(Window.unboundedPreceding, 0)


def _silent(followed: DataFrame, timeout: str) -> DataFrame:
    fires: Column = F.col("event_time") + F.expr(f"interval {timeout}")
    return followed.filter(F.col("_next").isNull() | (F.col("_next") >= fires)).select(
        "symbol", FIRST_TIME, "event_time", "seq", F.col("close").alias("ema"), fires.alias("fired_at")
    )


def _next_in_runs(runs: DataFrame) -> DataFrame:
    """Time of the next tick; at the end of a run it is the next run's first.

    The window is one symbol within one run, so no task holds a whole hot
    symbol. There is one border row per run and symbol in it: at most the
    number of runs plus the number of hot symbols.
    """
    inside = Window.partitionBy(RUN, "symbol").orderBy(*TICK_ORDER)
    across = Window.partitionBy("symbol").orderBy(RUN)
    borders = runs.groupBy(RUN, "symbol").agg(F.min("event_time").alias("_opens"))
    borders = borders.select(
        F.col(RUN).alias("_border_run"),
        F.col("symbol").alias("_border_symbol"),
        F.lead("_opens").over(across).alias("_after"),
    )
    matched = (runs[RUN] == F.col("_border_run")) & runs["symbol"].eqNullSafe(F.col("_border_symbol"))
    return (
        runs.join(F.broadcast(borders), matched)
        .withColumn("_next", F.coalesce(F.lead("event_time").over(inside), F.col("_after")))
        .drop("_border_run", "_border_symbol", "_after", RUN)
    )
