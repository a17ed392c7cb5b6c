"""Event-time windows and their aggregates, for tables and streams alike.

Windows are aligned to the epoch. Sums, counts and averages combine on the
map side, so a hot key costs one partial row per task and window.
"""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def event_window(size: str, slide: str | None = None, time: str = "event_time") -> Column:
    return F.window(time, size, slide) if slide else F.window(time, size)


def duration_micros(duration: str) -> int:
    """``30 seconds`` or ``1 day`` in microseconds; a day has 24 hours."""
    return pd.Timedelta(duration) // pd.Timedelta("1us")


WINDOW = "_window"
BLOCK = "_block"


@dataclass(frozen=True)
class WindowBlocks:
    """Windows in blocks of neighbours, so that rows need not be copied per window.

    A row lies in up to ``per_size`` windows. They belong to one block, or to
    two for the few rows near a border, so a shuffle by block moves hardly more
    than one copy of each row. All times are microseconds.
    """

    size: int
    slide: int
    per_size: int
    per_block: int

    @classmethod
    def of(cls, size: str, slide: str | None) -> WindowBlocks:
        length, step = duration_micros(size), duration_micros(slide or size)
        if not 0 < step <= length:
            raise ValueError("a slide is positive and at most the size of the window")
        per_size = -(-length // step)
        return cls(length, step, per_size, 1 if per_size == 1 else 16 * per_size)

    def _pane(self, time: Column) -> Column:
        micros = F.unix_micros(time)
        return ((micros - F.pmod(micros, F.lit(self.slide))) / self.slide).cast("bigint")

    def place(self, df: DataFrame, time: str = "event_time") -> DataFrame:
        """Rows with ``_block``, twice if they count in two blocks."""
        placed = df.filter(F.col(time).isNotNull())
        pane = self._pane(F.col(time))
        if self.per_size == 1:
            return placed.withColumn(BLOCK, pane)
        first, last = (F.floor(p / self.per_block).cast("bigint") for p in (pane - (self.per_size - 1), pane))
        return placed.withColumn(BLOCK, F.explode(F.sequence(first, last)))

    def unfold(self, placed: DataFrame, time: str = "event_time") -> DataFrame:
        """Rows of blocks once per window of the block, with its start in ``_window``."""
        pane, block = self._pane(F.col(time)), F.col(BLOCK)
        first = F.greatest(pane - (self.per_size - 1), block * self.per_block)
        last = F.least(pane, (block + 1) * self.per_block - 1)
        unfolded = placed.withColumn(WINDOW, F.explode(F.sequence(first, last)))
        started = unfolded.withColumn(WINDOW, F.col(WINDOW) * self.slide)
        return started.filter(F.unix_micros(time) < F.col(WINDOW) + self.size)

    def block_of(self, window: int) -> int:
        return window // self.slide // self.per_block


def in_windows(df: DataFrame, size: str, slide: str | None = None, time: str = "event_time") -> DataFrame:
    """Each row once per window it falls in, with window_start and window_end.

    Rows without event time are in no window.
    """
    placed = df.withColumn("_w", event_window(size, slide, time))
    return placed.select(*df.columns, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"))


def _aggregate(df: DataFrame, key: str, size: str, slide: str | None, time: str, *aggregates: Column) -> DataFrame:
    grouped = df.groupBy(F.col(key), event_window(size, slide, time).alias("_w")).agg(*aggregates)
    return grouped.select(
        key,
        F.col("_w.start").alias("window_start"),
        F.col("_w.end").alias("window_end"),
        *[name for name in grouped.columns if name not in (key, "_w")],
    )


def window_sum(
    df: DataFrame,
    key: str = "seller_id",
    amount: str = "amount_usd",
    size: str = "60 seconds",
    slide: str | None = None,
    time: str = "event_time",
    alias: str = "aggregated_amount",
) -> DataFrame:
    return _aggregate(df, key, size, slide, time, F.sum(amount).alias(alias))


def window_count(
    df: DataFrame, key: str = "symbol", size: str = "30 seconds", slide: str | None = None, time: str = "event_time"
) -> DataFrame:
    return _aggregate(df, key, size, slide, time, F.count(F.lit(1)).alias("n"))


def window_average_row(
    df: DataFrame,
    key: str,
    value: str,
    size: str,
    slide: str | None = None,
    time: str = "event_time",
    seq: str = "seq",
) -> DataFrame:
    """The first row of each window with ``value`` replaced by the window's mean."""
    rest = [name for name in df.columns if name not in (key, value)]
    first = F.min_by(F.struct(*rest), F.struct(time, seq)).alias("_first")
    grouped = _aggregate(df, key, size, slide, time, first, F.avg(value).alias("_mean"))
    return grouped.select(
        key,
        "window_start",
        "window_end",
        *[F.col("_mean").alias(value) if name == value else F.col(f"_first.{name}").alias(name)
          for name in df.columns if name != key],
    )


def window_rows(
    df: DataFrame, size: str, slide: str | None = None, key: str = "symbol", time: str = "event_time"
) -> DataFrame:
    """The rows of every window, one output row per (window, row).

    What a function over whole windows would be handed, without collecting:
    group by (key, window_start, window_end) to aggregate it further.
    """
    placed = in_windows(df, size, slide, time)
    return placed.select(key, "window_start", "window_end", *[name for name in df.columns if name != key])
