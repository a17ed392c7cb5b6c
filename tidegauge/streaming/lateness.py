"""How late a row may be.

Per-tick averages take every row, however late, and so use no watermark.
Windows close when the watermark passes their end; a row that is late for one
window still counts in those that are open.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField, StructType

from ..operators.windows import WindowBlocks
from ..session import use_rocksdb

BOUNDED = "2 seconds"
RELAXED = "5 seconds"
MONOTONOUS = "0 seconds"


def with_watermark(df: DataFrame, delay: str | None = BOUNDED, time: str = "event_time") -> DataFrame:
    """``delay`` None leaves the stream without a watermark."""
    return df if delay is None else df.withWatermark(time, delay)


REASON = "reason"
LATE, UNTIMED = "late", "no_time"
#: Groups that rows are dealt to for judging, whatever their symbols.
DEALT = 200
NO_TIME = -(2**63)


class Lateness(StatefulProcessor):
    """Marks the rows all of whose windows the watermark has passed. It keeps no state."""

    output = StructType(
        [StructField("symbol", StringType()), StructField("event_time", LongType()), StructField("seq", LongType()), StructField("unnumbered", BooleanType())]
        + [StructField("close", DoubleType()), StructField(LATE, BooleanType())]
    )

    def __init__(self, size: int, slide: int):
        self.size, self.slide = size, slide

    def init(self, handle: StatefulProcessorHandle) -> None:
        pass

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        passed = timerValues.getCurrentWatermarkInMs()
        for frame in rows:
            timed = frame["event_time"] != NO_TIME
            end = frame["event_time"].where(timed, 0) // self.slide * self.slide + self.size
            yield frame.assign(**{LATE: timed & (end <= passed * 1000)})[self.output.names]


def judged_lateness(ticks: DataFrame, size: str, slide: str | None = None) -> DataFrame:
    """symbol, event_time, seq, close of every row of a stream with a watermark, and why it is in no window.

    ``reason`` is ``late`` where all windows of the row were closed when its micro-batch began, ``no_time``
    without an event time, else null. Rows are judged by the law of ``stream_window_averages`` and none
    is lost; ``sinks.split_by`` writes both kinds from one micro-batch. Rows are dealt out evenly, so a
    hot symbol is many tasks' work.
    """
    windows = WindowBlocks.of(size, slide)
    time, deal = F.coalesce(F.unix_micros("event_time"), F.lit(NO_TIME)), F.pmod(F.xxhash64("symbol", "event_time", "seq", "close"), F.lit(DEALT))
    plain = ticks.select("symbol", time.alias("event_time"), F.coalesce("seq", F.lit(0)).alias("seq"), F.col("seq").isNull().alias("unnumbered"), "close", deal.alias("deal"))
    use_rocksdb(ticks.sparkSession)
    out = plain.groupBy("deal").transformWithStateInPandas(
        statefulProcessor=Lateness(windows.size, windows.slide), outputStructType=Lateness.output, outputMode="append", timeMode="EventTime"
    )
    untimed = F.col("event_time") == NO_TIME
    return out.select(
        "symbol",
        F.when(~untimed, F.timestamp_micros("event_time")).alias("event_time"),
        F.when(~F.col("unnumbered"), F.col("seq")).alias("seq"),
        "close",
        F.when(untimed, F.lit(UNTIMED)).when(F.col(LATE), F.lit(LATE)).alias(REASON),
    )
