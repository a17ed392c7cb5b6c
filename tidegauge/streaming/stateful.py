"""Queries that keep a value per symbol between micro-batches.

State lives in the RocksDB store (``session.use_rocksdb``), partitioned by
symbol. Within one micro-batch the ticks of a symbol are folded in the order of
event time; across micro-batches in the order they arrive. A symbol's share of one
micro-batch is one task's work, so bound the batch at the source (``maxOffsetsPerTrigger``,
``maxBytesPerTrigger``); averages per tick take it in pieces, and a task holds one piece in memory. Ticks go to the state
and come back in chunks, see ``state_rows``.

State that expires (``ttl_ms``) follows the wall clock. Such a query always has
another micro-batch to run, so it never ends by itself: start it with a
processing-time trigger, not with ``availableNow``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from ..functions.eventtime import emission_stamp
from ..functions.smoothing import advice, usable
from ..operators.fold import Fold, Smoothing
from ..operators.windows import duration_micros
from ..session import use_rocksdb
from .state_rows import CHUNKS, Ticks, in_order, packed, unpacked
from .windowed import stream_window_averages


def _schema(symbol: bool = True, longs: Iterable[str] = (), doubles: Iterable[str] = ()) -> StructType:
    return StructType(
        [
            *([StructField("symbol", StringType())] if symbol else []),
            *[StructField(name, LongType()) for name in longs],
            *[StructField(name, DoubleType()) for name in doubles],
        ]
    )


def _plain(ticks: DataFrame, *more: str) -> DataFrame:
    """Priced ticks with event time as microseconds, which no time zone can shift."""
    kept = [F.col("event_time").alias(name) for name in more]
    return ticks.filter(usable(F.col("event_time"), F.col("close"))).select(
        "symbol", F.unix_micros("event_time").alias("event_time"), "seq", "close", *kept
    )


def _timed(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.timestamp_micros(name) for name in names})


def _with_state(df: DataFrame, processor: StatefulProcessor, time_mode: str = "None", initial: DataFrame | None = None, frames: bool = False) -> DataFrame:
    """With ``frames`` a processor takes and gives data frames; Spark collects the rows that others give for a key."""
    use_rocksdb(df.sparkSession)
    groups = df.groupBy("symbol")
    return (groups.transformWithStateInPandas if frames else groups.transformWithState)(
        statefulProcessor=processor,
        outputStructType=processor.output,
        outputMode="append",
        timeMode=time_mode,
        initialState=None if initial is None else initial.groupBy("symbol"),
    )


class TickAverages(StatefulProcessor):
    """Averages of each tick; state is the last averages and their time.

    State that expires in event time has a timer, which drops it when the watermark is past the time from which
    the next tick would start again anyway. A timer that a later tick has overtaken is ignored.
    """

    def __init__(self, smoothing: Smoothing, ttl_ms: int | None = None):
        self.smoothing = smoothing
        self.ttl_ms = ttl_ms

    output = CHUNKS

    @property
    def averages(self) -> list[str]:
        """The columns that ``unpacked`` makes of the chunks."""
        return [*self.smoothing.names, *self.smoothing.names_before]

    def init(self, handle: StatefulProcessorHandle) -> None:
        state = _schema(symbol=False, longs=["micros"], doubles=self.smoothing.names)
        self.last = handle.getValueState("last", state, self.ttl_ms)
        self.handle = handle

    def _due(self, micros: int) -> int:
        return -(-(micros + self.smoothing.expire) // 1000)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        last = self.last.get()
        if last is not None and self._due(last[0]) <= expiredTimerInfo.getExpiryTimeInMs():
            self.last.clear()
        return iter(())

    def handleInitialState(self, key: Any, initialState: pd.DataFrame, timerValues: Any) -> None:
        """A row of :func:`operators.last_averages`, with its time in microseconds."""
        micros = int(initialState["micros"].iloc[0])
        self.last.update((micros, *(float(initialState[name].iloc[0]) for name in self.smoothing.names)))
        if self.smoothing.expire is not None:
            self.handle.registerTimer(self._due(micros))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        last, fold = self.last.get(), Fold(self.smoothing, ["symbol"])
        known = last is not None
        if known:
            fold.micros, *fold.states = last
        micros = None
        for ticks in in_order(rows):
            starts = np.zeros(len(ticks.close), dtype=bool)
            starts[0] = not known
            averages, before = fold.advance(ticks.close, ticks.micros, starts, {})
            known, micros = True, int(ticks.micros[-1])
            yield _chunk_frame(key[0], ticks.chunks(dict(zip(self.averages, [*averages, *before]))))
        if micros is not None:
            self.last.update((micros, *fold.states))
            if self.smoothing.expire is not None:
                self.handle.registerTimer(self._due(micros))


def _chunk_frame(symbol: str | None, chunks: Iterable[bytes]) -> pd.DataFrame:
    data = list(chunks)
    return pd.DataFrame({"symbol": [symbol] * len(data), "data": data})


class WindowsBefore(StatefulProcessor):
    """Puts the averages of the window before next to those of each window."""

    def __init__(self, names: list[str]):
        self.names = names

    @property
    def output(self) -> StructType:
        before = [f"{name}_before" for name in self.names]
        return _schema(longs=["window_start", "window_end"], doubles=[*self.names, *before])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", _schema(symbol=False, doubles=self.names))
        self.row = Row(*self.output.names)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        before = self.last.get()
        for window in sorted(rows, key=lambda window: window.window_end):
            now = tuple(window[name] for name in self.names)
            if before is not None:
                yield self.row(window.symbol, window.window_start, window.window_end, *now, *before)
            before = now
        self.last.update(tuple(before))


class FirstTime(StatefulProcessor):
    """Remembers when a symbol was first seen; the latest close is the average."""

    output = CHUNKS

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = handle.getValueState("first", _schema(symbol=False, longs=["micros"]))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        first = self.first.get()
        for ticks in in_order(rows):
            if first is None:
                first = (int(ticks.micros[0]),)
                self.first.update(first)
            yield _chunk_frame(key[0], ticks.chunks({"ema": ticks.close}, {"first_time": first[0]}))


class Silence(StatefulProcessor):
    """Reports each tick of a symbol that none follows within the timeout, once.

    A gap between ticks that have come is reported with them, however they are dealt out
    to micro-batches; the open end waits for its timer. A timer that a later tick
    has overtaken is left to run out and ignored, and so is a tick older than the last.
    """

    output = _schema(longs=["first_time", "event_time", "seq", "fired_at"], doubles=["ema"])

    def __init__(self, timeout_ms: int):
        self.timeout_ms = timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        state = _schema(symbol=False, longs=["first_time", "event_time", "seq", "reported"], doubles=["ema"])
        self.last = handle.getValueState("last", state)
        self.row = Row(*self.output.names)

    def _due(self, micros: int) -> int:
        return micros // 1000 + self.timeout_ms

    def _silent(self, key: Any, first: int, micros: int, seq: int | None, close: float) -> Row:
        return self.row(key[0], first, micros, seq, micros + self.timeout_ms * 1000, close)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        ticks, known = Ticks.of_rows(rows), self.last.get()
        first = int(ticks.micros[0]) if known is None else known[0]
        since = None if known is None else known[1]
        newer = 0 if since is None else int(np.searchsorted(ticks.micros, since))
        if newer == len(ticks.micros):
            return
        last = None if known is None or known[3] else (known[1], known[2], known[4])
        for micros, seq, close in ticks.rows(ticks.close, start=newer):
            if last is not None and micros - last[0] >= self.timeout_ms * 1000:
                yield self._silent(key, first, *last)
            last = micros, seq, close
        self.last.update((first, last[0], last[1], 0, last[2]))
        self.handle.registerTimer(self._due(last[0]))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        first, last, seq, reported, ema = self.last.get()
        if not reported and expiredTimerInfo.getExpiryTimeInMs() == self._due(last):
            self.last.update((first, last, seq, 1, ema))
            yield self._silent(key, first, last, seq, ema)


def _averaged(ticks: DataFrame, smoothing: Smoothing, ttl_ms: int | None, history: DataFrame | None = None) -> DataFrame:
    initial = None
    if history is not None:
        initial = history.select("symbol", F.unix_micros("event_time").alias("micros"), *smoothing.names)
    mode = "ProcessingTime" if ttl_ms else "None" if smoothing.expire is None else "EventTime"
    processor = TickAverages(smoothing, ttl_ms)
    return _timed(unpacked(_with_state(packed(_plain(ticks)), processor, mode, initial, frames=True), processor.averages), "event_time")


def averages_in_state(spark: SparkSession, checkpoint: str, spans: Sequence[float] = (10, 100)) -> DataFrame:
    """symbol, event_time and the last averages that a stopped :func:`stream_tick_advice` will go on from.

    Read from the state store in its checkpoint, as of the last micro-batch; a row per symbol.
    """
    use_rocksdb(spark)
    rows = spark.read.format("statestore").option("stateVarName", "last").load(checkpoint)
    names = Smoothing(tuple(spans)).names
    return _timed(rows.select("key.symbol", F.col("value.micros").alias("event_time"), *[f"value.{name}" for name in names]), "event_time")


def stream_tick_advice(
    ticks: DataFrame,
    spans: tuple[float, float] = (10, 100),
    zero_unset: bool = False,
    eps: float = 0.0,
    stamp: str = "event",
    ttl_ms: int | None = None,
    history: DataFrame | None = None,
    expire_after: str | None = None,
) -> DataFrame:
    """``operators.tick_advice`` on a stream without a watermark.

    With ``ttl_ms`` a symbol without ticks for that long starts again. ``history``, as
    ``operators.last_averages`` gives it, is what symbols go on from when the query first starts; a
    restart has its checkpoint. With ``expire_after`` a symbol silent for that long in event time starts
    again, which gives the same rows whenever it runs; the stream then needs a watermark, by which state is dropped. Late
    ticks still count, in the order they arrive. It cannot be had together with ``ttl_ms``.
    """
    if ttl_ms and expire_after:
        raise ValueError("state expires by the wall clock or in event time")
    smoothing = Smoothing(tuple(spans), zero_unset=zero_unset, expire=expire_after and duration_micros(expire_after))
    out = _averaged(ticks, smoothing, ttl_ms, history)
    fast, slow = (F.col(f"ema{span}") for span in spans)
    fast_before, slow_before = (F.col(f"ema{span}_before") for span in spans)
    if zero_unset:
        out = out.filter((fast != 0) & slow.isNotNull())
    return out.select(
        "symbol",
        emission_stamp(stamp, F.col("event_time")).alias("timestamp"),
        "seq",
        fast,
        slow,
        advice(fast, slow, fast_before, slow_before, eps).alias("advise"),
    )


def stream_adaptive_average(ticks: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """``operators.adaptive_average`` on a stream; state may expire as above."""
    return _averaged(ticks, Smoothing((), seed_step=False), ttl_ms).drop("ema_before")


def stream_window_advice(
    ticks: DataFrame,
    size: str,
    slide: str | None = None,
    spans: tuple[float, float] = (10, 100),
    eps: float = 0.0,
    stamp: str = "event",
) -> DataFrame:
    """``operators.window_advice`` on a stream with a watermark."""
    names = [f"ema{span}" for span in spans]
    averaged = stream_window_averages(ticks, size, slide, spans).withColumns(
        {name: F.unix_micros(name) for name in ("window_start", "window_end")}
    )
    out = _timed(_with_state(averaged, WindowsBefore(names)), "window_start", "window_end")
    fast, slow = F.col(names[0]), F.col(names[1])
    return out.select(
        "symbol",
        "window_start",
        "window_end",
        emission_stamp(stamp, F.col("window_end")).alias("timestamp"),
        fast,
        slow,
        advice(fast, slow, F.col(f"{names[0]}_before"), F.col(f"{names[1]}_before"), eps).alias("advise"),
    )


def stream_latest_per_tick(ticks: DataFrame) -> DataFrame:
    """``operators.latest_per_tick`` on a stream without a watermark."""
    chunks = _with_state(packed(_plain(ticks)), FirstTime(), frames=True)
    return _timed(unpacked(chunks, ["ema"], ["first_time", "event_time", "seq"]), "first_time", "event_time")


def stream_inactive_keys(ticks: DataFrame, timeout_ms: int = 10_000) -> DataFrame:
    """Symbols silent for ``timeout_ms`` of event time, on a stream with a watermark.

    Timers follow the watermark, which all symbols move together: a symbol
    whose next tick arrives before the watermark has passed its timer is not
    reported, though the table form would.
    """
    out = _with_state(_plain(ticks, "_at"), Silence(timeout_ms), "EventTime")
    return _timed(out, "first_time", "event_time", "fired_at")
