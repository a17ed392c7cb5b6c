"""Windowed averages on streams. Sums, counts and means need nothing special:
the functions of ``operators.windows`` work on streams with a watermark."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import gcd
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, DoubleType, LongType, StringType, StructField, StructType

from ..functions.smoothing import usable
from ..operators.fold import Fold, Smoothing
from ..operators.windows import WindowBlocks
from ..session import use_rocksdb
from .state_rows import BUCKET, DATA, RUNS, dealt, read_chunks, runs_of

#: Bytes of panes that a task keeps at hand while windows that share them close.
CACHED = 64 << 20
#: Ticks that a task takes in before it puts them into their panes; ticks folded at once.
HELD, AT_ONCE = 250_000, 100_000


class PaneWindows(StatefulProcessor):
    """Averages of sliding windows over panes, the stretches between two window starts.

    The key is a bucket of symbols, so that state is read and written per bucket and not per symbol. State holds
    each tick once, 24 bytes, in the pane it falls in, however many windows
    overlap there; a pane is as wide as the greatest stretch that divides size and slide. A micro-batch adds an entry to each pane
    per ``HELD`` ticks and rewrites none. A window has a timer at its end; when the watermark passes it, the window's panes are read, put in
    order by symbol and folded, and the pane that no later window needs is dropped.
    """

    def __init__(self, smoothing: Smoothing, size: int, slide: int):
        self.smoothing, self.size, self.slide, self.pane = smoothing, size, slide, gcd(size, slide)

    def _ends(self, pane: int) -> list[int]:
        """Ends of the windows that hold a pane."""
        last = pane * self.pane // self.slide * self.slide
        return [start + self.size for start in range(last, (pane + 1) * self.pane - self.size - 1, -self.slide)]

    @property
    def output(self) -> StructType:
        longs = [StructField(name, LongType()) for name in ("window_start", "window_end")]
        return StructType([StructField("symbol", StringType()), *longs, *[StructField(name, DoubleType()) for name in self.smoothing.names]])

    def init(self, handle: StatefulProcessorHandle) -> None:
        pane, number = StructField("pane", LongType()), StructField("number", LongType())
        chunk = StructType([StructField(RUNS, BinaryType()), StructField(DATA, BinaryType())])
        self.handle = handle
        self.entries = handle.getMapState("entries", StructType([pane]), StructType([number]))
        self.ticks = handle.getMapState("ticks", StructType([pane, number]), chunk)
        self.cache: dict[tuple, list] = {}
        self.cached = 0

    def _read(self, key: Any, pane: int) -> list[tuple[bytes, bytes]]:
        if (key[0], pane) not in self.cache:
            numbers = range(self.entries.getValue((pane,))[0]) if self.entries.containsKey((pane,)) else ()
            chunks = [tuple(map(bytes, self.ticks.getValue((pane, n)))) for n in numbers]
            if self.cached > CACHED:
                self.cache, self.cached = {}, 0
            self.cache[key[0], pane] = chunks
            self.cached += sum(len(runs) + len(data) for runs, data in chunks) + 200
        return self.cache[key[0], pane]

    def _drop(self, key: Any, pane: int) -> None:
        self.cache.pop((key[0], pane), None)
        if self.entries.containsKey((pane,)):
            for n in range(self.entries.getValue((pane,))[0]):
                self.ticks.removeKey((pane, n))
            self.entries.removeKey((pane,))

    def _keep(self, key: Any, chunks: list[tuple[bytes, bytes]], passed: int) -> set[int]:
        """Puts ticks into their panes; the timers of the windows that are open for them."""
        symbols, codes, ticks = read_chunks(chunks)
        panes, timers = ticks["micros"] // self.pane, set()
        order = np.lexsort((codes, panes))
        codes, ticks, panes = codes[order], ticks[order], panes[order]
        first = np.append(0, np.flatnonzero(np.diff(panes)) + 1)
        for pane, a, b in zip(panes[first].tolist(), first, np.append(first[1:], len(panes))):
            ends = [end for end in self._ends(pane) if self._due(end) >= passed]
            if not ends:
                continue  # late for all of its windows
            number = self.entries.getValue((pane,))[0] if self.entries.containsKey((pane,)) else 0
            self.ticks.updateValue((pane, number), (runs_of(symbols, codes[a:b]), ticks[a:b].tobytes()))
            self.entries.updateValue((pane,), (number + 1,))
            self.cache.pop((key[0], pane), None)
            timers.update(map(self._due, ends))
        return timers

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        passed, timers = timerValues.getCurrentWatermarkInMs(), set()
        held, size = [], 0
        for frame in rows:
            for chunk in zip(frame[RUNS], frame[DATA]):
                held.append(chunk)
                size += len(chunk[1]) // 24
                if size >= HELD:
                    timers |= self._keep(key, held, passed)
                    held, size = [], 0
        if held:
            timers |= self._keep(key, held, passed)
        for due in timers:
            self.handle.registerTimer(due)
        return iter(())

    @staticmethod
    def _due(end: int) -> int:
        """The timer of a window, in ms; it fires when the watermark is later."""
        return end // 1000 - 1

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        end = (expiredTimerInfo.getExpiryTimeInMs() + 1) * 1000
        start = end - self.size
        chunks = [chunk for pane in range(start // self.pane, end // self.pane) for chunk in self._read(key, pane)]
        for pane in range(start // self.pane, -(-(start + self.slide) // self.pane)):
            if pane * self.pane < end:
                self._drop(key, pane)  # this was its last window
        if chunks:
            symbols, averages = self._folded(chunks)
            window = {"symbol": symbols.to_pylist(), "window_start": start, "window_end": end}
            yield pd.DataFrame(window | dict(zip(self.smoothing.names, averages)))

    def _folded(self, chunks: list[tuple[bytes, bytes]]) -> tuple[pa.Array, list[np.ndarray]]:
        """Each symbol of a window and its averages after the last tick."""
        symbols, codes, ticks = read_chunks(chunks)
        order = np.lexsort((ticks["seq"], ticks["micros"], codes))
        codes, close = codes[order], ticks["close"][order]
        starts = np.diff(codes, prepend=-1) != 0
        ends = np.append(np.flatnonzero(starts[1:]), len(codes) - 1)
        fold, found = Fold(self.smoothing, ["symbol"]), []
        for at in range(0, len(codes), AT_ONCE):
            part = slice(at, at + AT_ONCE)
            averages, _ = fold.advance(close[part], None, starts[part], {})
            some = ends[(ends >= at) & (ends < at + AT_ONCE)] - at
            found.append([values[some] for values in averages])
        return symbols.take(pa.array(codes[ends])), [np.concatenate(parts) for parts in zip(*found)]


def stream_window_averages(
    ticks: DataFrame, size: str, slide: str | None = None, spans: Sequence[float] = (10, 100)
) -> DataFrame:
    """The averages of each closed (symbol, window) of a stream with a watermark.

    Rows may come in any order until a window closes and are folded in the order of event time; a row
    late for one window still counts in those open. State is the ticks of the open windows, each
    once. What one task holds in memory is one window of one bucket of symbols, of which there are ``DEALT``.
    """
    windows = WindowBlocks.of(size, slide)
    if windows.size % 1000 or windows.slide % 1000:
        raise ValueError("windows begin and end at whole milliseconds")
    processor = PaneWindows(Smoothing(tuple(spans), seed_step=False), windows.size, windows.slide)
    use_rocksdb(ticks.sparkSession)
    # Without the column that has the watermark, Spark leaves late rows to the processor, which judges them by window.
    plain = ticks.filter(usable(F.col("event_time"), F.col("close"))).select(
        "symbol", F.unix_micros("event_time").alias("event_time"), "seq", "close"
    )
    out = dealt(plain).groupBy(BUCKET).transformWithStateInPandas(
        statefulProcessor=processor, outputStructType=processor.output, outputMode="append", timeMode="EventTime"
    )
    return out.withColumns({name: F.timestamp_micros(name) for name in ("window_start", "window_end")})
