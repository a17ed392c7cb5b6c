"""Functions of a user over the rows of each window, fed as they stream by."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.smoothing import usable
from ..schemas import TICK_ORDER
from .fold import group_starts, row_group
from .windows import in_windows

GROUP = ("symbol", "window_start", "window_end")


class WindowFunction(Protocol):
    """Sees the prices of one window in order, part by part, and gives one row for it."""

    def add(self, prices: np.ndarray) -> None: ...

    def result(self) -> tuple: ...


class Drawdown:
    """The largest fall from a price to one not before it; 0 if prices only rise."""

    schema = StructType([StructField("drawdown", DoubleType())])

    def __init__(self):
        self.top, self.fall = -np.inf, 0.0

    def add(self, prices: np.ndarray) -> None:
        tops = np.maximum.accumulate(np.append(self.top, prices))
        self.fall = max(self.fall, float((tops[1:] - prices).max()))
        self.top = float(tops[-1])

    def result(self) -> tuple:
        return (self.fall,)


def over_windows(ticks: DataFrame, size: str, make: Callable[[], WindowFunction], schema: StructType, slide: str | None = None) -> DataFrame:
    """symbol, window_start, window_end and the columns ``schema`` of a function over each window's prices.

    Rows are partitioned by symbol and window, sorted there, and handed on in the order of (event_time, seq) in
    batches, to an object that ``make`` creates for each window. So no window is collected, however large.
    Ticks without a time or a finite price are in no window; an empty table gives no row.
    """
    kept = ticks.filter(usable(F.col("event_time"), F.col("close"))).select("symbol", *TICK_ORDER, "close")
    rows = in_windows(kept, size, slide)
    rows = rows.repartition(*GROUP).sortWithinPartitions(*GROUP, *TICK_ORDER).select(*GROUP, "close")
    out = StructType([rows.schema[name] for name in GROUP] + list(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tail, function, kinds = None, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            kinds = [batch.schema.field(name).type for name in GROUP]
            prices, done = batch.column("close").to_numpy(zero_copy_only=False), []
            cuts = np.flatnonzero(group_starts(batch, GROUP, tail)).tolist()
            for a, b in zip(sorted({0, *cuts}), [*[cut for cut in cuts if cut], batch.num_rows]):
                if a in cuts:
                    if function is not None:
                        done.append((*tail, *function.result()))
                    function = make()
                function.add(prices[a:b])
                tail = row_group(batch, GROUP, a)
            if done:
                yield table(done, kinds)
        if function is not None:
            yield table([(*tail, *function.result())], kinds)

    def table(done: list[tuple], kinds: list[pa.DataType]) -> pa.RecordBatch:
        types = [*kinds, *[None] * len(schema)]
        return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*done), types)], names=out.names)

    return rows.mapInArrow(run, out)


def window_drawdown(ticks: DataFrame, size: str, slide: str | None = None) -> DataFrame:
    """symbol, window_start, window_end, drawdown: the largest fall of the price within each window."""
    return over_windows(ticks, size, Drawdown, Drawdown.schema, slide)
