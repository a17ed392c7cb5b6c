"""Exponential moving averages and crossover advice on tables of ticks.

Every average is folded in the order of (event_time, seq), each step rounded
as in a plain loop, so results agree to the last bit with a sequential run.
That matters for advice: right after a key's first tick both averages should
equal the price, and the sign of their difference is that of a rounding error.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from ..functions.eventtime import emission_stamp
from ..functions.smoothing import advice, usable
from ..schemas import TICK_ORDER
from .fold import Carry, Smoothing, count_between, each_row, enclose, last_row, last_row_of_windows, row_inputs, tabulate
from .skew import RUN, Edge, HotGroups, SkewPolicy, find_hot, may_be_hot, ordered_runs, run_edges, run_table
from .windows import BLOCK, WINDOW, WindowBlocks, duration_micros

#: Doubles that an average may start a run from, at most, for all of them to be folded.
MOST_STARTS = 512
#: The lowest start and the end for each double from there on.
Table = tuple[float, np.ndarray]


def running_averages(
    ticks: DataFrame,
    spans: Sequence[float] = (10, 100),
    zero_unset: bool = False,
    policy: SkewPolicy = SkewPolicy(),
) -> DataFrame:
    """Each tick with ``ema<span>`` of its symbol for every span.

    The average starts at the first price. Ticks without a finite price are
    left out and leave the average as it is.
    """
    return _smooth_rows(ticks, Smoothing(tuple(spans), zero_unset=zero_unset), policy)


def last_averages(
    ticks: DataFrame, spans: Sequence[float] = (10, 100), zero_unset: bool = False, policy: SkewPolicy = SkewPolicy()
) -> DataFrame:
    """symbol, event_time and the averages after the last tick of each symbol: what a stream may go on from."""
    names = [f"ema{span}" for span in spans]
    rows = running_averages(ticks.select("symbol", "event_time", "seq", "close"), spans, zero_unset, policy)
    last = F.max(F.struct(*TICK_ORDER, *names)).alias("_last")
    return rows.groupBy("symbol").agg(last).select("symbol", "_last.event_time", *[f"_last.{name}" for name in names])


def adaptive_average(ticks: DataFrame, policy: SkewPolicy = SkewPolicy()) -> DataFrame:
    """Each tick with ``ema``, whose weight depends on the time since the last.

    The weight is 2 / (w + 1), w being the number of characters of the gap
    written in seconds (``60.0`` has 4), whole days left out. The first price
    is the first average.
    """
    return _smooth_rows(ticks, Smoothing((), seed_step=False), policy)


def tick_advice(
    ticks: DataFrame,
    spans: tuple[float, float] = (10, 100),
    zero_unset: bool = False,
    eps: float = 0.0,
    stamp: str = "event",
    policy: SkewPolicy = SkewPolicy(),
    expire_after: str | None = None,
) -> DataFrame:
    """Buy, Sell or Stay for each tick, from the crossing of two averages.

    With ``zero_unset`` an average of zero counts as not set: it starts again
    at the next price, and ticks that leave the fast average at zero are not
    reported. ``expire_after``: a symbol silent for that long in event time starts again.
    """
    smoothing = Smoothing(tuple(spans), zero_unset=zero_unset, expire=expire_after and duration_micros(expire_after))
    needed = ticks.select("symbol", "event_time", "seq", "close")
    averaged = _smooth_rows(needed, smoothing, policy, with_before=True)
    fast, slow = (F.col(f"ema{span}") for span in spans)
    fast_before, slow_before = (F.col(f"ema{span}_before") for span in spans)
    if zero_unset:
        averaged = averaged.filter((fast != 0) & slow.isNotNull())
    return averaged.select(
        "symbol",
        emission_stamp(stamp, F.col("event_time")).alias("timestamp"),
        "seq",
        fast,
        slow,
        advice(fast, slow, fast_before, slow_before, eps).alias("advise"),
    )


def window_averages(
    ticks: DataFrame,
    size: str,
    slide: str | None = None,
    spans: Sequence[float] = (10, 100),
    policy: SkewPolicy = SkewPolicy(),
) -> DataFrame:
    """The averages of each (symbol, window), started anew in every window.

    Rows are spread over tasks by symbol and block of windows and folded as
    they stream by; no window is collected.
    """
    smoothing = Smoothing(tuple(spans), seed_step=False)
    windows = WindowBlocks.of(size, slide)
    source = _priced(ticks).select("symbol", *TICK_ORDER, "close")
    placed, group, block = windows.place(source), ("symbol", WINDOW), ("symbol", BLOCK)
    schema = StructType(
        [source.schema["symbol"], StructField(WINDOW, LongType()), *_doubles(smoothing.names)]
    )

    hot = _hot_blocks(source, placed, block, policy) if may_be_hot(ticks, policy) else None
    cold = placed if hot is None else hot.without(placed)
    result = _by_group(cold, block).drop("seq").mapInArrow(last_row_of_windows(smoothing, windows), schema)
    if hot is not None:
        rows = windows.unfold(hot.only(placed)).drop(BLOCK)
        runs = ordered_runs(rows, group, TICK_ORDER, hot.rows * windows.per_size, policy)
        limits = _limits(hot, smoothing)
        carry, unfinished = _carries(
            runs, run_edges(runs, group, TICK_ORDER), group, smoothing, lambda g: limits[g[0], windows.block_of(g[1])]
        )
        task = last_row(smoothing, group, group, carry, unfinished)
        result = result.unionByName(runs.select(*row_inputs(smoothing, group, True)).mapInArrow(task, schema))
    return result.select(
        "symbol",
        F.timestamp_micros(WINDOW).alias("window_start"),
        F.timestamp_micros(F.col(WINDOW) + windows.size).alias("window_end"),
        *smoothing.names,
    )


def window_advice(
    ticks: DataFrame,
    size: str,
    slide: str | None = None,
    spans: tuple[float, float] = (10, 100),
    eps: float = 0.0,
    stamp: str = "event",
    policy: SkewPolicy = SkewPolicy(),
) -> DataFrame:
    """Advice per window against the window before it of the same symbol.

    The first window of a symbol has none before it and gives no row. The
    second shuffle moves one row per window, not ticks; the rows of one symbol
    are then at most the windows in the time covered.
    """
    averaged = window_averages(ticks, size, slide, spans, policy)
    before = Window.partitionBy("symbol").orderBy("window_end")
    fast, slow = (F.col(f"ema{span}") for span in spans)
    seen = averaged.withColumns(
        {"_fast_before": F.lag(fast).over(before), "_slow_before": F.lag(slow).over(before)}
    ).filter(F.col("_fast_before").isNotNull())
    return seen.select(
        "symbol",
        "window_start",
        "window_end",
        emission_stamp(stamp, F.col("window_end")).alias("timestamp"),
        fast,
        slow,
        advice(fast, slow, F.col("_fast_before"), F.col("_slow_before"), eps).alias("advise"),
    )


def _priced(ticks: DataFrame) -> DataFrame:
    return ticks.filter(usable(F.col("event_time"), F.col("close")))


def _by_group(df: DataFrame, group: Sequence[str]) -> DataFrame:
    return df.repartition(*group).sortWithinPartitions(*group, *TICK_ORDER)


def _doubles(names: Sequence[str]) -> list[StructField]:
    return [StructField(name, DoubleType()) for name in names]


def _smooth_rows(
    ticks: DataFrame, smoothing: Smoothing, policy: SkewPolicy, with_before: bool = False
) -> DataFrame:
    priced, group = _priced(ticks), ("symbol",)
    added = [*smoothing.names, *(smoothing.names_before if with_before else [])]

    def averaged(df: DataFrame, carry: dict[int, Carry] | None = None) -> DataFrame:
        inputs = row_inputs(smoothing, group, carry is not None)
        averages = each_row(smoothing, group, carry, with_before)(*inputs)
        return df.withColumn("_ema", averages).select(*ticks.columns, *[f"_ema.{name}" for name in added])

    hot = None
    if may_be_hot(ticks, policy):
        hot = find_hot(priced, group, policy, low=F.min("close"), high=F.max("close"))
    result = averaged(_by_group(priced if hot is None else hot.without(priced), group))
    if hot is not None:
        runs = ordered_runs(hot.only(priced), group, TICK_ORDER, hot.rows, policy)
        limits = _limits(hot, smoothing)
        carry, _ = _carries(runs, run_edges(runs, group, TICK_ORDER), group, smoothing, limits.__getitem__)
        result = result.unionByName(averaged(runs, carry))
    return result


def _hot_blocks(source: DataFrame, placed: DataFrame, block: Sequence[str], policy: SkewPolicy) -> HotGroups | None:
    """A block can only be hot if its symbol is, so symbols are counted first."""
    symbols = find_hot(source, ("symbol",), policy)
    if symbols is None:
        return None
    return find_hot(symbols.only(placed), block, policy, low=F.min("close"), high=F.max("close"))


def _limits(hot: HotGroups, smoothing: Smoothing) -> dict[tuple, tuple[float, float]]:
    """Per hot group, bounds that no average of its prices can leave.

    Rounding may take an average past the lowest or highest price: all steps
    together by at most the error of one divided by the weight of a price.
    """
    limits = {}
    for row in hot.found:
        slack = 16 * 2.0**-52 / smoothing.least_weight * max(abs(row["low"]), abs(row["high"]))
        limits[tuple(row[name] for name in hot.group)] = (row["low"] - slack, row["high"] + slack)
    return limits


def _carries(
    runs: DataFrame,
    edges: list[Edge],
    group: Sequence[str],
    smoothing: Smoothing,
    limits: Callable[[tuple], tuple[float, float]],
) -> tuple[dict[int, Carry], frozenset[int]]:
    """What each run goes on from, exactly, and which runs are gone on from.

    A run inside a hot group does not know the average it starts from, only
    that it lies within the group's limits. All runs are folded from both bounds at once; old prices fade, so
    after a few thousand rows the two are the same number. Under flat prices they
    stay apart, but stop a few doubles from each other. The run after is then folded from
    every double between them, which gives a table of starts and ends; the tables of a
    group, one after the other, tell all averages from the first. A run whose start is still open is
    folded again from the bounds its predecessor ended with, until all are settled; each
    round settles at least the next run of a group.
    """
    before = {now.run: last for last, now in zip(edges, edges[1:]) if last.last_group == now.first_group}
    unfinished = frozenset(edge.run for edge in before.values())
    last_groups = {edge.run: edge.last_group for edge in edges}

    starts: dict[int, tuple] = {}
    for edge in edges:
        if edge.run in before and edge.first_group == edge.last_group:
            low, high = limits(edge.first_group)
            starts[edge.run] = ((low,) * smoothing.width, (high,) * smoothing.width)
    settled: dict[int, tuple] = {}
    ends: dict[int, tuple] = {}
    tables: dict[int, list[Table]] = {}
    pending = set(unfinished)
    while pending:
        found = _fold_bounds(runs, pending, starts, before, group, smoothing)
        for run, (certain, low, high) in found.items():
            if not certain:
                low, high = ((limit,) * smoothing.width for limit in limits(last_groups[run]))
            ends[run] = (low, high)
            if low == high:
                settled[run] = low
        progress = len(pending)
        pending -= settled.keys()
        few = {run: ends[before[run].run] for run in pending - tables.keys() if _are_few(ends[before[run].run])}
        if few:
            tables |= _fold_tables(runs, few, before, group, smoothing)
        for run in sorted(pending & tables.keys()):  # in the order of their groups
            start = settled.get(before[run].run)
            if start is not None:
                settled[run] = tuple(map(_looked_up, tables[run], start))
                ends[run] = (settled[run], settled[run])
        pending -= settled.keys()
        if len(pending) == progress:
            raise RuntimeError("a round has settled no run, though prices are finite")
        for run in pending:
            starts[run] = ends[before[run].run]

    carry = {run: Carry(settled[last.run], last.last_micros) for run, last in before.items()}
    return carry, unfinished


def _fold_bounds(runs, pending, starts, before, group, smoothing) -> dict[int, tuple]:
    """One job over the pending runs; at most one small row comes back per run."""
    width = smoothing.width

    def carries(side: int) -> dict[int, Carry]:
        return {
            run: Carry(starts[run][side], before[run].last_micros) for run in pending if run in starts
        }

    bounds = [StructField(f"{side}{i}", DoubleType()) for side in ("low", "high") for i in range(width)]
    schema = StructType([StructField(RUN, LongType()), StructField("certain", BooleanType()), *bounds])
    wanted = F.broadcast(run_table(runs, {run: () for run in pending}, []))
    rows = (
        runs.join(wanted, RUN, "left_semi")
        .select(*row_inputs(smoothing, group, True))
        .mapInArrow(enclose(smoothing, group, carries(0), carries(1)), schema)
        .collect()
    )
    return {row[RUN]: (row["certain"], tuple(row)[2 : 2 + width], tuple(row)[2 + width :]) for row in rows}


def _are_few(bounds: tuple[tuple, tuple]) -> bool:
    """Whether few doubles lie between the bounds of each average."""
    return all(count_between(low, high) <= MOST_STARTS for low, high in zip(*bounds))


def _looked_up(table: Table, start: float) -> float:
    low, ends = table
    return float(ends[count_between(low, start) - 1])


def _fold_tables(runs, bounds: dict[int, tuple], before, group, smoothing) -> dict[int, list[Table]]:
    """One job over the runs named: per average a table from each possible start to the end.

    At most ``MOST_STARTS`` doubles come back per run and average.
    """
    wanted = F.broadcast(run_table(runs, {run: () for run in bounds}, []))
    task = tabulate(smoothing, bounds, {run: before[run].last_micros for run in bounds})
    rows = runs.join(wanted, RUN, "left_semi").select(*row_inputs(smoothing, group, True))
    tables: dict[int, list[Table]] = {run: [(0.0, np.empty(0))] * smoothing.width for run in bounds}
    for row in rows.mapInArrow(task, f"{RUN} long, average int, ends binary").collect():
        i = row["average"]
        tables[row[RUN]][i] = (bounds[row[RUN]][0][i], np.frombuffer(bytes(row["ends"])))
    return tables
