"""The sequential fold over sorted rows, for use inside Arrow tasks.

Rows arrive sorted by group and order. A batch is folded in one sweep: the
first row of a group gets weight 0 on whatever came before it, so group
borders need no loop of their own. Memory is one batch, however long a group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import DoubleType, StructField, StructType

from ..functions.smoothing import alpha
from .skew import RUN
from .windows import BLOCK, WINDOW, WindowBlocks

DAY_MICROS = 86_400_000_000


def gap_width(micros: np.ndarray) -> np.ndarray:
    """Length of a gap in seconds written as a decimal float, days left out.

    60 s is ``60.0``, four characters. Under 0.0001 s the shortest form has
    an exponent: ``1e-06`` has five characters, ``1.2e-05`` seven.
    """
    micros = np.mod(micros, DAY_MICROS)
    whole, part = micros // 1_000_000, micros % 1_000_000
    whole_digits = 1 + sum((whole >= 10**k).astype(np.int64) for k in range(1, 5))
    trailing = sum((part % 10**k == 0).astype(np.int64) for k in range(1, 6))
    width = whole_digits + 1 + np.where(part == 0, 1, 6 - trailing)
    tiny = (micros > 0) & (micros < 100)
    return np.where(tiny, np.where((micros < 10) | (micros % 10 == 0), 5, 7), width)


def gap_weight(micros: np.ndarray) -> np.ndarray:
    return 2 / (gap_width(micros) + 1)


@dataclass(frozen=True)
class Smoothing:
    """Which averages to keep.

    ``spans`` empty: one average whose weight follows the time between ticks.
    ``seed_step``: the first price takes a smoothing step against itself, as
    every later one does; otherwise it is the first average as it stands.
    ``zero_unset``: an average of exactly zero counts as not yet set.
    ``expire``: after a gap of that many microseconds or more, averages start again.
    """

    spans: tuple[float, ...] = (10, 100)
    seed_step: bool = True
    zero_unset: bool = False
    expire: int | None = None

    def __post_init__(self):
        if self.zero_unset and self.expire is not None:
            raise ValueError("averages that expire cannot count zero as not set")

    @property
    def timed(self) -> bool:
        """Whether the fold needs the time of each tick."""
        return not self.spans or self.expire is not None

    @property
    def width(self) -> int:
        return len(self.spans) or 1

    @property
    def names(self) -> list[str]:
        return [f"ema{span}" for span in self.spans] or ["ema"]

    @property
    def names_before(self) -> list[str]:
        return [f"{name}_before" for name in self.names]

    @property
    def least_weight(self) -> float:
        return min((alpha(span) for span in self.spans), default=2 / 13)


@dataclass(frozen=True)
class Carry:
    """Averages and time at the end of the run before."""

    states: tuple[float, ...]
    micros: int | None = None


def _sweep(steps: list[float], kept: list[float], y: float) -> list[float]:
    return [y := step + keep * y for step, keep in zip(steps, kept)]


def _sweep_zero_unset(steps, kept, prices, resets, y):
    """As ``_sweep``; ``resets`` holds a value to start from or None."""
    averages, before = [], []
    for step, keep, price, reset in zip(steps, kept, prices, resets):
        previous = (y if reset is None else reset) or price
        y = step + keep * previous
        averages.append(y)
        before.append(previous)
    return averages, before


def group_starts(batch: pa.RecordBatch, group: Sequence[str], tail: tuple | None) -> np.ndarray:
    """True where a row's group differs from that of the row before."""
    rows = batch.num_rows
    starts = np.zeros(rows, dtype=bool)
    for name in group:
        column = batch.column(name)
        now, before = column.slice(1), column.slice(0, rows - 1)
        differs = pc.fill_null(pc.not_equal(now, before), False)
        if column.null_count:
            differs = pc.or_(differs, pc.xor(pc.is_null(now), pc.is_null(before)))
        starts[1:] |= differs.to_numpy(zero_copy_only=False)
    starts[0] = tail is None or row_group(batch, group, 0) != tail
    return starts


def row_group(batch: pa.RecordBatch, group: Sequence[str], row: int) -> tuple:
    return tuple(batch.column(name)[row].as_py() for name in group)


def _micros(times: pa.Array) -> np.ndarray:
    return times.cast(pa.int64()).to_numpy(zero_copy_only=False)


class Fold:
    """Folds one batch after the other and remembers where it stands."""

    def __init__(self, smoothing: Smoothing, group: Sequence[str], carry: dict[int, Carry] | None = None):
        self.smoothing = smoothing
        self.group = [*group, RUN] if carry is not None else list(group)
        self.carry = carry or {}
        self.states = [0.0] * smoothing.width
        self.tail: tuple | None = None
        self.micros = 0

    def __call__(self, batch: pa.RecordBatch):
        """Row starts, then per average its values and the values before."""
        starts = group_starts(batch, self.group, self.tail)
        resumed = self._resumed(batch)
        price = batch.column("close").to_numpy(zero_copy_only=False)
        micros = _micros(batch.column("event_time")) if self.smoothing.timed else None
        self.tail = row_group(batch, self.group, batch.num_rows - 1)
        return starts, *self.advance(price, micros, starts, resumed)

    def follow(self, other: Fold) -> None:
        self.states, self.tail, self.micros = list(other.states), other.tail, other.micros

    def advance(self, price: np.ndarray, micros: np.ndarray | None, starts: np.ndarray, resumed: dict[int, Carry]):
        averages, before = [], []
        gaps = None
        if micros is not None:
            gaps = np.diff(micros, prepend=self.micros)
            for row, carry in resumed.items():
                gaps[row] = micros[row] - carry.micros
            self.micros = int(micros[-1])
        if self.smoothing.expire is not None:
            over = gaps >= self.smoothing.expire
            starts, resumed = starts | over, {row: carry for row, carry in resumed.items() if not over[row]}
        for index, weight in enumerate(self._weights(len(price), gaps)):
            seeds = {row: carry.states[index] for row, carry in resumed.items()}
            values, previous = self._one(price, weight, starts, seeds, self.states[index])
            self.states[index] = float(values[-1])
            averages.append(values)
            before.append(previous)
        return averages, before

    def _resumed(self, batch: pa.RecordBatch) -> dict[int, Carry]:
        """Rows that open a run and go on with the group of the run before."""
        if not self.carry:
            return {}
        runs = batch.column(RUN).to_numpy(zero_copy_only=False)
        opens = np.flatnonzero(np.diff(runs, prepend=-1 if self.tail is None else self.tail[-1]))
        return {int(row): self.carry[int(runs[row])] for row in opens if int(runs[row]) in self.carry}

    def _weights(self, rows: int, gaps: np.ndarray | None) -> list[np.ndarray]:
        if self.smoothing.spans:
            return [np.full(rows, alpha(span)) for span in self.smoothing.spans]
        return [gap_weight(gaps)]

    def _one(self, price, weight, starts, seeds: dict[int, float], state: float):
        steps, kept = weight * price, 1 - weight
        if self.smoothing.zero_unset:
            resets = [0.0 if start else None for start in starts.tolist()]
            for row, seed in seeds.items():
                resets[row] = seed
            values, previous = _sweep_zero_unset(steps.tolist(), kept.tolist(), price.tolist(), resets, state)
            return np.array(values), np.array(previous)
        seed = price.copy()
        for row, value in seeds.items():
            seed[row] = value
        opening = np.flatnonzero(starts)
        steps[opening] += kept[opening] * seed[opening]
        kept[opening] = 0.0
        if not self.smoothing.seed_step:
            fresh = np.array([row for row in opening if row not in seeds] if seeds else opening, dtype=np.int64)
            steps[fresh] = price[fresh]
        values = np.array(_sweep(steps.tolist(), kept.tolist(), state))
        previous = np.empty_like(values)
        previous[0], previous[1:] = state, values[:-1]
        previous[opening] = seed[opening]
        return values, previous


def each_row(
    smoothing: Smoothing, group: Sequence[str], carry: dict[int, Carry] | None = None, with_before: bool = False
) -> Callable[..., Column]:
    """A column function: the averages of each row of a sorted partition, as a struct.

    Only the columns it reads go to Python; the others wait in the JVM. It is
    declared non-deterministic because a value depends on the rows before it:
    so Spark neither drops the sort nor moves a filter below this column.
    """
    inputs = row_inputs(smoothing, group, carry is not None)
    names = [*smoothing.names, *(smoothing.names_before if with_before else [])]

    def averages_of(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        fold = Fold(smoothing, group, carry)
        for arrays in batches:
            if not len(arrays[0]):
                yield pa.StructArray.from_arrays([pa.array([], pa.float64())] * len(names), names=names)
                continue
            _, averages, before = fold(pa.RecordBatch.from_arrays(list(arrays), names=inputs))
            added = averages + before if with_before else averages
            yield pa.StructArray.from_arrays(list(map(pa.array, added)), names=names)

    result = StructType([StructField(name, DoubleType()) for name in names])
    return arrow_udf(averages_of, result).asNondeterministic()


def row_inputs(smoothing: Smoothing, group: Sequence[str], in_runs: bool) -> list[str]:
    timed = ["event_time"] if smoothing.timed else []
    return [*group, *([RUN] if in_runs else []), "close", *timed]


class LastRows:
    """The last row of every group with its averages, batch by batch.

    ``unfinished`` names the runs whose last group goes on in the next run.
    """

    def __init__(
        self,
        smoothing: Smoothing,
        group: Sequence[str],
        columns: Sequence[str],
        carry: dict[int, Carry] | None = None,
        unfinished: frozenset[int] = frozenset(),
    ):
        self.fold = Fold(smoothing, group, carry)
        self.columns = list(columns)
        self.names = [*columns, *smoothing.names]
        self.in_runs = carry is not None
        self.unfinished = unfinished
        self.pending: pa.RecordBatch | None = None

    def feed(self, batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        tail = self.fold.tail
        starts, averages, _ = self.fold(batch)
        result = pa.RecordBatch.from_arrays(
            [*[batch.column(name) for name in self.columns], *map(pa.array, averages)], names=self.names
        )
        if starts[0]:
            yield from self._release(tail)
        ends = np.flatnonzero(starts[1:])
        if self.in_runs and len(ends):
            ends = ends[_closes(batch, ends, self.unfinished)]
        if len(ends):
            yield result.take(pa.array(ends))
        self.pending = result.slice(batch.num_rows - 1)

    def finish(self) -> Iterator[pa.RecordBatch]:
        yield from self._release(self.fold.tail)

    def _release(self, tail: tuple | None) -> Iterator[pa.RecordBatch]:
        if self.pending is not None and not (self.in_runs and tail[-1] in self.unfinished):
            yield self.pending
        self.pending = None


def last_row(
    smoothing: Smoothing,
    group: Sequence[str],
    columns: Sequence[str],
    carry: dict[int, Carry] | None = None,
    unfinished: frozenset[int] = frozenset(),
):
    """Task function: the last row of every group with its averages."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = LastRows(smoothing, group, columns, carry, unfinished)
        for batch in batches:
            if batch.num_rows:
                yield from last.feed(batch)
        yield from last.finish()

    return task


def last_row_of_windows(smoothing: Smoothing, windows: WindowBlocks):
    """Task function: the last row of every (symbol, window) with its averages.

    Rows come sorted by (symbol, block, event time). Sliding windows overlap,
    but every ``per_size``-th of them do not: those are groups of adjacent rows
    as they stand, so rows are swept once per such series and never copied.
    """

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = ["symbol", WINDOW]
        series = [LastRows(smoothing, group, group) for _ in range(windows.per_size)]
        for batch in batches:
            if not batch.num_rows:
                continue
            micros, block = _micros(batch.column("event_time")), batch.column(BLOCK).to_numpy()
            pane = micros // windows.slide
            for index, last in enumerate(series):
                window = pane - (pane - index) % windows.per_size
                inside = (window // windows.per_block == block) & (micros < window * windows.slide + windows.size)
                if not inside.any():
                    continue
                rows = pa.RecordBatch.from_arrays(
                    [batch.column("symbol"), pa.array(window * windows.slide), batch.column("close")],
                    names=[*group, "close"],
                )
                yield from last.feed(rows if inside.all() else rows.filter(pa.array(inside)))
        for last in series:
            yield from last.finish()

    return task


def _closes(batch: pa.RecordBatch, ends: np.ndarray, unfinished: frozenset[int]) -> np.ndarray:
    """Which of the rows ``ends`` really end a group, not only a run of it."""
    runs = batch.column(RUN).to_numpy(zero_copy_only=False)
    cut_off = (runs[ends] != runs[ends + 1]) & np.isin(runs[ends], list(unfinished))
    return ~cut_off


def enclose(smoothing: Smoothing, group: Sequence[str], low: dict[int, Carry], high: dict[int, Carry]):
    """Task function: bounds of the averages at the end of each run.

    A smoothing step never reverses the order of two averages, not even when
    rounded. So if the average before the run lies between two bounds, the one
    after it lies between what the fold makes of them; once both are the same
    number, that number is the average, to the last bit.

    With ``zero_unset`` the order can be reversed at zero; ``certain`` is then
    false for a run whose bounds enclose zero.
    """
    width = smoothing.width
    names = [RUN, "certain", *[f"low{i}" for i in range(width)], *[f"high{i}" for i in range(width)]]

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lower, upper = Fold(smoothing, group, low), Fold(smoothing, group, high)
        ends: dict[int, tuple] = {}
        doubtful: set[int] = set()
        for batch in batches:
            if not batch.num_rows:
                continue
            runs = batch.column(RUN).to_numpy(zero_copy_only=False)
            met = bool(ends) and lower.states == upper.states
            if met and (runs == lower.tail[-1]).all():
                _, lows, lows_before = lower(batch)
                upper.follow(lower)
                highs, highs_before = lows, lows_before
            else:
                _, lows, lows_before = lower(batch)
                _, highs, highs_before = upper(batch)
            for row in np.flatnonzero(np.diff(runs, append=-1)):
                ends[int(runs[row])] = tuple(float(v[row]) for v in (*lows, *highs))
            if smoothing.zero_unset:
                for a, b in zip(lows_before, highs_before):
                    doubtful.update(runs[(a != b) & (a <= 0) & (b >= 0)].tolist())
        if ends:
            rows = [(run, run not in doubtful, *values) for run, values in ends.items()]
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in zip(*rows)], names=names)

    return task


def _rank(value: float) -> int:
    """Place of a double among all doubles in their order; -0.0 comes right before 0.0."""
    bits = int(np.float64(value).view(np.int64))
    return bits if bits >= 0 else bits ^ 0x7FFF_FFFF_FFFF_FFFF


def count_between(low: float, high: float) -> int:
    return _rank(high) - _rank(low) + 1


def doubles_between(low: float, high: float) -> np.ndarray:
    """All doubles from ``low`` to ``high``, in order."""
    ranks = np.arange(_rank(low), _rank(high) + 1, dtype=np.int64)
    return np.where(ranks >= 0, ranks, ranks ^ 0x7FFF_FFFF_FFFF_FFFF).view(np.float64)


def _advance_all(y: np.ndarray, weight: np.ndarray, price: np.ndarray, zero_unset: bool) -> np.ndarray:
    """Many averages taken through the same prices, each step rounded as in :class:`Fold`.

    Neighbouring steps that are alike are taken until nothing changes, so flat prices take a step or a few.
    """
    steps, kept = weight * price, 1 - weight
    alike = (np.diff(steps) == 0) & (np.diff(kept) == 0) & (np.diff(price) == 0)
    cuts = np.concatenate([[0], np.flatnonzero(~alike) + 1, [len(price)]])
    for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
        step, keep, seed = steps[a], kept[a], price[a]
        for _ in range(b - a):
            after = step + keep * (np.where(y == 0, seed, y) if zero_unset else y)
            if (after == y).all():
                break
            y = after
    return y


def tabulate(smoothing: Smoothing, bounds: dict[int, tuple[tuple, tuple]], last: dict[int, int]):
    """Task function: what each average of a run becomes, for every double it may start from.

    ``bounds`` has for runs within one group the lowest and highest start of each average, ``last`` the time of
    the row before. One row per run and average: its number and the ends, in the order of the starts.
    """

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[int, list[np.ndarray]] = {}
        times = dict(last)
        for batch in batches:
            if not batch.num_rows:
                continue
            runs = batch.column(RUN).to_numpy(zero_copy_only=False)
            price = batch.column("close").to_numpy(zero_copy_only=False)
            micros = None if smoothing.spans else _micros(batch.column("event_time"))
            cuts = np.append(np.flatnonzero(np.diff(runs, prepend=-1)), len(runs))
            for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
                run = int(runs[a])
                if run not in states:
                    states[run] = [doubles_between(low, high) for low, high in zip(*bounds[run])]
                if smoothing.spans:
                    weights = [np.full(b - a, alpha(span)) for span in smoothing.spans]
                else:
                    weights = [gap_weight(np.diff(micros[a:b], prepend=times[run]))]
                    times[run] = int(micros[b - 1])
                states[run] = [_advance_all(y, w, price[a:b], smoothing.zero_unset) for y, w in zip(states[run], weights)]
        rows = [(run, i, y.tobytes()) for run, ys in states.items() for i, y in enumerate(ys)]
        if rows:
            kinds = (pa.int64(), pa.int32(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=[RUN, "average", "ends"])

    return task
