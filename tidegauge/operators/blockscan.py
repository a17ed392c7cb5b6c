"""Averages by a block scan, inside the JVM, for values rather than advice.

An average is a weighted sum of all prices so far. Scaled by d**-k (d is the
weight kept per step) the sum becomes a plain running total, which Spark's
window functions compute. The scale would overflow in a long group, so it
starts again in every block; a block is long enough (d**block <= e**-300) that
what comes before the block before it is far below a double's precision.
Results differ from the sequential fold by rounding, about 1e-13 relative.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField

from ..functions.smoothing import alpha, usable
from ..schemas import TICK_ORDER
from .skew import RUN, Edge, SkewPolicy, find_hot, may_be_hot, ordered_runs, run_edges, run_table

EXPONENT = 300.0


def block_average(ticks: DataFrame, spans: float | Sequence[float], policy: SkewPolicy = SkewPolicy()) -> DataFrame:
    """Each tick with ``ema<span>`` of its symbol for every span, started at the first price.

    All spans share one shuffle, one search for hot symbols and one cut into runs.
    """
    spans = tuple(spans) if isinstance(spans, Sequence) else (spans,)
    known = ticks.filter(usable(F.col("event_time"), F.col("close")))
    hot = find_hot(known, ("symbol",), policy) if may_be_hot(ticks, policy) else None
    result = known if hot is None else hot.without(known)
    for span in spans:
        result = _scan(result, ["symbol"], span, F.lit(None).cast("double"), f"ema{span}")
    if hot is not None:
        runs = ordered_runs(hot.only(known), ("symbol",), TICK_ORDER, hot.rows, policy)
        rows = _with_carries(runs, run_edges(runs, ("symbol",), TICK_ORDER), spans)
        for index, span in enumerate(spans):
            rows = _scan(rows, [RUN, "symbol"], span, F.col(_carry(index)), f"ema{span}").drop(_carry(index))
        result = result.unionByName(rows.drop(RUN))
    return result


def _carry(index: int) -> str:
    return f"_carry{index}"


def _scan(df: DataFrame, place: list[str], span: float, carry: Column, name: str) -> DataFrame:
    """The scan within each place; ``carry`` is the average before it or null."""
    weight = alpha(span)
    if weight == 1:
        return df.withColumn(name, F.col("close"))
    keep = 1 - weight
    block = max(1, math.floor(EXPONENT / -math.log(keep)))
    ordered = Window.partitionBy(*place).orderBy(*TICK_ORDER)
    in_block = Window.partitionBy(*place, "_block").orderBy(*TICK_ORDER)
    so_far = in_block.rowsBetween(Window.unboundedPreceding, 0)
    earlier = ordered.rowsBetween(Window.unboundedPreceding, -1)
    position = (F.row_number().over(ordered) - 1).cast("bigint")
    at = F.col("_at").cast("double")
    scaled = F.sum(F.lit(weight) * F.col("close") * F.pow(F.lit(keep), -at)).over(so_far)
    block_end = F.when(F.col("_at") == block - 1, F.col("_local"))
    start = F.coalesce(
        F.last(block_end, ignorenulls=True).over(earlier),
        carry,
        F.first("close").over(ordered.rowsBetween(Window.unboundedPreceding, 0)),
    )
    return (
        df.withColumn("_position", position)
        .withColumns({"_block": F.floor(F.col("_position") / block), "_at": F.col("_position") % block})
        .withColumn("_local", scaled * F.pow(F.lit(keep), at))
        .withColumn(name, F.col("_local") + F.pow(F.lit(keep), at + 1) * start)
        .drop("_position", "_block", "_at", "_local")
    )


def _with_carries(runs: DataFrame, edges: list[Edge], spans: Sequence[float]) -> DataFrame:
    """Rows of runs with the averages before the run, null where a symbol starts.

    Only the last row of a run matters to the next, and the fold over them has
    as many steps as there are runs.
    """
    continued = {now.run: last.run for last, now in zip(edges, edges[1:]) if last.last_group == now.first_group}
    ends, names = runs, [f"_end{index}" for index in range(len(spans))]
    for name, span in zip(names, spans):
        ends = _scan(ends, [RUN, "symbol"], span, F.lit(0.0), name)
    per_run = ends.groupBy(RUN).agg(
        F.max_by(F.struct("symbol", *names), F.struct("symbol", *TICK_ORDER)).alias("last"),
    )
    sizes = runs.groupBy(RUN, "symbol").agg(
        F.count(F.lit(1)).alias("rows"), F.min_by("close", F.struct(*TICK_ORDER)).alias("first")
    )
    tail = {
        row[RUN]: (row.last[1:], row.rows, row.first)
        for row in per_run.join(sizes, [RUN]).filter(F.col("last.symbol").eqNullSafe(F.col("symbol"))).collect()
    }
    kept, averages = [1 - alpha(span) for span in spans], {}
    groups = {edge.run: edge for edge in edges}
    for run in sorted(tail):
        ends_here, rows, first = tail[run]
        whole = groups[run].first_group == groups[run].last_group
        before = averages[continued[run]] if run in continued and whole else [first] * len(spans)
        averages[run] = [end + keep**rows * start for end, keep, start in zip(ends_here, kept, before)]
    opening = {run: (*groups[run].first_group, *averages[last]) for run, last in continued.items()}
    carried = [StructField(_carry(index), DoubleType()) for index in range(len(spans))]
    fields = [StructField("_symbol", runs.schema["symbol"].dataType), *carried]
    carries = run_table(runs, opening, fields).withColumnRenamed(RUN, "_of")
    matched = (runs[RUN] == F.col("_of")) & runs["symbol"].eqNullSafe(F.col("_symbol"))
    return runs.join(F.broadcast(carries), matched, "left").drop("_of", "_symbol")
