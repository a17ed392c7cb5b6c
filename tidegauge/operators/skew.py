"""Finding hot groups and cutting them into runs.

A fold over the ordered rows of a group needs them in order, so by default a
group is one task's work. A group that holds a large share of all rows would
hold up the whole job; such groups are range-partitioned by (group, order)
instead, which spreads one group over many partitions called runs.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import shared_folder

RUN = "_run"
ROWS = "_rows"


@dataclass(frozen=True)
class SkewPolicy:
    """Sizes, in rows, that decide when and how a group is cut.

    At most ``max_hot`` groups are treated as hot. They are the largest ones,
    so any other group has under 1/``max_hot`` of all rows or under
    ``hot_rows``. Both lists the driver sees, hot groups and runs, are bounded
    by ``max_hot`` and ``max_runs`` whatever the data; no row is left out.
    """

    hot_rows: int = 10_000_000
    max_hot: int = 10_000
    run_rows: int = 4_000_000
    max_runs: int = 20_000

    def runs_for(self, rows: int) -> int:
        return max(1, min(self.max_runs, math.ceil(rows / self.run_rows)))


@dataclass(frozen=True)
class HotGroups:
    """The groups over the limit: a local table of at most ``max_hot`` rows."""

    table: DataFrame
    group: tuple[str, ...]
    found: list[Row]

    @property
    def rows(self) -> int:
        return sum(row[ROWS] for row in self.found)

    def _renamed(self) -> DataFrame:
        return self.table.select(
            *[F.col(name).alias(f"_hot_{name}") for name in self.group],
            *[name for name in self.table.columns if name not in self.group],
        )

    def _condition(self, df: DataFrame) -> Column:
        return reduce(lambda a, b: a & b, [df[name].eqNullSafe(F.col(f"_hot_{name}")) for name in self.group])

    def without(self, df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(self._renamed()), self._condition(df), "left_anti")

    def only(self, df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(self._renamed()), self._condition(df), "left_semi")

    def attach(self, df: DataFrame, *stats: str) -> DataFrame:
        """Rows of hot groups with the named statistics of their group."""
        joined = df.join(F.broadcast(self._renamed()), self._condition(df))
        return joined.select(*[df[name] for name in df.columns], *stats)


def may_be_hot(table: DataFrame, policy: SkewPolicy) -> bool:
    """False where the whole table has too few rows for a hot group.

    Needs no column, so files are only asked for their row counts.
    """
    return table.count() > policy.hot_rows


def find_hot(df: DataFrame, group: Sequence[str], policy: SkewPolicy, **stats: Column) -> HotGroups | None:
    """Groups of ``df`` with more than ``policy.hot_rows`` rows, largest first.

    One aggregate with map-side combining over the group columns; the usual
    answer is None.
    """
    counted = df.groupBy(*group).agg(
        F.count(F.lit(1)).alias(ROWS), *[column.alias(name) for name, column in stats.items()]
    )
    largest = counted.filter(F.col(ROWS) > policy.hot_rows).orderBy(F.desc(ROWS)).limit(policy.max_hot)
    found = largest.collect()
    if not found:
        return None
    table = df.sparkSession.createDataFrame(found, counted.schema)
    return HotGroups(table, tuple(group), found)


def ordered_runs(df: DataFrame, group: Sequence[str], order: Sequence[str], rows: int, policy: SkewPolicy) -> DataFrame:
    """Rows sorted by (group, order) over all partitions, numbered in ``_run``.

    Several passes read the result and must see the same cuts, so it is
    checkpointed: range bounds come from a sample and may differ when a plan
    is run again. Run numbers rise with (group, order).
    """
    shared_folder(df.sparkSession)
    cut = df.repartitionByRange(policy.runs_for(rows), *group, *order).sortWithinPartitions(*group, *order)
    return cut.withColumn(RUN, F.spark_partition_id()).checkpoint()


@dataclass(frozen=True)
class Edge:
    """First and last group of a run, and the event time of its last row."""

    run: int
    first_group: tuple
    last_group: tuple
    last_micros: int


def run_edges(runs: DataFrame, group: Sequence[str], order: Sequence[str]) -> list[Edge]:
    """One entry per non-empty run, at most ``max_runs``."""
    last = F.max(F.struct(*group, *order))
    rows = runs.groupBy(RUN).agg(F.min(F.struct(*group)).alias("first"), last.alias("last"))
    rows = rows.withColumn("micros", F.unix_micros(f"last.{order[0]}")).collect()
    edges = [Edge(r[RUN], tuple(r["first"]), tuple(r["last"])[: len(group)], r["micros"]) for r in rows]
    return sorted(edges, key=lambda edge: edge.run)


def run_table(df: DataFrame, values: dict[int, tuple], fields: Sequence[StructField]) -> DataFrame:
    """A local table from run numbers to values, at most ``max_runs`` rows."""
    schema = StructType([StructField(RUN, LongType()), *fields])
    return df.sparkSession.createDataFrame([(run, *row) for run, row in values.items()], schema)
