"""Places of rows in a global order, found without putting any group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settle

#: The low bits of ``monotonically_increasing_id`` count the rows of a task.
TASK_BITS = 33
PART, AT = "_part", "_at"


def numbered(df: DataFrame, part: str = PART, at: str = AT) -> DataFrame:
    """``df`` with its task's number and each row's place in the task. To be written, as a new run may deal rows out anew."""
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << TASK_BITS) - 1))
    return df.withColumns({part: F.spark_partition_id(), at: within})


def placed(df: DataFrame, group: str, order: Sequence[str], purpose: str, place: str = "pos", size: str = "n") -> DataFrame:
    """``df`` with each row's place from 0 in its group by ``order`` (nulls first), and the group's size.

    Rows are range-partitioned by group and order, so a large group covers many tasks, and
    written; the tasks' row counts per group are then summed up. There is at most one count per
    task and one per group. ``order`` should tell all rows of a group apart, else equal rows
    share a task.
    """
    keys = [group, *order]
    rows = settle(numbered(df.repartitionByRange(*keys).sortWithinPartitions(*keys)), purpose)
    spans = rows.groupBy(PART, group).agg(F.min(AT).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(group).orderBy(PART)
    whole = Window.partitionBy(group)
    spans = spans.withColumn("_base", F.sum("_rows").over(before) - F.col("_rows")).withColumn(size, F.sum("_rows").over(whole))
    # A written table tells its size, by which Spark chooses how to join.
    spans = settle(spans.drop("_rows"), f"{purpose}-spans")
    joined = rows.join(spans, [PART, group])
    return joined.withColumn(place, F.col(AT) - F.col("_first") + F.col("_base")).drop(PART, AT, "_first", "_base")
