"""Where results go: Kafka, files, JDBC tables, the console, several at once.

All are at-least-once at the target: after a restart a micro-batch may be
written again. Files are the exception, their log keeps each batch once.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..functions.codec import encode_json
from ..sources.kafka import DEFAULT_BROKERS

BatchWriter = Callable[[DataFrame, int], None]


def to_kafka_value(df: DataFrame, epoch: Sequence[str] = (), unit: str = "s", columns: Sequence[str] = ()) -> DataFrame:
    """Rows as the column ``value``: one JSON object of the given columns each.

    Timestamps named in ``epoch`` are written as whole seconds or, with
    ``unit`` ``ms``, milliseconds since 1970; others as ISO text.
    """
    number = {"s": F.unix_seconds, "ms": F.unix_millis}[unit]
    fields = [number(F.col(name)).alias(name) if name in epoch else F.col(name) for name in columns or df.columns]
    return df.select(encode_json(*fields).alias("value"))


def kafka_writer_options(brokers: str = DEFAULT_BROKERS, topic: str = "ema") -> dict[str, str]:
    return {"kafka.bootstrap.servers": brokers, "topic": topic}


def write_kafka(values: DataFrame, checkpoint: str, brokers: str = DEFAULT_BROKERS, topic: str = "ema") -> StreamingQuery:
    """Start a query that appends ``value`` rows to a topic."""
    writer = values.writeStream.format("kafka").options(**kafka_writer_options(brokers, topic))
    return writer.option("checkpointLocation", checkpoint).outputMode("append").start()


def write_files(
    df: DataFrame, path: str, checkpoint: str, once: bool = False, format: str = "parquet", every: str = "1 second"
) -> StreamingQuery:
    """Start a query that appends files; with ``once`` it ends when caught up."""
    writer = df.writeStream.format(format).option("checkpointLocation", checkpoint).outputMode("append")
    trigger = {"availableNow": True} if once else {"processingTime": every}
    return writer.trigger(**trigger).start(path)


def print_rows(df: DataFrame, rows: int = 2**31 - 1, mode: str = "append") -> StreamingQuery:
    """Start a query that prints each micro-batch, or its first ``rows`` rows."""
    return df.writeStream.format("console").option("numRows", rows).option("truncate", False).outputMode(mode).start()


def changelog(df: DataFrame, write: BatchWriter, checkpoint: str, early: bool = False) -> StreamingQuery:
    """Start a query that hands on row changes.

    Results of windows are final when they appear, so all changes are inserts.
    With ``early`` open windows are handed on too, whenever they change; rows
    of the same key then replace each other.
    """
    return (
        df.writeStream.outputMode("update" if early else "append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
        .start()
    )


@dataclass(frozen=True)
class JdbcTarget:
    """A table to append to. ``connections`` bounds the writers at one time.

    ``batch_column`` names a column for the number of the micro-batch, by
    which rows written twice after a restart can be told.
    """

    url: str
    table: str
    properties: dict[str, str] = field(default_factory=dict)
    batch_rows: int = 20
    retries: int = 5
    pause_seconds: float = 1.0
    connections: int = 8
    batch_column: str | None = None

    def options(self) -> dict[str, str]:
        return {
            **self.properties,
            "url": self.url,
            "dbtable": self.table,
            "batchsize": str(self.batch_rows),
            "numPartitions": str(self.connections),
        }


def append_table(df: DataFrame, options: dict[str, str]) -> None:
    df.write.format("jdbc").options(**options).mode("append").save()


def write_jdbc(target: JdbcTarget, append: Callable[[DataFrame, dict[str, str]], None] = append_table) -> BatchWriter:
    """A batch writer that appends to a table and tries again on failure.

    A partition commits as a whole; a new try may repeat those already
    committed.
    """

    def write(df: DataFrame, batch: int) -> None:
        if target.batch_column:
            df = df.withColumn(target.batch_column, F.lit(batch).cast("bigint"))
        for attempt in range(target.retries + 1):
            try:
                return append(df, target.options())
            except Exception:
                if attempt == target.retries:
                    raise
                time.sleep(target.pause_seconds)

    return write


def fan_out(*writers: BatchWriter) -> BatchWriter:
    """A batch writer that gives the same rows to several others.

    The batch is kept for the time of the writes, so it is computed once. Lost
    parts are computed again, from the same offsets.
    """

    def write(df: DataFrame, batch: int) -> None:
        kept = df.persist()
        try:
            for writer in writers:
                writer(kept, batch)
        finally:
            kept.unpersist()

    return write


class Ledger:
    """Which target has been given which micro-batch: an empty file each, in a folder that outlives the query."""

    def __init__(self, folder: str):
        self.folder = folder.rstrip("/")

    def _file(self, df: DataFrame, target: str, batch: int):
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{target}/{batch}")
        return path.getFileSystem(spark._jsc.hadoopConfiguration()), path

    def has(self, df: DataFrame, target: str, batch: int) -> bool:
        files, path = self._file(df, target, batch)
        return files.exists(path)

    def add(self, df: DataFrame, target: str, batch: int) -> None:
        files, path = self._file(df, target, batch)
        files.create(path, True).close()


def fan_out_once(ledger: str, **targets: BatchWriter) -> BatchWriter:
    """As :func:`fan_out` to named targets, by a ledger: a micro-batch that is run again goes to those that lack it.

    A failure between a write and its entry repeats that one write; :func:`folder_batch` then replaces its own output.
    """
    entries = Ledger(ledger)

    def write(df: DataFrame, batch: int) -> None:
        missing = [name for name in targets if not entries.has(df, name, batch)]

        def noted(name: str) -> BatchWriter:
            def once(rows: DataFrame, number: int) -> None:
                targets[name](rows, number)
                entries.add(rows, name, number)

            return once

        if missing:
            fan_out(*map(noted, missing))(df, batch)

    return write


def split_by(reason: str, good: BatchWriter, bad: BatchWriter) -> BatchWriter:
    """A batch writer for judged records: those without a reason go to ``good``, the others to ``bad``, from one decode."""
    return fan_out(
        lambda df, batch: good(df.filter(F.col(reason).isNull()).drop(reason), batch),
        lambda df, batch: bad(df.filter(F.col(reason).isNotNull()), batch),
    )


def folder_batch(path: str, format: str = "parquet") -> BatchWriter:
    """A batch writer that keeps each micro-batch in a folder of its own, so that a repeated one replaces itself."""

    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").format(format).save(f"{path.rstrip('/')}/batch={batch}")

    return write


def kafka_batch(brokers: str = DEFAULT_BROKERS, topic: str = "ema", **encoding) -> BatchWriter:
    """A batch writer that appends rows to a topic as JSON."""

    def write(df: DataFrame, batch: int) -> None:
        values = to_kafka_value(df, **encoding)
        values.write.format("kafka").options(**kafka_writer_options(brokers, topic)).save()

    return write
