"""Sums per key and window as a stream of changes, and the table that they add up to."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BinaryType, IntegerType, LongType, StringType, StructField, StructType

from ..operators.windows import duration_micros
from ..session import use_rocksdb
from .state_rows import BUCKET, DATA, DEALT, DEALT_GATHERED, cuts, gathered

INSERT, RETRACT, UPDATE = "insert", "retract", "update"
CHANGE, VERSION = "change", "version"
GROUP = ["key", "window_start"]
#: Neighbouring windows whose sums are one entry of the state; entries that a task changes at once.
BLOCK, AT_ONCE = 16, 256
ADDED = pa.schema([("key", pa.string()), ("window_start", pa.int64()), ("amount", pa.int64())])
SUMS = ADDED.append(pa.field(VERSION, pa.int64()))
CHUNKS = StructType([StructField(BUCKET, IntegerType()), StructField(DATA, BinaryType())])


def _longs(*names: str) -> list[StructField]:
    return [StructField(name, LongType()) for name in names]


def _read(data: bytes, schema: pa.Schema) -> pa.Table:
    return pa.Table.from_batches([pa.ipc.read_record_batch(pa.py_buffer(bytes(data)), schema)])


def _slices(table: pa.Table, starts: np.ndarray) -> Iterator[bytes]:
    batch = pa.RecordBatch.from_arrays([pa.concat_arrays(column.chunks) for column in table.columns], schema=table.schema)
    for a, b in zip(starts.tolist(), np.append(starts[1:], len(batch)).tolist()):
        yield batch.slice(a, b - a).serialize().to_pybytes()


def _added(table: pa.Table, *group: str) -> pa.Table:
    """Amounts added up by key and window, and by further columns that depend on the key."""
    sums = table.group_by([*group, *GROUP], use_threads=False).aggregate([("amount", "sum")])
    return sums.rename_columns([*group, *ADDED.names])


def _bucket_sums(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Rows with their bucket, added up, as rows of ``CHUNKS``."""
    sums = _added(pa.Table.from_batches(batches), BUCKET).sort_by(BUCKET)
    buckets = sums[BUCKET].to_numpy()
    starts = cuts(buckets)
    data = pa.array(_slices(sums.select(ADDED.names).cast(ADDED), starts), pa.binary())
    return pa.record_batch([pa.array(buckets[starts]), data], names=CHUNKS.names)


class WindowChanges(StatefulProcessor):
    """The sums of keys and windows, each reported whenever a micro-batch changes it.

    The key is a bucket of keys. State is the sums and the numbers of their reports, an entry per ``BLOCK`` neighbouring
    windows; a timer at the end of the last of them drops it. A micro-batch rewrites the entries that it changes.
    """

    output = StructType([StructField("key", StringType()), *_longs("window_start", "amount"), StructField(CHANGE, StringType()), *_longs(VERSION)])

    def __init__(self, size: int):
        self.size, self.block = size, size * BLOCK

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sums = handle.getMapState("sums", StructType(_longs("block")), StructType([StructField(DATA, BinaryType())]))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        added = pa.concat_tables([_read(data, ADDED) for frame in rows for data in frame[DATA]])
        ends = (added["window_start"].to_numpy() + self.size) // 1000
        added = _added(added.filter(pa.array(ends > timerValues.getCurrentWatermarkInMs())))  # others are closed
        blocks = added["window_start"].to_numpy() // self.block
        order = np.argsort(blocks, kind="stable")
        added, blocks = added.take(pa.array(order)), blocks[order]
        distinct, starts = np.unique(blocks, return_index=True)
        for at in range(0, len(distinct), AT_ONCE):
            first = int(starts[at])
            until = int(starts[at + AT_ONCE]) if at + AT_ONCE < len(distinct) else len(blocks)
            yield self._changed(added.slice(first, until - first), distinct[at : at + AT_ONCE].tolist())

    def _changed(self, added: pa.Table, blocks: list[int]) -> pd.DataFrame:
        """The changes that the sums added make to those known of the same blocks, which are written anew."""
        found = [SUMS.empty_table()]
        for block in blocks:
            if self.sums.containsKey((block,)):
                found.append(_read(self.sums.getValue((block,))[0], SUMS))
            else:
                self.handle.registerTimer((block + 1) * self.block // 1000 - 1)
        both = pa.concat_tables([added.rename_columns([*GROUP, "added"]), pa.concat_tables(found).rename_columns([*GROUP, "known", VERSION])], promote_options="default")
        both = both.group_by(GROUP, use_threads=False).aggregate([("added", "sum"), ("known", "sum"), (VERSION, "max")])
        both = both.take(pa.array(np.argsort(both["window_start"].to_numpy() // self.block, kind="stable")))
        touched, old = (pc.is_valid(both[name]).to_numpy() for name in ("added_sum", "known_sum"))
        plus, before, version = (pc.fill_null(both[name], 0).to_numpy() for name in ("added_sum", "known_sum", f"{VERSION}_max"))
        amount, version = before + plus, version + (touched & old)
        of = both["window_start"].to_numpy() // self.block
        sums = pa.Table.from_arrays([both["key"], both["window_start"], pa.array(amount), pa.array(version)], schema=SUMS)
        for block, data in zip(blocks, _slices(sums, np.flatnonzero(np.diff(of, prepend=of[0] - 1)))):
            self.sums.updateValue((block,), (data,))
        # A sum that was known is retracted, then follows the new one.
        changed = np.flatnonzero(touched)
        row = np.repeat(changed, 1 + old[changed])
        retracted = np.append(row[1:] == row[:-1], False)
        change = np.where(retracted, RETRACT, np.where(old[row], UPDATE, INSERT))
        columns = both["key"].take(pa.array(row)).to_pylist(), both["window_start"].to_numpy()[row], np.where(retracted, before[row], amount[row]), change, version[row]
        return pd.DataFrame(dict(zip(self.output.names, columns)))

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        block = (expiredTimerInfo.getExpiryTimeInMs() + 1) * 1000 // self.block - 1
        if self.sums.containsKey((block,)):
            self.sums.removeKey((block,))
        return iter(())


def stream_window_changes(df: DataFrame, key: str, amount: str, size: str = "60 seconds", time: str = "event_time") -> DataFrame:
    """Changes of the sums of whole-number amounts per key and tumbling window: key, window_start, window_end, amount, change, version.

    A first sum is an ``insert``; when later rows change it, the old one is retracted and the new one follows
    as an ``update``, both with the next version. So amounts, those retracted counted as negative, add up to the
    window's sum at any time, and so does the last row that is no retraction. Rows of closed windows, and
    rows without a time, are left out; a null amount adds nothing. The stream needs a watermark. Amounts are added up by
    key and window before they are shuffled, to ``DEALT`` buckets of keys; the sums of a bucket in one micro-batch are one task's work.
    """
    micros = duration_micros(size)
    if micros % 1000:
        raise ValueError("windows begin and end at whole milliseconds")
    start = F.unix_micros(time) - F.pmod(F.unix_micros(time), F.lit(micros))
    plain = df.filter(F.col(time).isNotNull()).select(F.col(key).cast("string").alias("key"), start.alias("window_start"), F.coalesce(F.col(amount).cast("long"), F.lit(0)).alias("amount"))
    use_rocksdb(df.sparkSession)
    bucket = F.pmod(F.xxhash64("key"), F.lit(DEALT)).cast("int")
    sums = plain.withColumn(BUCKET, bucket).mapInArrow(gathered(_bucket_sums, DEALT_GATHERED), CHUNKS)
    out = sums.groupBy(BUCKET).transformWithStateInPandas(
        statefulProcessor=WindowChanges(micros), outputStructType=WindowChanges.output, outputMode="append", timeMode="EventTime"
    )
    ends = F.timestamp_micros(F.col("window_start") + micros)
    return out.select(F.col("key").alias(key), F.timestamp_micros("window_start").alias("window_start"), ends.alias("window_end"), F.col("amount").alias(amount), CHANGE, VERSION)


def compacted(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The table that changes add up to: of every key the last row that is no retraction. Repeated rows do no harm."""
    rest = [name for name in changes.columns if name not in (*keys, CHANGE, VERSION)]
    last = F.max_by(F.struct(*rest), VERSION).alias("_last")
    return changes.filter(F.col(CHANGE) != RETRACT).groupBy(*keys).agg(last).select(*keys, "_last.*")
