"""The ticks of one key in one micro-batch, as arrays.

A stateful operator hands Python one row after the other, and a row costs far more than folding its
price does. So ticks go there and come back in chunks, a row each: ``packed`` gathers the ticks of a
symbol within a task, before the shuffle, and ``unpacked`` makes rows of the chunks that a processor returns.
Where state need not be looked up by symbol, ``dealt`` gathers those of a bucket of symbols, since a key costs
more than a chunk.
"""

from __future__ import annotations

import tempfile
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

NO_SEQ = -(2**63)
#: Ticks in a chunk at most, and rows made at a time.
CHUNK = 10_000
#: Ticks a task gathers before it hands their chunks on.
GATHERED = 1_000_000
#: The same for chunks of buckets, which fill sooner.
DEALT_GATHERED = 250_000
#: Ticks of one symbol that a task sorts at once; of every so many sorted ones, one is kept in memory.
SORTED, SAMPLED = 250_000, 4_096
TICK = np.dtype([("micros", "<i8"), ("seq", "<i8"), ("close", "<f8")])
DATA = "data"
CHUNKS = StructType([StructField("symbol", StringType()), StructField(DATA, BinaryType())])
#: Buckets that symbols are dealt to by hash.
DEALT = 200
BUCKET, RUNS = "bucket", "runs"
BUCKETS = StructType([StructField(BUCKET, IntegerType()), StructField(RUNS, BinaryType()), StructField(DATA, BinaryType())])
#: The symbols of a chunk in order, and how many ticks each has.
RUN = pa.schema([("symbol", pa.string()), ("ticks", pa.int64())])


def _binaries(rows: np.ndarray, starts: np.ndarray) -> pa.Array:
    """The bytes of ``rows`` from each start to the next, not copied."""
    offsets = (np.append(starts, len(rows)) * rows.itemsize).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(rows.view(np.uint8))])


def _ticks(table: pa.Table, order: np.ndarray) -> np.ndarray:
    ticks = np.empty(len(order), TICK)
    for name, column in (("micros", table["event_time"]), ("seq", pc.fill_null(table["seq"], NO_SEQ)), ("close", table["close"])):
        ticks[name] = column.to_numpy()[order]
    return ticks


def cuts(keys: np.ndarray) -> np.ndarray:
    """Where chunks begin: at each new key, and after ``CHUNK`` ticks of one."""
    first = np.append(0, np.flatnonzero(np.diff(keys)) + 1)
    at = np.arange(len(keys)) - np.repeat(first, np.diff(np.append(first, len(keys))))
    return np.flatnonzero(at % CHUNK == 0)


def _chunks(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(batches)
    symbols = pa.concat_arrays(table["symbol"].chunks).dictionary_encode("encode")
    codes = symbols.indices.to_numpy()
    order = np.argsort(codes, kind="stable")
    ticks, codes = _ticks(table, order), codes[order]
    starts = cuts(codes)
    return pa.record_batch([symbols.dictionary.take(pa.array(codes[starts])), _binaries(ticks, starts)], names=CHUNKS.names)


def _bucket_chunks(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(batches)
    symbols = pa.concat_arrays(table["symbol"].chunks).dictionary_encode("encode")
    codes, buckets = symbols.indices.to_numpy(), table[BUCKET].to_numpy()
    order = np.lexsort((codes, buckets))
    ticks, codes, buckets = _ticks(table, order), codes[order], buckets[order]
    starts = cuts(buckets)
    runs = [runs_of(symbols.dictionary, codes[a:b]) for a, b in zip(starts, np.append(starts[1:], len(codes)))]
    return pa.record_batch([pa.array(buckets[starts]), pa.array(runs, pa.binary()), _binaries(ticks, starts)], names=BUCKETS.names)


def runs_of(symbols: pa.Array, codes: np.ndarray) -> bytes:
    """Which symbols a chunk holds, from the number of each tick's symbol; those of a symbol are next to each other."""
    first = np.append(0, np.flatnonzero(np.diff(codes)) + 1)
    counts = np.diff(np.append(first, len(codes)))
    return pa.record_batch([symbols.take(pa.array(codes[first])), pa.array(counts)], schema=RUN).serialize().to_pybytes()


def read_chunks(chunks: Sequence[tuple[bytes, bytes]]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Symbols, the number of each tick's symbol, and ticks, from one or more (runs, data)."""
    runs = [pa.ipc.read_record_batch(pa.py_buffer(bytes(run)), RUN) for run, _ in chunks]
    symbols = pa.concat_arrays([run["symbol"] for run in runs]).dictionary_encode("encode")
    codes = np.repeat(symbols.indices.to_numpy(), np.concatenate([run["ticks"].to_numpy() for run in runs]))
    return symbols.dictionary, codes, np.frombuffer(b"".join(bytes(data) for _, data in chunks), TICK)


def gathered(chunks: Callable[[list[pa.RecordBatch]], pa.RecordBatch], at_once: int = GATHERED):
    """Task function: about ``at_once`` rows at a time to chunks."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= at_once:
                yield chunks(held)
                held, rows = [], 0
        if held:
            yield chunks(held)

    return run


def packed(ticks: DataFrame) -> DataFrame:
    """Rows (symbol, data) from rows (symbol, event_time in microseconds, seq, close), for ``Ticks.of_chunks``.

    A chunk holds at most 10,000 ticks of one symbol (or of no symbol) that one task has read. No tick is left out; an empty
    input gives no row.
    """
    return ticks.select("symbol", "event_time", "seq", "close").mapInArrow(gathered(_chunks), CHUNKS)


def dealt(ticks: DataFrame) -> DataFrame:
    """Rows (bucket, runs, data) from the rows that ``packed`` takes, for ``read_chunks``.

    A chunk holds at most 10,000 ticks of the symbols of one bucket that one task has read. No tick is left out; an
    empty input gives no row.
    """
    bucket = F.pmod(F.xxhash64("symbol"), F.lit(DEALT)).cast("int").alias(BUCKET)
    return ticks.select("symbol", "event_time", "seq", "close", bucket).mapInArrow(gathered(_bucket_chunks, DEALT_GATHERED), BUCKETS)


def _fields(doubles: Sequence[str], longs: Sequence[str]) -> np.dtype:
    return np.dtype([*[(name, "<i8") for name in longs], *[(name, "<f8") for name in doubles]])


def unpacked(chunks: DataFrame, doubles: Sequence[str], longs: Sequence[str] = ("event_time", "seq")) -> DataFrame:
    """Rows (symbol, longs, doubles) from the chunks that ``Ticks.chunks`` gives; a missing ``seq`` is null again."""
    dtype = _fields(doubles, longs)
    types = [*[StructField(name, LongType()) for name in longs], *[StructField(name, DoubleType()) for name in doubles]]

    def rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                data = np.frombuffer(batch.column(DATA)[row].as_buffer(), dtype)
                columns = {name: np.ascontiguousarray(data[name]) for name in dtype.names}
                arrays = [pa.array(values, mask=values == NO_SEQ) if name == "seq" else pa.array(values) for name, values in columns.items()]
                symbol = batch.column("symbol").take(pa.array(np.full(len(data), row)))
                yield pa.record_batch([symbol, *arrays], names=["symbol", *dtype.names])

    return chunks.mapInArrow(rows, StructType([CHUNKS["symbol"], *types]))


def _upto(ticks: np.ndarray, micros: int, seq: int) -> int:
    """How many of the sorted ticks come before a time and tie-breaker."""
    low, high = np.searchsorted(ticks["micros"], [micros, micros + 1])
    return int(low + np.searchsorted(ticks["seq"][low:high], seq))


class _Run:
    """Sorted ticks in a file; one of every ``SAMPLED`` stays in memory."""

    def __init__(self, file, ticks: np.ndarray):
        self.file, self.at, self.count, self.read = file, file.tell(), len(ticks), 0
        self.samples, self.left = ticks[::SAMPLED].copy(), np.empty(0, TICK)
        ticks.tofile(file)

    def before(self, micros: int, seq: int) -> np.ndarray:
        """The ticks before a time and tie-breaker that have not been given yet."""
        end = min(self.count, _upto(self.samples, micros, seq) * SAMPLED)
        if end > self.read:
            self.file.seek(self.at + self.read * TICK.itemsize)
            self.left = np.concatenate([self.left, np.fromfile(self.file, TICK, end - self.read)])
            self.read = end
        cut = _upto(self.left, micros, seq)
        given, self.left = self.left[:cut], self.left[cut:]
        return given

    def rest(self) -> np.ndarray:
        self.file.seek(self.at + self.read * TICK.itemsize)
        return np.concatenate([self.left, np.fromfile(self.file, TICK, self.count - self.read)])


def in_order(frames: Iterable[pd.DataFrame]) -> Iterator[Ticks]:
    """The ticks of one symbol in order, about ``SORTED`` at a time.

    More than that many are sorted in runs, written to a temporary file without a name, and read range by range, so
    memory does not grow with the symbol. Ticks equal in time and tie-breaker stay in one piece.
    """
    with tempfile.TemporaryFile() as file:
        held, size, runs = [], 0, []
        for frame in frames:
            for data in frame[DATA]:
                held.append(bytes(data))
                size += len(data) // TICK.itemsize
                if size >= SORTED:
                    runs.append(_Run(file, Ticks.of_data(held).data()))
                    held, size = [], 0
        if not runs:
            if held:
                yield Ticks.of_data(held)
            return
        if held:
            runs.append(_Run(file, Ticks.of_data(held).data()))
        samples = np.concatenate([run.samples for run in runs])
        samples = samples[np.lexsort((samples["seq"], samples["micros"]))]
        for micros, seq, _ in samples[SORTED // SAMPLED :: SORTED // SAMPLED].tolist():
            ticks = np.concatenate([run.before(micros, seq) for run in runs])
            if len(ticks):
                yield Ticks(ticks["micros"], ticks["seq"], ticks["close"])
        ticks = np.concatenate([run.rest() for run in runs])
        if len(ticks):
            yield Ticks(ticks["micros"], ticks["seq"], ticks["close"])


class Ticks:
    """Ticks of one symbol as arrays, 24 bytes each.

    In the order of event time, then of the tie-breaker; a missing one is first.
    """

    def __init__(self, times: np.ndarray, seqs: np.ndarray, closes: np.ndarray):
        order = np.lexsort((seqs, times))
        self.micros, self.seqs, self.close = times[order], seqs[order], closes[order]

    @classmethod
    def of_rows(cls, rows: Iterable[Row]) -> Ticks:
        times, seqs, closes = array("q"), array("q"), array("d")
        for row in rows:
            times.append(row.event_time)
            seqs.append(NO_SEQ if row.seq is None else row.seq)
            closes.append(row.close)
        return cls(np.frombuffer(times, np.int64), np.frombuffer(seqs, np.int64), np.frombuffer(closes))

    @classmethod
    def of_chunks(cls, rows: Iterable[Row]) -> Ticks:
        return cls.of_data([bytes(row[DATA]) for row in rows])

    @classmethod
    def of_data(cls, chunks: Sequence[bytes]) -> Ticks:
        ticks = np.frombuffer(b"".join(chunks), TICK)
        return cls(ticks["micros"], ticks["seq"], ticks["close"])

    def data(self) -> np.ndarray:
        ticks = np.empty(len(self.close), TICK)
        ticks["micros"], ticks["seq"], ticks["close"] = self.micros, self.seqs, self.close
        return ticks

    def rows(self, *more: np.ndarray, start: int = 0) -> Iterator[tuple]:
        """(event_time, seq, ...) per tick; made in chunks as they are taken."""
        for at in range(start, len(self.micros), CHUNK):
            part = slice(at, at + CHUNK)
            for micros, seq, *values in zip(*[column[part].tolist() for column in (self.micros, self.seqs, *more)]):
                yield micros, None if seq == NO_SEQ else seq, *values

    def chunks(self, doubles: dict[str, np.ndarray], longs: dict[str, int] | None = None) -> Iterator[bytes]:
        """The ticks with more columns, as ``unpacked`` reads them; ``longs`` are the same for all."""
        dtype = _fields(list(doubles), [*(longs or {}), "event_time", "seq"])
        for at in range(0, len(self.micros), CHUNK):
            part = slice(at, at + CHUNK)
            data = np.empty(len(self.micros[part]), dtype)
            data["event_time"], data["seq"] = self.micros[part], self.seqs[part]
            for name, values in doubles.items():
                data[name] = values[part]
            for name, value in (longs or {}).items():
                data[name] = value
            yield data.tobytes()
