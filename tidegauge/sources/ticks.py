"""From raw records to canonical ticks (``schemas.TICK``)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, StringType, StructField, StructType

from ..functions.codec import REJECT, decode_json
from ..functions.eventtime import event_time
from ..functions.smoothing import to_number, usable
from ..schemas import TICK_CAPITALISED, TICK_LOWER

#: Marks records that are no JSON object of the declared types.
MALFORMED = "_malformed"
GIGABYTE = 1 << 30

EVENT_TABLE = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"


def read_json_lines(spark: SparkSession, path: str, streaming: bool = False, max_bytes: int = GIGABYTE) -> DataFrame:
    """Files of one JSON object per line as the column ``value``."""
    if streaming:
        return spark.readStream.option("maxBytesPerTrigger", max_bytes).text(path)
    return spark.read.text(path)


def normalise_ticks(df: DataFrame, unit: str = "ms", seq: Column | None = None) -> DataFrame:
    """Rows with the fields of any tick layout as canonical ticks.

    Spark matches names without regard to case, so ``Close`` and ``close``
    need no separate treatment; only the identifier is optional. ``seq`` is
    the tie-breaker, by default that identifier.
    """
    if seq is None:
        seq = F.col("Id") if "id" in {name.lower() for name in df.columns} else F.lit(None)
    return df.select(
        F.col("symbol").alias("symbol"),
        event_time(F.col("time"), unit).alias("event_time"),
        seq.cast("bigint").alias("seq"),
        *[to_number(F.col(name)).alias(name) for name in ("close", "high", "interest", "low", "open", "volume")],
    )


def _as_text(schema: StructType) -> StructType:
    """Doubles as the text they are written in, quoted or not."""
    kind = lambda f: StringType() if isinstance(f.dataType, (DoubleType, FloatType)) else f.dataType
    return StructType([StructField(f.name, kind(f)) for f in schema.fields])


def decode_ticks(df: DataFrame, unit: str = "ms", value: str = "value", seq: Column | None = None, kept: Sequence[str] = ()) -> DataFrame:
    """JSON text in either case of field names as canonical ticks.

    Adds ``_unreadable``: the text of a record that is no JSON object or lacks a
    symbol, a readable time or a finite price, else null. Numbers may be
    quoted. The lower-case layout is only parsed where the
    capitalised one found no symbol. With ``kept``, these columns stay and ``_malformed`` tells
    whether the text as a whole could not be read.
    """
    upper = decode_json(F.col(value), _as_text(TICK_CAPITALISED))
    parsed = df.select("*", upper.alias("_upper"))
    lower = F.when(F.col("_upper.Symbol").isNull(), decode_json(F.col(value), _as_text(TICK_LOWER)))
    parsed = parsed.select("*", lower.alias("_lower"))

    def field(name: str) -> Column:
        return F.coalesce(F.col(f"_upper.{name.capitalize()}"), F.col(f"_lower.{name}"))

    symbol, time = field("symbol"), event_time(field("time"), unit)
    whole = symbol.isNotNull() & usable(time, to_number(field("close")))
    return parsed.select(
        field("symbol").alias("symbol"),
        event_time(field("time"), unit).alias("event_time"),
        (F.col("_upper.Id") if seq is None else seq).cast("bigint").alias("seq"),
        *[to_number(field(name)).alias(name) for name in ("close", "high", "interest", "low", "open", "volume")],
        F.when(~whole, F.col(value)).otherwise(F.coalesce(F.col(f"_upper.{REJECT}"), F.col(f"_lower.{REJECT}"))).alias(REJECT),
        *([F.coalesce(F.col(f"_upper.{REJECT}").isNotNull(), F.lit(True)).alias(MALFORMED), *kept] if kept else []),
    )


def ticks_from_events(events: DataFrame, key: str = "user_id") -> DataFrame:
    """The four columns the averages need, from rows of an event table."""
    return events.select(
        F.col(key).cast("string").alias("symbol"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("event_id").alias("seq"),
        to_number(F.col("value")).alias("close"),
    )


def table_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENT_TABLE).parquet(f"{sf_dir}/events.parquet")


def stream_events(spark: SparkSession, sf_dir: str, max_bytes: int = GIGABYTE) -> DataFrame:
    """The event table as a stream of files, ``max_bytes`` per micro-batch.

    A file source reads folders; a table that is one file is picked out of its own.
    """
    reader = spark.readStream.schema(EVENT_TABLE).option("maxBytesPerTrigger", max_bytes)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/events.parquet")
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(path).isDirectory():
        return reader.parquet(f"{sf_dir}/events.parquet")
    return reader.option("pathGlobFilter", "events.parquet").parquet(sf_dir)
