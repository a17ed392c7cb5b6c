"""The three jobs, from raw text records to result rows.

Each takes a frame with the text column ``value`` and the tie-breaker ``seq``,
as the Kafka source gives it, streaming or not. Rows that cannot be decoded
are left out here; ``rejected`` gives them for a quarantine output. Streams count them in any
case: each micro-batch reports, as observed metric ``RECORDS``, how many records it read and how many it left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..functions.codec import REJECT, decode_json
from ..functions.eventtime import event_time
from ..functions.smoothing import usable
from ..operators import tick_advice, window_advice, window_sum
from ..schemas import AGGREGATED_SALE, SALE
from ..sources.ticks import MALFORMED, decode_ticks
from ..streaming.lateness import BOUNDED, MONOTONOUS, with_watermark
from ..streaming.sinks import BatchWriter, fan_out
from ..streaming.stateful import stream_tick_advice, stream_window_advice

ADVICE_COLUMNS = ("symbol", "timestamp", "ema10", "ema100", "advise")
SALE_COLUMNS = tuple(AGGREGATED_SALE.names)


RECORDS = "records"


def _counted(records: DataFrame, reject: str) -> DataFrame:
    """``records`` as they are; a stream's progress then tells how many were read and how many rejected."""
    if not records.isStreaming:
        return records
    return records.observe(RECORDS, F.count(F.lit(1)).alias("read"), F.count(reject).alias("rejected"))


def _decoded(values: DataFrame, unit: str, kept: tuple[str, ...] = ()) -> DataFrame:
    return decode_ticks(values, unit, seq=F.col("seq"), kept=kept)


def readable_ticks(values: DataFrame, unit: str = "ms") -> DataFrame:
    return _counted(_decoded(values, unit), REJECT).filter(F.col(REJECT).isNull()).drop(REJECT)


def rejected(values: DataFrame, unit: str = "ms") -> DataFrame:
    """Records that are no tick or lack a symbol, a time or a finite price, as text."""
    return _decoded(values, unit).filter(F.col(REJECT).isNotNull()).select(F.col(REJECT).alias("value"))


def tick_job(values: DataFrame, unit: str = "ms", stamp: str = "processing") -> DataFrame:
    """Advice for every tick."""
    ticks = readable_ticks(values, unit)
    advised = stream_tick_advice if ticks.isStreaming else tick_advice
    return advised(ticks, stamp=stamp)


def window_job(
    values: DataFrame,
    size: str = "1 minute",
    slide: str | None = "30 seconds",
    delay: str = BOUNDED,
    unit: str = "ms",
    stamp: str = "processing",
) -> DataFrame:
    """Advice for every window."""
    ticks = readable_ticks(values, unit)
    if ticks.isStreaming:
        return stream_window_advice(with_watermark(ticks, delay), size, slide, stamp=stamp)
    return window_advice(ticks, size, slide, stamp=stamp)


REASON = "reason"


def _blank(value: Column) -> Column:
    """No text at all, which the JSON reader takes for a record without fields."""
    return value.isNull() | (F.trim(value) == "")


def judged_ticks(values: DataFrame, unit: str = "ms") -> DataFrame:
    """Every record, decoded once: the columns of a tick, its text ``value``, and ``reason``, null for a tick.

    Reasons: ``unreadable`` (no JSON object, or a field of another type), ``no_symbol``, ``no_time``, ``no_price``.
    """
    rows = _decoded(values, unit, kept=("value",))
    reason = (
        F.when(_blank(F.col("value")) | F.col(MALFORMED), "unreadable")
        .when(F.col("symbol").isNull(), "no_symbol")
        .when(F.col("event_time").isNull(), "no_time")
        .when(~usable(F.col("event_time"), F.col("close")), "no_price")
        .when(F.col(REJECT).isNotNull(), "unreadable")
    )
    return rows.withColumn(REASON, reason).drop(REJECT, MALFORMED)


def judged_sales(values: DataFrame) -> DataFrame:
    """Every record, decoded once: seller_id, amount_usd, event_time, its text ``value``, and ``reason``, null for a sale.

    Reasons: ``unreadable``, ``no_seller``, ``no_time``, ``no_amount``.
    """
    rows = values.select("value", decode_json(F.col("value"), SALE).alias("sale"))
    rows = rows.select("value", "sale.*", event_time(F.col("sale.sale_ts")).alias("event_time"))
    reason = (
        F.when(_blank(F.col("value")) | F.col(REJECT).isNotNull(), "unreadable")
        .when(F.col("seller_id").isNull(), "no_seller")
        .when(F.col("event_time").isNull(), "no_time")
        .when(F.col("amount_usd").isNull(), "no_amount")
    )
    return rows.select("seller_id", "amount_usd", "event_time", "value", reason.alias(REASON))


def sales_rows(values: DataFrame) -> DataFrame:
    return _counted(judged_sales(values), REASON).filter(F.col(REASON).isNull()).select("seller_id", "amount_usd", "event_time")


def rejected_sales(values: DataFrame) -> DataFrame:
    """Records that are no sale or lack a seller, a time or an amount, as text."""
    return judged_sales(values).filter(F.col(REASON).isNotNull()).select("value")


def sales_job(values: DataFrame, size: str = "60 seconds", delay: str = MONOTONOUS) -> DataFrame:
    """Sales per seller and window; a sum of integers is a long."""
    sales = sales_rows(values)
    return window_sum(with_watermark(sales, delay) if sales.isStreaming else sales, size=size)


def start_to(df: DataFrame, checkpoint: str, *writers: BatchWriter, every: str = "1 second") -> StreamingQuery:
    """Start a query that gives each micro-batch to all writers."""
    writer = df.writeStream.outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every).foreachBatch(fan_out(*writers)).start()
