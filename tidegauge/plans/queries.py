"""One query per operator over the event table.

A user or an event type stands for the symbol or seller, ``value`` for the
price or amount, ``event_id`` for the tie-breaker. Instants are shown as
zone-free timestamps in UTC.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codec import REJECT, decode_json, encode_json
from ..functions.eventtime import event_time
from ..functions.smoothing import ema_step, to_number
from ..operators import (
    SkewPolicy,
    adaptive_average,
    block_average,
    inactive_keys,
    latest_by_key,
    latest_per_tick,
    running_averages,
    tick_advice,
    window_advice,
    window_average_row,
    window_averages,
    window_count,
    window_drawdown,
    window_rows,
    window_sum,
)
from ..session import prepare
from ..sources.ticks import decode_ticks, table_events, ticks_from_events

Query = Callable[[SparkSession, str], DataFrame]

# Small enough that the larger groups of any test table are cut into runs.
CUT_EARLY = SkewPolicy(hot_rows=1000, run_rows=1000, max_runs=16)


def zone_free(df: DataFrame) -> DataFrame:
    """Timestamps without zone, as the other columns are."""
    return df.select(
        *[F.col(f.name).cast("timestamp_ntz") if f.dataType.typeName() == "timestamp" else F.col(f.name)
          for f in df.schema]
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table_events(prepare(spark), sf_dir)


def _ticks(spark: SparkSession, sf_dir: str, key: str = "user_id") -> DataFrame:
    return ticks_from_events(_events(spark, sf_dir), key)


def sales(events: DataFrame) -> DataFrame:
    """Events as sales: a seller, an amount in whole cents and epoch millis."""
    return events.select(
        F.col("user_id").cast("string").alias("seller_id"),
        F.round(F.col("value") * 100).cast("int").alias("amount_usd"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("sale_ts"),
    )


def tick_json(events: DataFrame) -> DataFrame:
    """Events as the JSON text of the three tick layouts, one per event type."""
    value, millis = F.col("value"), F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    fields = {
        "Close": value,
        "High": value + 1,
        "Interest": F.lit(0.0),
        "Low": value - 1,
        "Open": value,
        "Time": millis,
        "Volume": F.get_json_object("props", "$.k").cast("double"),
        "Symbol": F.col("user_id").cast("string"),
    }

    def text(names: Callable[[str], str], **more: Column) -> Column:
        return encode_json(*[c.alias(n) for n, c in more.items()], *[c.alias(names(n)) for n, c in fields.items()])

    layout = (
        F.when(F.col("event_type").isin("click", "view"), text(str, Id=F.col("event_id").cast("int")))
        .when(F.col("event_type") == "purchase", text(str.lower))
        .otherwise(text(str))
    )
    return events.select(layout.alias("value"), F.col("event_id").alias("seq"))


def sale_json(events: DataFrame) -> DataFrame:
    return sales(events).select(encode_json("*").alias("value"), F.lit(None).cast("bigint").alias("seq"))


def ticks_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_free(decode_ticks(tick_json(_events(spark, sf_dir))).drop(REJECT))


def json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Properties decoded by a declared type; other texts are told apart."""
    texts = _events(spark, sf_dir).select(
        "event_id", F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(F.col("props")).alias("text")
    )
    schema = spark.createDataFrame([], "k int").schema
    parsed = texts.select("event_id", decode_json(F.col("text"), schema).alias("p"))
    return parsed.select("event_id", F.col("p.k").alias("k"), F.col(f"p.{REJECT}").alias("rejected"))


def json_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _events(spark, sf_dir).select(
        "event_id",
        encode_json(
            F.col("user_id").cast("string").alias("symbol"),
            F.unix_millis(F.col("ts").cast("timestamp")).alias("timestamp"),
            F.col("value").alias("ema10"),
            F.col("event_type").alias("advise"),
        ).alias("value"),
    )


def _event_time(unit: str, text: Callable[[Column], Column]) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        moment = F.col("ts").cast("timestamp")
        return zone_free(
            _events(spark, sf_dir).select("event_id", event_time(text(moment), unit).alias("event_time"))
        )

    return query


def numeric_coercion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers written as text; a word in their place is no number."""
    raw = F.when(F.col("event_type") == "error", F.col("event_type")).otherwise(F.col("value").cast("string"))
    return _events(spark, sf_dir).select("event_id", to_number(raw).alias("close"))


def ema_step_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    previous = F.get_json_object("props", "$.k").cast("double")
    return _events(spark, sf_dir).select(
        "event_id",
        ema_step(F.col("value"), previous, 10).alias("ema10"),
        ema_step(F.col("value"), previous, 100).alias("ema100"),
    )


def ema_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running_averages(_ticks(spark, sf_dir), (10,)).select("symbol", "seq", "ema10")


def ema_dual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running_averages(_ticks(spark, sf_dir)).select("symbol", "seq", "ema10", "ema100")


def _advice(key: str, **options) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return zone_free(tick_advice(_ticks(spark, sf_dir, key), **options))

    return query


def ema_advice_flat_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Advice where each type has one price throughout, so that bounds of averages never meet."""
    flat = F.length("symbol").cast("double") / F.lit(7.0)
    return zone_free(tick_advice(_ticks(spark, sf_dir, "event_type").withColumn("close", flat), policy=CUT_EARLY))


def _block_scan(key: str, policy: SkewPolicy = SkewPolicy()) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ticks = _ticks(spark, sf_dir, key)
        both = block_average(ticks, (10, 100), policy)
        return both.select("symbol", "seq", F.round("ema10", 6).alias("ema10"), F.round("ema100", 6).alias("ema100"))

    return query


def _window_averages(key: str, size: str, slide: str | None = None, **options) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return zone_free(window_averages(_ticks(spark, sf_dir, key), size, slide, **options))

    return query


def _window_advice(key: str, size: str, slide: str | None = None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return zone_free(window_advice(_ticks(spark, sf_dir, key), size, slide))

    return query


def window_sum_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sales(_events(spark, sf_dir)).withColumn("event_time", event_time(F.col("sale_ts")))
    return zone_free(window_sum(rows))


def _window_count(key: str, size: str, slide: str | None = None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return zone_free(window_count(_ticks(spark, sf_dir, key), size=size, slide=slide))

    return query


def window_avg_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _ticks(spark, sf_dir, "event_type").withColumnRenamed("close", "temperature")
    means = window_average_row(rows, "symbol", "temperature", "1 day")
    return zone_free(means.withColumn("temperature", F.round("temperature", 9)))


def window_rows_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_free(window_rows(_ticks(spark, sf_dir), "1 minute", "30 seconds"))


def _drawdown(key: str, size: str, slide: str | None = None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return zone_free(window_drawdown(_ticks(spark, sf_dir, key), size, slide))

    return query


def _adaptive(key: str, policy: SkewPolicy = SkewPolicy()) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return adaptive_average(_ticks(spark, sf_dir, key), policy).select("symbol", "seq", "ema")

    return query


def latest_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_free(latest_by_key(_ticks(spark, sf_dir)))


def latest_per_tick_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_free(latest_per_tick(_ticks(spark, sf_dir)))


def _inactivity(key: str, timeout: str, policy: SkewPolicy = SkewPolicy()) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return zone_free(inactive_keys(_ticks(spark, sf_dir, key), timeout, policy))

    return query


def table_queries() -> dict[str, Query]:
    return {
        "ticks_normalized": ticks_normalized,
        "json_decode": json_decode,
        "json_encode": json_encode,
        "numeric_coercion": numeric_coercion,
        "event_time_ms": _event_time("ms", lambda ts: F.unix_millis(ts).cast("string")),
        "event_time_s": _event_time("s", lambda ts: (F.unix_millis(ts) / 1000).cast("string")),
        "event_time_str": _event_time("datetime", lambda ts: F.date_format(ts, "yyyy-MM-dd HH:mm:ss")),
        "event_time_long": _event_time("ms", F.unix_millis),
        "ema_step": ema_step_query,
        "ema_running": ema_running,
        "ema_dual": ema_dual,
        "ema_advice": _advice("user_id"),
        "ema_advice_by_type": _advice("event_type"),
        "ema_advice_cut": _advice("event_type", policy=CUT_EARLY),
        "ema_advice_flat_cut": ema_advice_flat_cut,
        "ema_advice_zero_unset": _advice("user_id", zero_unset=True),
        "ema_advice_expiring": _advice("user_id", expire_after="1 day"),
        "ema_advice_expiring_cut": _advice("event_type", expire_after="30 minutes", policy=CUT_EARLY),
        "ema_block_scan": _block_scan("user_id"),
        "ema_block_scan_cut": _block_scan("event_type", CUT_EARLY),
        "ema_window_sliding": _window_averages("user_id", "1 minute", "30 seconds"),
        "ema_window_sliding_by_type": _window_averages("event_type", "1 day", "12 hours"),
        "ema_window_tumbling": _window_averages("user_id", "30 seconds"),
        "ema_window_cut": _window_averages("event_type", "20 days", policy=CUT_EARLY),
        "window_advice": _window_advice("user_id", "1 minute", "30 seconds"),
        "window_advice_by_type": _window_advice("event_type", "1 day", "12 hours"),
        "window_advice_tumbling": _window_advice("event_type", "30 seconds"),
        "window_sum": window_sum_query,
        "window_count": _window_count("user_id", "30 seconds"),
        "window_count_by_type": _window_count("event_type", "1 day", "12 hours"),
        "window_avg_row": window_avg_row,
        "window_rows": window_rows_query,
        "window_drawdown": _drawdown("user_id", "1 day"),
        "window_drawdown_sliding": _drawdown("event_type", "1 day", "12 hours"),
        "ema_adaptive": _adaptive("user_id"),
        "ema_adaptive_cut": _adaptive("event_type", CUT_EARLY),
        "latest_close": latest_close,
        "latest_per_tick": latest_per_tick_query,
        "inactivity_timeout": _inactivity("user_id", "10 seconds"),
        "inactivity_timeout_cut": _inactivity("event_type", "10 minutes", CUT_EARLY),
    }
