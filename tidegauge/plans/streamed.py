"""Queries that run an operator as a stream over the event table.

The table is read as a stream of files, the query runs until it has caught up,
and its output files are the result. Windows still open then are not in it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.codec import decode_json, encode_json
from ..operators import last_averages, window_average_row, window_count, window_sum
from ..schemas import AGGREGATED_SALE
from ..session import fresh_folder, prepare
from ..sources.ticks import GIGABYTE, stream_events, table_events, ticks_from_events
from ..streaming import (
    averages_in_state,
    compacted,
    judged_lateness,
    stream_adaptive_average,
    stream_inactive_keys,
    stream_latest_per_tick,
    stream_tick_advice,
    stream_window_advice,
    stream_window_averages,
    stream_window_changes,
    to_kafka_value,
    with_watermark,
    write_files,
)
from ..streaming.changes import CHANGE, RETRACT
from ..streaming.sinks import fan_out_once, folder_batch, split_by
from .jobs import ADVICE_COLUMNS, REASON, SALE_COLUMNS, judged_sales, judged_ticks, sales_job, tick_job, window_job
from .queries import Query, sale_json, sales, tick_json, zone_free


def drained(df: DataFrame, name: str, format: str = "parquet") -> DataFrame:
    """What a stream has written once it has read all there is."""
    spark = df.sparkSession
    path = fresh_folder(spark, name)
    write_files(df, path, fresh_folder(spark, f"{name}-checkpoint"), once=True, format=format).awaitTermination()
    return spark.read.schema(df.schema).format(format).load(path)


def _stream(build: Callable[[DataFrame], DataFrame], key: str, name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ticks = ticks_from_events(stream_events(prepare(spark), sf_dir), key)
        return zone_free(drained(build(ticks), name))

    return query


def halves(events: DataFrame) -> list[DataFrame]:
    """Events of the earlier and of the later half of the time covered; those without a time are in the first."""
    low, high = events.agg(F.min("ts"), F.max("ts")).first()
    if low is None:
        return [events, events.limit(0)]
    early = F.coalesce(F.col("ts") < F.lit(low + (high - low) // 2).cast("timestamp_ntz"), F.lit(True))
    return [events.filter(early), events.filter(~early)]


def restarted(build: Callable[[DataFrame], DataFrame], parts: list[DataFrame], name: str, checkpoint: str | None = None) -> DataFrame:
    """What a stream has written that is started once per part, each time from its checkpoint.

    A part is added to the stream's folder when all before it are read, so state, windows and
    the watermark of one start are needed by the next.
    """
    spark = parts[0].sparkSession
    folder, path = fresh_folder(spark, f"{name}-source"), fresh_folder(spark, name)
    checkpoint = checkpoint or fresh_folder(spark, f"{name}-checkpoint")
    for part in parts:
        part.write.mode("append").parquet(folder)
        source = spark.readStream.schema(part.schema).option("maxBytesPerTrigger", GIGABYTE).parquet(folder)
        rows = build(source)
        write_files(rows, path, checkpoint, once=True).awaitTermination()
    return spark.read.schema(rows.schema).parquet(path)


def _restarted(build: Callable[[DataFrame], DataFrame], key: str, name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        parts = halves(table_events(prepare(spark), sf_dir))
        return zone_free(restarted(lambda events: build(ticks_from_events(events, key)), parts, name))

    return query


def stream_late_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per window where the earlier half of the events comes last: windows then closed leave it out."""
    parts = halves(table_events(prepare(spark), sf_dir))[::-1]
    count = lambda events: window_count(with_watermark(ticks_from_events(events, "event_type")))
    return zone_free(restarted(count, parts, "late-windows"))


def stream_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The averages in the state store of a stream that was started twice."""
    parts = halves(table_events(prepare(spark), sf_dir))
    session = parts[0].sparkSession
    checkpoint = fresh_folder(session, "state-checkpoint")
    restarted(lambda events: stream_tick_advice(ticks_from_events(events)), parts, "state", checkpoint)
    return zone_free(averages_in_state(session, checkpoint))


def stream_from_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Advice for the later half of the events, by a stream that goes on from the averages of the earlier half, a table."""
    early, late = halves(table_events(prepare(spark), sf_dir))
    history = last_averages(ticks_from_events(early, "event_type"))
    return zone_free(restarted(lambda events: stream_tick_advice(ticks_from_events(events, "event_type"), history=history), [late], "from-history"))


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events, the earlier half of which comes last, with ``late`` where their window was closed by then."""
    parts = halves(table_events(prepare(spark), sf_dir))[::-1]
    judge = lambda events: judged_lateness(with_watermark(ticks_from_events(events, "event_type")), "30 seconds")
    return zone_free(restarted(judge, parts, "late-rows"))


def stream_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sums per window from a log of changes: as its last rows give them, and as all of its rows add up.

    Events come in two parts that share windows, within a watermark that closes none.
    """
    events = table_events(prepare(spark), sf_dir)
    parts = [events.filter(F.col("event_id") % 2 == rest) for rest in (0, 1)]

    def changed(part: DataFrame) -> DataFrame:
        rows = sales(part).withColumn("event_time", F.timestamp_millis("sale_ts"))
        return stream_window_changes(with_watermark(rows, "36500 days"), "seller_id", "amount_usd")

    changes, keys = restarted(changed, parts, "changelog"), ["seller_id", "window_start", "window_end"]
    signed = F.when(F.col(CHANGE) == RETRACT, -F.col("amount_usd")).otherwise(F.col("amount_usd"))
    added = changes.groupBy(*keys).agg(F.sum(signed).alias("summed"))
    return zone_free(compacted(changes, keys).withColumnRenamed("amount_usd", "aggregated_amount").join(added, keys))


def _damaged(whole: Column, broken: dict[int, Column]) -> Column:
    """Records of which some kinds are broken, told by their number."""
    for rest, text in broken.items():
        whole = F.when(F.col("seq") % 7 == rest, text).otherwise(whole)
    return whole


def _mixed_ticks(events: DataFrame) -> DataFrame:
    fields = {"Symbol": F.col("user_id").cast("string"), "Time": F.unix_millis(F.col("ts").cast("timestamp")).cast("string"), "Close": F.col("value")}
    text = lambda **other: encode_json(*[other.get(n, c).alias(n) for n, c in fields.items()])
    none = F.lit(None).cast("string")
    broken = {0: F.concat(F.lit("tick "), F.col("seq").cast("string")), 1: text(Symbol=none), 2: text(Time=F.lit("soon")), 3: text(Close=none), 4: F.lit('{"foo": 1}')}
    return events.withColumn("seq", F.col("event_id")).select(_damaged(text(), broken).alias("value"), "seq")


def _mixed_sales(events: DataFrame) -> DataFrame:
    rows = events.withColumn("seq", F.col("event_id"))
    fields = {"seller_id": F.col("user_id").cast("string"), "amount_usd": F.col("event_id").cast("int"), "sale_ts": F.unix_millis(F.col("ts").cast("timestamp"))}
    text = lambda **other: encode_json(*[other.get(n, c).alias(n) for n, c in fields.items()])
    none = F.lit(None).cast("string")
    broken = {0: F.lit("{"), 1: text(seller_id=none), 2: text(sale_ts=none), 3: text(amount_usd=none), 4: F.lit('{"foo": 1}')}
    return rows.select(_damaged(text(), broken).alias("value"), "seq")


def quarantined(judged: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """What a stream of judged records has written once it has read all there is: good ones, and others with their reason."""
    spark = judged.sparkSession
    folders, frames = [fresh_folder(spark, f"{name}-{side}") for side in ("good", "bad")], [judged.drop(REASON), judged]
    for path, frame in zip(folders, frames):  # read even if no micro-batch comes
        folder_batch(path)(spark.createDataFrame([], frame.schema), -1)
    writer = judged.writeStream.option("checkpointLocation", fresh_folder(spark, f"{name}-checkpoint")).trigger(availableNow=True)
    writer.foreachBatch(split_by(REASON, *map(folder_batch, folders))).start().awaitTermination()
    return tuple(spark.read.schema(frame.schema).parquet(path).drop("batch") for path, frame in zip(folders, frames))


def stream_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records kept and rejected, by reason, of topics in which some are broken; each is decoded once."""
    spark, counts = prepare(spark), None
    for kind, text, judge in (("tick", _mixed_ticks, judged_ticks), ("sale", _mixed_sales, judged_sales)):
        good, bad = quarantined(judge(_records(spark, sf_dir, text)), f"rejects-{kind}")
        rows = good.select(F.lit("kept").alias("reason")).unionByName(bad.select("reason"))
        rows = rows.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).select(F.lit(kind).alias("kind"), "reason", "n")
        counts = rows if counts is None else counts.unionByName(rows)
    return counts


def stream_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per window in two folders at once, with a ledger of what each has been given."""
    spark = prepare(spark)
    counts = window_count(with_watermark(ticks_from_events(stream_events(spark, sf_dir), "event_type")))
    folders = {name: fresh_folder(spark, f"fan-out-{name}") for name in ("first", "second")}
    for path in folders.values():
        folder_batch(path)(spark.createDataFrame([], counts.schema), -1)
    ledger, checkpoint = fresh_folder(spark, "fan-out-ledger"), fresh_folder(spark, "fan-out-checkpoint")
    writer = counts.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    writer.foreachBatch(fan_out_once(ledger, **{name: folder_batch(path) for name, path in folders.items()})).start().awaitTermination()
    read = lambda name: spark.read.schema(counts.schema).parquet(folders[name]).drop("batch").withColumn("target", F.lit(name))
    return zone_free(read("first").unionByName(read("second")))


def _average_rows(ticks: DataFrame) -> DataFrame:
    readings = with_watermark(ticks).withColumnRenamed("close", "temperature")
    means = window_average_row(readings, "symbol", "temperature", "1 day")
    return means.withColumn("temperature", F.round("temperature", 9))


def stream_window_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sales(stream_events(prepare(spark), sf_dir))
    rows = rows.withColumn("event_time", F.timestamp_millis("sale_ts"))
    return zone_free(drained(window_sum(with_watermark(rows)), "window-sum"))


def _records(spark: SparkSession, sf_dir: str, text: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The event table as records of a topic, a JSON value and its offset, read as a stream."""
    path = fresh_folder(spark, "records")
    text(table_events(prepare(spark), sf_dir)).write.parquet(path)
    return spark.readStream.schema("value string, seq bigint").option("maxBytesPerTrigger", GIGABYTE).parquet(path)


def job_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON ticks in, JSON advice out, as between two topics."""
    values = to_kafka_value(
        tick_job(_records(spark, sf_dir, tick_json), stamp="event"),
        epoch=["timestamp"],
        unit="ms",
        columns=ADVICE_COLUMNS,
    )
    schema = "symbol string, timestamp bigint, ema10 double, ema100 double, advise string"
    return drained(values, "job-ticks", "text").select(F.from_json("value", schema).alias("r")).select("r.*")


def job_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = to_kafka_value(
        window_job(_records(spark, sf_dir, tick_json), "1 day", "12 hours", stamp="event"),
        epoch=["timestamp"],
        unit="ms",
        columns=ADVICE_COLUMNS,
    )
    schema = "symbol string, timestamp bigint, ema10 double, ema100 double, advise string"
    return drained(values, "job-windows", "text").select(F.from_json("value", schema).alias("r")).select("r.*")


def job_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON sales in, JSON sums per seller and minute out."""
    records = _records(spark, sf_dir, sale_json)
    values = to_kafka_value(sales_job(records), columns=SALE_COLUMNS)
    decoded = drained(values, "job-sales", "text").select(decode_json(F.col("value"), AGGREGATED_SALE, True).alias("r"))
    return zone_free(decoded.select("r.*"))


def stream_queries() -> dict[str, Query]:
    by_day = ("1 day", "12 hours")
    return {
        "stream_tick_advice": _stream(stream_tick_advice, "user_id", "tick-advice"),
        "stream_tick_advice_by_type": _stream(stream_tick_advice, "event_type", "tick-advice"),
        "stream_adaptive": _stream(
            lambda t: stream_adaptive_average(t).select("symbol", "seq", "ema"), "user_id", "adaptive"
        ),
        "stream_latest_per_tick": _stream(stream_latest_per_tick, "user_id", "latest"),
        "stream_window_averages": _stream(
            lambda t: stream_window_averages(with_watermark(t), *by_day), "event_type", "window-averages"
        ),
        "stream_pane_windows": _stream(
            lambda t: stream_window_averages(with_watermark(t), "1 day", "1 hour"), "event_type", "pane-windows"
        ),
        "stream_window_advice": _stream(
            lambda t: stream_window_advice(with_watermark(t), *by_day), "event_type", "window-advice"
        ),
        "stream_window_sum": stream_window_sum,
        "stream_window_count": _stream(
            lambda t: window_count(with_watermark(t)), "event_type", "window-count"
        ),
        "stream_window_avg_row": _stream(_average_rows, "event_type", "window-average"),
        "stream_inactivity": _stream(
            lambda t: stream_inactive_keys(with_watermark(t)), "user_id", "inactivity"
        ),
        "stream_restart": _restarted(stream_tick_advice, "event_type", "restart"),
        "stream_restart_windows": _restarted(
            lambda t: stream_window_advice(with_watermark(t), *by_day), "event_type", "restart-windows"
        ),
        "stream_restart_inactivity": _restarted(
            lambda t: stream_inactive_keys(with_watermark(t)), "user_id", "restart-inactivity"
        ),
        "stream_late_windows": stream_late_windows,
        "stream_late_rows": stream_late_rows,
        "stream_changelog": stream_changelog,
        "stream_ttl_event_time": _restarted(
            lambda t: stream_tick_advice(with_watermark(t), expire_after="1 day"), "user_id", "ttl-event-time"
        ),
        "stream_state": stream_state,
        "stream_from_history": stream_from_history,
        "stream_rejects": stream_rejects,
        "stream_fan_out": stream_fan_out,
        "job_ticks": job_ticks,
        "job_windows": job_windows,
        "job_sales": job_sales,
    }
