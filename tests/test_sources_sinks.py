import json

import pytest
from pyspark.sql import functions as F

from helpers import START, seconds, ticks
from tidegauge.__main__ import arguments
from tidegauge.operators import tick_advice, window_sum
from tidegauge.plans.jobs import ADVICE_COLUMNS, SALE_COLUMNS
from tidegauge.schemas import ADVICE, AGGREGATED_SALE, TICK
from tidegauge.session import ROCKSDB_PROVIDER, fresh_folder, pin_utc, shared_folder, use_rocksdb
from tidegauge.sources import kafka_reader_options, ticks_from_events
from tidegauge.sources.ticks import table_events
from tidegauge.streaming import JdbcTarget, fan_out, kafka_writer_options, to_kafka_value, write_jdbc


def test_kafka_options():
    assert kafka_reader_options() == {
        "kafka.bootstrap.servers": "localhost:9092",
        "subscribe": "xcse",
        "startingOffsets": "earliest",
    }
    assert kafka_reader_options(group="mine")["kafka.group.id"] == "mine"
    assert kafka_reader_options(start="latest", group=None, max_offsets=5) == {
        "kafka.bootstrap.servers": "localhost:9092",
        "subscribe": "xcse",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "5",
    }
    assert kafka_reader_options(start="committed")["startingOffsets"] == "earliest"
    with pytest.raises(ValueError):
        kafka_reader_options(start="yesterday")
    assert kafka_writer_options("h:1", "t") == {"kafka.bootstrap.servers": "h:1", "topic": "t"}


def test_advice_as_kafka_value(spark):
    advised = tick_advice(ticks(spark, [("A", 0, 100.0)]))
    value = to_kafka_value(advised, epoch=["timestamp"], columns=ADVICE_COLUMNS).first().value
    assert json.loads(value) == {"symbol": "A", "timestamp": 1704067200, "ema10": 100.0, "ema100": 100.0, "advise": "Stay"}
    assert list(json.loads(value)) == ADVICE.names
    millis = to_kafka_value(advised, epoch=["timestamp"], unit="ms").first().value
    assert json.loads(millis)["timestamp"] == 1704067200000


def test_sales_as_kafka_value(spark):
    sales = ticks(spark, [("S", 0, 1.0)]).selectExpr("symbol seller_id", "3 amount_usd", "event_time")
    value = json.loads(to_kafka_value(window_sum(sales), columns=SALE_COLUMNS).first().value)
    assert list(value) == AGGREGATED_SALE.names
    assert value["window_start"].startswith("2024-01-01T00:00:00") and value["aggregated_amount"] == 3


def test_jdbc_options_retries_and_batch_number(spark):
    calls = []

    def append(df, options):
        calls.append((df.columns, options))
        if len(calls) < 3:
            raise OSError("down")

    target = JdbcTarget("jdbc:x", "t", {"user": "u"}, pause_seconds=0, batch_column="batch")
    write_jdbc(target, append)(spark.range(1), 7)
    assert len(calls) == 3
    assert calls[0] == (
        ["id", "batch"],
        {"user": "u", "url": "jdbc:x", "dbtable": "t", "batchsize": "20", "numPartitions": "8"},
    )


def test_jdbc_gives_up_after_the_retries(spark):
    calls = []

    def append(df, options):
        calls.append(1)
        raise OSError("down")

    with pytest.raises(OSError):
        write_jdbc(JdbcTarget("jdbc:x", "t", pause_seconds=0), append)(spark.range(1), 0)
    assert len(calls) == 6


def test_fan_out_keeps_and_releases_the_batch(spark):
    seen = []
    df = spark.range(3)
    fan_out(lambda d, b: seen.append((d.is_cached, d.count(), b)), lambda d, b: seen.append((d.is_cached, d.count(), b)))(df, 4)
    assert seen == [(True, 3, 4), (True, 3, 4)] and not df.is_cached


def test_command_line():
    args = arguments(["ticks", "--kafka-brokers", "h:1", "--topics-in", "a", "--topics-out", "b", "--checkpoint", "c"])
    assert (args.kafka_brokers, args.topics_in, args.topics_out, args.kafka_group_id) == ("h:1", "a", "b", None)
    assert arguments(["sales", "--checkpoint", "c"]).topics_in == "xcse"
    for wrong in (["nothing", "--checkpoint", "c"], ["ticks"]):
        with pytest.raises(SystemExit):
            arguments(wrong)


def test_shared_folder_and_settings(spark):
    assert spark.sparkContext.getCheckpointDir() is not None or shared_folder(spark)
    assert fresh_folder(spark, "x") != fresh_folder(spark, "x")
    use_rocksdb(spark)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == ROCKSDB_PROVIDER


def test_event_times_do_not_depend_on_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    pin_utc(spark)
    events = table_events(spark, "/root/testdata/sf0.001")
    frame = ticks_from_events(events).select(F.unix_micros("event_time").alias("t"), "seq").orderBy("seq")
    expected = events.orderBy("event_id").first().ts
    assert frame.first().t == int((expected - START.replace(tzinfo=None)).total_seconds() * 1e6) + int(START.timestamp() * 1e6)
    assert [f.name for f in TICK][:4] == ticks_from_events(events).columns
    assert seconds(ticks_from_events(events)).count() == 1000
