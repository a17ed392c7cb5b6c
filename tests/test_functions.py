import random
from datetime import timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import at, seconds
from tidegauge.functions import (
    advice,
    alpha,
    decode_json,
    ema_step,
    emission_stamp,
    encode_json,
    event_time,
    fold_window,
    quarantine,
    to_number,
)
from tidegauge.operators.fold import gap_width
from tidegauge.schemas import SALE
from tidegauge.sources import decode_ticks, normalise_ticks

LINES = [
    '{"Close":100.0,"High":101.0,"Interest":0.0,"Low":99.0,"Open":100.0,"Time":"1704067200000","Volume":10.0,"Symbol":"AAA"}',
    '{"Id":1,"Close":100.0,"High":101.0,"Interest":0.0,"Low":99.0,"Open":100.0,"Time":"1704067200000","Volume":10.0,"Symbol":"AAA"}',
    '{"symbol":"AAA","close":100.0,"high":101.0,"interest":0.0,"low":99.0,"open":100.0,"time":"1704067200000","volume":10.0}',
    "not json",
]


def test_three_layouts_decode_alike(spark):
    rows = seconds(decode_ticks(spark.createDataFrame([(line,) for line in LINES], "value string"))).collect()
    tick = ("AAA", 0.0, None, 100.0, 101.0, 0.0, 99.0, 100.0, 10.0, None)
    assert tuple(rows[0]) == tick
    assert tuple(rows[1]) == (*tick[:2], 1, *tick[3:])
    assert tuple(rows[2]) == tick
    assert tuple(rows[3])[:-1] == (None,) * 9
    assert rows[3]["_unreadable"] == "not json"


def test_normalise_columns_of_either_case(spark):
    upper = spark.sql("select 1 Id, 2.0D Close, 3.0D High, 0.0D Interest, 1.0D Low, 2.0D Open, '1000' Time, 5.0D Volume, 'A' Symbol")
    lower = spark.sql("select float(2) close, 3.0D high, 0.0D interest, 1.0D low, 2.0D open, '1000' time, 5.0D volume, 'A' symbol")
    for frame, seq in ((upper, 1), (lower, None)):
        row = normalise_ticks(frame).withColumn("event_time", F.unix_micros("event_time")).first()
        assert tuple(row) == ("A", 1_000_000, seq, 2.0, 3.0, 0.0, 1.0, 2.0, 5.0)


def test_numbers(spark):
    texts = ["1.5", "x", None, "NaN", "Infinity", "-0.0", "1e3"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(to_number(F.col("t"))).collect()
    assert [r[0] for r in rows] == [1.5, None, None, None, None, 0.0, 1000.0]


def test_event_time_units(spark):
    row = spark.range(1).select(
        event_time(F.lit("1704067200123"), "ms").alias("ms"),
        event_time(F.lit(1704067200123), "ms").alias("long"),
        event_time(F.lit("1704067200.5"), "s").alias("s"),
        event_time(F.lit("2024-01-01 00:00:07"), "datetime").alias("text"),
        event_time(F.lit("soon"), "ms").alias("bad"),
        event_time(F.lit("soon"), "s").alias("bad_s"),
        event_time(F.lit("soon"), "datetime").alias("bad_text"),
    )
    got = tuple(seconds(row).first())
    assert got[:4] == pytest.approx((0.123, 0.123, 0.5, 7.0), abs=1e-6) and got[4:] == (None, None, None)
    with pytest.raises(ValueError):
        event_time(F.lit("1"), "weeks")


def test_stamps(spark):
    frame = spark.range(1).select(F.lit(at(5)).alias("t"))
    assert seconds(frame.select(emission_stamp("event", F.col("t")).alias("t"))).first()[0] == 5.0
    assert seconds(frame.select(emission_stamp("processing", F.col("t")).alias("t"))).first()[0] > 1e6
    with pytest.raises(ValueError):
        emission_stamp("never", F.col("t"))


def test_json_round_trip_and_quarantine(spark):
    sales = ['{"seller_id":"S1","amount_usd":5,"sale_ts":1704067200000}', "not json", '{"seller_id":"S2"}', None]
    frame = spark.createDataFrame([(s,) for s in sales], "value string")
    good, bad = quarantine(frame.withColumn("sale", decode_json(F.col("value"), SALE)), "sale")
    assert [tuple(r.sale) for r in good.collect()] == [("S1", 5, 1704067200000), ("S2", None, None)]
    assert [r.value for r in bad.collect()] == ["not json", None]
    again = good.select(encode_json("sale.*").alias("v")).collect()
    assert again[0].v == sales[0]
    with pytest.raises(Exception):
        frame.select(decode_json(F.col("value"), SALE, strict=True)).collect()


def test_one_step(spark):
    row = spark.range(1).select(ema_step(F.lit(110.0), F.lit(100.0), 10), ema_step(F.lit(7.0), F.lit(3.0), 1)).first()
    assert row[0] == 2 / 11 * 110.0 + (1 - 2 / 11) * 100.0 and row[1] == 7.0
    with pytest.raises(ValueError):
        alpha(0)


def test_advice_and_noise_limit(spark):
    cases = [(2.0, 1.0, 1.0, 2.0), (1.0, 2.0, 2.0, 1.0), (2.0, 1.0, 1.0, 1.0), (1.0 + 1e-12, 1.0, 1.0 - 1e-12, 1.0)]
    frame = spark.createDataFrame(cases, "f double, s double, fb double, sb double")
    columns = [F.col(c) for c in ("f", "s", "fb", "sb")]
    assert [r[0] for r in frame.select(advice(*columns)).collect()] == ["Buy", "Sell", "Stay", "Buy"]
    assert [r[0] for r in frame.select(advice(*columns, eps=1e-9)).collect()] == ["Buy", "Sell", "Stay", "Stay"]


def test_fold_of_a_collected_window(spark):
    frame = spark.sql(
        "select array(named_struct('event_time', 2, 'seq', 1, 'close', 110D), "
        "named_struct('event_time', 1, 'seq', 0, 'close', 100D)) as w"
    )
    row = frame.select(fold_window(F.col("w"), (10, 100)).alias("e")).first().e
    assert tuple(row) == (2 / 11 * 110 + (1 - 2 / 11) * 100, 2 / 101 * 110 + (1 - 2 / 101) * 100)


def test_gap_width_is_the_length_of_the_written_gap():
    chosen = [0, 1, 9, 10, 12, 99, 100, 120, 999_999, 1_000_000, 60_000_000, 86_399_999_999, 86_400_000_000, 90_061_500_000, -1]
    chosen += [random.Random(1).randrange(10**12) for _ in range(2000)]
    expected = []
    for micros in chosen:
        gap = timedelta(microseconds=micros)
        expected.append(len(str(gap.seconds + gap.microseconds / 1000000)))
    assert gap_width(np.array(chosen)).tolist() == expected
