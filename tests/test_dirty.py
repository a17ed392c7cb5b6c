"""The same answer whatever the size, layout or slicing of the input, and whatever bad rows are in it."""

import json

import pytest
from pyspark.sql import functions as F

from helpers import TICKS, at
from tidegauge.operators import adaptive_average, inactive_keys, latest_per_tick, running_averages
from tidegauge.operators.skew import SkewPolicy
from tidegauge.plans.jobs import readable_ticks, rejected
from tidegauge.sources.ticks import stream_events, table_events
from tidegauge.streaming.lateness import with_watermark
from tidegauge.streaming.sinks import write_files
from tidegauge.streaming.stateful import stream_inactive_keys, stream_latest_per_tick

CUT = SkewPolicy(hot_rows=1, run_rows=4)
BAD = [("a", None, 9.0), ("a", 3, None), ("a", 4, float("nan")), ("b", 5, float("inf")), ("b", None, None), (None, 1, 2.0)]


def dirty(spark):
    good = [(s, t * 7 % 90, 100 + t % 3) for t in range(40) for s in ("a", "b")]
    rows = [(s, None if t is None else at(t), i, None if c is None else float(c)) for i, (s, t, c) in enumerate(BAD + good)]
    return spark.createDataFrame(rows, TICKS)


def result(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("operator", [latest_per_tick, running_averages, adaptive_average, inactive_keys])
def test_cut_and_uncut_agree_and_skip_bad_rows(spark, operator):
    ticks = dirty(spark)
    clean = ticks.filter("event_time IS NOT NULL AND close IS NOT NULL AND NOT isnan(close) AND abs(close) < 1e300")
    extra = {"span": 10} if operator is adaptive_average else {}
    try:
        whole = result(operator(ticks, **extra))
        assert whole == result(operator(ticks, policy=CUT, **extra)) == result(operator(clean, **extra))
    except TypeError:
        whole = result(operator(ticks))
        assert whole == result(operator(ticks, policy=CUT)) == result(operator(clean))


def test_a_table_of_part_files_streams_like_one_file(spark, tmp_path):
    events = table_events(spark, "/root/testdata/sf0.001")
    folder = tmp_path / "sf"
    events.repartition(3).write.parquet(str(folder / "events.parquet"))
    out = str(tmp_path / "out")
    write_files(stream_events(spark, str(folder)), out, str(tmp_path / "checkpoint"), once=True).awaitTermination()
    assert spark.read.parquet(out).count() == events.count()


def _sliced(spark, ticks, folder, operator, batches):
    """The operator over a stream that gives the ticks, by time, in so many micro-batches."""
    rows = sorted(ticks.collect(), key=lambda r: (r.event_time, r.seq))
    for i in range(batches):
        part = rows[i * len(rows) // batches : (i + 1) * len(rows) // batches]
        spark.createDataFrame(part, TICKS).coalesce(1).write.mode("append").parquet(str(folder / "in"))
    stream = spark.readStream.schema(TICKS).option("maxFilesPerTrigger", 1).parquet(str(folder / "in"))
    out = str(folder / "out")
    query = write_files(operator(stream), out, str(folder / "checkpoint"), once=True)
    query.awaitTermination()
    assert sum(p["numInputRows"] > 0 for p in query.recentProgress) >= batches
    return spark.read.parquet(out)


@pytest.mark.parametrize("batches", [1, 4])
def test_silence_does_not_depend_on_slicing(spark, tmp_path, batches):
    times = {"a": [0, 3, 20, 21, 50, 95], "b": [1, 11, 40, 99], "c": [60]}
    rows = [(s, at(t), i, float(t)) for i, (s, t) in enumerate((s, t) for s in times for t in times[s])]
    ticks = spark.createDataFrame(rows, TICKS)
    found = _sliced(spark, ticks, tmp_path, lambda t: stream_inactive_keys(with_watermark(t)), batches)
    table = inactive_keys(ticks).filter((F.col("event_time") < F.lit(at(85))))
    assert result(found.select(*table.columns)) == result(table)


@pytest.mark.parametrize("batches", [1, 3])
def test_latest_does_not_depend_on_slicing(spark, tmp_path, batches):
    ticks = dirty(spark).filter("symbol IS NOT NULL AND event_time IS NOT NULL")
    found = _sliced(spark, ticks, tmp_path, stream_latest_per_tick, batches)
    assert result(found) == result(latest_per_tick(ticks))


def test_bad_records_are_rejected_with_their_text(spark):
    good = {"Close": 1.5, "High": 1, "Interest": 0, "Low": 1, "Open": 1, "Time": "1704067200000", "Volume": 1, "Symbol": "A"}
    wrong = [{"foo": 1}, good | {"Time": "soon"}, good | {"Close": "x"}, good | {"Close": None}, good | {"Symbol": None}, good | {"Close": "NaN"}]
    texts = [json.dumps(x) for x in [good, good | {"Close": "12.5"}, *wrong]] + ["not json", "[]"]
    values = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, seq long")
    assert [r.close for r in readable_ticks(values).orderBy("seq").collect()] == [1.5, 12.5]
    assert {r.value for r in rejected(values).collect()} == set(texts[2:])
