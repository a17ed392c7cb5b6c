import json
import time

import pytest
from pyspark.sql import functions as F

from helpers import at, plain_fold, seconds, ticks
from tidegauge.operators import tick_advice, window_advice, window_averages, window_count
from tidegauge.plans import streamed
from tidegauge.plans.jobs import rejected, sales_job, start_to, tick_job, window_job
from tidegauge.session import prepare, ship_package
from tidegauge.sources import read_json_lines, table_events, ticks_from_events
from tidegauge.streaming import (
    changelog,
    print_rows,
    stream_adaptive_average,
    stream_inactive_keys,
    stream_tick_advice,
    stream_window_advice,
    stream_window_averages,
    with_watermark,
    write_files,
)

TICKS = "symbol string, event_time timestamp, seq bigint, close double"
LIMIT = 90


class Feed:
    """A folder read as a stream; each ``send`` is one file."""

    def __init__(self, spark, folder):
        self.spark, self.path, self.sent, self.files = spark, str(folder / "in"), 0, 0
        ship_package(spark)
        spark.createDataFrame([], TICKS).write.parquet(self.path)

    def send(self, *rows):
        """Rows (symbol, seconds, close)."""
        data = [(s, at(t), self.sent + i, c) for i, (s, t, c) in enumerate(rows)]
        self.spark.createDataFrame(data, TICKS).coalesce(1).write.mode("append").parquet(self.path)
        self.sent += len(rows)

    def read(self):
        return self.spark.readStream.schema(TICKS).parquet(self.path)

    def table(self):
        return self.spark.read.schema(TICKS).parquet(self.path)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def run(df, folder, name="out"):
    """Run until caught up; calling again goes on from the checkpoint."""
    out = str(folder / name)
    query = write_files(df, out, str(folder / f"{name}-checkpoint"), once=True)
    assert query.awaitTermination(LIMIT)
    return df.sparkSession.read.schema(df.schema).parquet(out)


def rows(df):
    return sorted(map(tuple, seconds(df).collect()), key=repr)


WALK = [100.0, 110.0, 120.0, 90.0, 60.0, 50.0, 80.0, 150.0, 160.0, 40.0]


def test_ticks_over_restarts_equal_the_table(feed, tmp_path):
    for start in (0, 4, 7):
        end = {0: 4, 4: 7, 7: 10}[start]
        feed.send(*[(s, i, WALK[i] * k) for i in range(start, end) for k, s in ((1, "A"), (2, "B"))])
        result = run(stream_tick_advice(feed.read()), tmp_path)
    assert rows(result) == rows(tick_advice(feed.table()))


def test_late_ticks_still_count_in_arrival_order(feed, tmp_path):
    feed.send(("A", 1000, 10.0))
    run(stream_tick_advice(feed.read()), tmp_path)
    feed.send(("A", 1, 20.0))
    result = run(stream_tick_advice(feed.read()), tmp_path)
    assert {r.seq: r.ema10 for r in result.collect()} == dict(enumerate(plain_fold([10.0, 20.0], 10)))


def test_zero_unset_and_missing_tie_breaker(feed, tmp_path):
    feed.send(("A", 0, 0.0), ("A", 1, 5.0), ("A", 2, None), ("A", 3, 6.0))
    unnumbered = feed.read().withColumn("seq", F.lit(None).cast("bigint"))
    result = run(stream_tick_advice(unnumbered, zero_unset=True), tmp_path)
    assert [r.ema10 for r in result.orderBy("timestamp").collect()] == plain_fold([5.0, 6.0], 10)


def test_windows_close_with_the_watermark(feed, tmp_path):
    feed.send(*[("A", 10.0 * i, WALK[i]) for i in range(10)])
    build = lambda: stream_window_averages(with_watermark(feed.read()), "30 seconds")
    run(build(), tmp_path)
    feed.send(("B", 500, 1.0))
    result = run(build(), tmp_path)
    expected = window_averages(feed.table(), "30 seconds").filter(F.col("symbol") == "A")
    assert rows(result) == rows(expected)


def test_late_row_counts_in_windows_still_open(feed, tmp_path):
    build = lambda: window_count(with_watermark(feed.read()), size="1 minute", slide="30 seconds")
    feed.send(("A", 65, 1.0))
    run(build(), tmp_path)  # watermark 63: windows up to 60 are closed
    feed.send(("A", 40, 1.0))
    run(build(), tmp_path)
    feed.send(("A", 500, 1.0))
    result = {(r.window_start, r.n) for r in seconds(run(build(), tmp_path)).collect()}
    assert result == {(30.0, 2), (60.0, 1)}


def test_window_advice_over_restarts(feed, tmp_path):
    build = lambda: stream_window_advice(with_watermark(feed.read()), "20 seconds")
    for start in (0, 3, 6):
        feed.send(*[("A", 10.0 * i + j, p * (j + 1)) for i, p in list(enumerate(WALK))[start : start + 3] for j in (0, 1)])
        run(build(), tmp_path)
    feed.send(("Z", 900, 1.0))
    result = run(build(), tmp_path)
    assert rows(result) == rows(window_advice(feed.table(), "20 seconds"))


def test_adaptive_stream(feed, tmp_path):
    feed.send(("A", 0, 10.0), ("A", 60, 20.0))
    run(stream_adaptive_average(feed.read()), tmp_path)
    feed.send(("A", 60.25, 30.0))
    result = run(stream_adaptive_average(feed.read()), tmp_path).orderBy("seq").collect()
    weight = 2 / 5
    second = weight * 20.0 + (1 - weight) * 10.0
    assert [r.ema for r in result] == [10.0, second, weight * 30.0 + (1 - weight) * second]


def test_silence_fires_once_and_overtaken_timers_do_not(feed, tmp_path):
    build = lambda: stream_inactive_keys(with_watermark(feed.read()))
    feed.send(("A", 0, 1.0), ("B", 0, 5.0))
    run(build(), tmp_path)
    feed.send(("A", 8, 2.0))
    run(build(), tmp_path)
    feed.send(("C", 15, 9.0))  # watermark 13: B has run out, A has not
    assert rows(run(build(), tmp_path)) == [("B", 0.0, 0.0, 1, 10.0, 5.0)]
    feed.send(("C", 40, 9.0))
    result = rows(run(build(), tmp_path))
    assert ("A", 0.0, 8.0, 2, 18.0, 2.0) in result and ("B", 0.0, 0.0, 1, 10.0, 5.0) in result
    assert len([r for r in result if r[0] == "A"]) == 1


def _until(condition):
    deadline = time.time() + LIMIT
    while not condition():
        assert time.time() < deadline
        time.sleep(0.5)


def test_state_that_expires(spark, feed, tmp_path):
    feed.send(("A", 0, 10.0))
    out = str(tmp_path / "ttl")
    df = stream_tick_advice(feed.read(), ttl_ms=5_000)
    query = write_files(df, out, str(tmp_path / "ttl-checkpoint"), every="500 milliseconds")

    def found():
        return {r.seq: r.ema10 for r in spark.read.schema(df.schema).parquet(out).collect()}

    try:
        _until(lambda: (tmp_path / "ttl").exists() and 0 in found())
        time.sleep(8)
        feed.send(("A", 1, 20.0))
        _until(lambda: 1 in found())
    finally:
        query.stop()
    assert found() == {0: 10.0, 1: 20.0}


def _lines(folder, name, records):
    path = folder / name
    path.mkdir()
    (path / "part-0.json").write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in records))
    return str(path)


def tick_record(symbol, t, close):
    fields = dict(Close=close, High=close, Interest=0.0, Low=close, Open=close, Volume=1.0, Symbol=symbol)
    return {**fields, "Time": str(int(at(t).timestamp() * 1000))}


def test_tick_job_on_text(spark, tmp_path):
    records = [tick_record("A", i, p) for i, p in enumerate(WALK)] + ["not json"]
    path = _lines(tmp_path, "records", records)
    ship_package(spark)
    values = read_json_lines(spark, path, streaming=True).withColumn("seq", F.lit(0).cast("bigint"))
    table = read_json_lines(spark, path).withColumn("seq", F.lit(0).cast("bigint"))
    result = run(tick_job(values, stamp="event"), tmp_path, "ticks")
    assert rows(result) == rows(tick_job(table, stamp="event")) and result.count() == len(WALK)
    assert [r.value for r in rejected(table).collect()] == ["not json"]
    windows = window_job(table, "4 seconds", "2 seconds", stamp="event")
    streamed = run(window_job(values, "4 seconds", "2 seconds", stamp="event"), tmp_path, "windows")
    assert set(rows(streamed)) < set(rows(windows)) and streamed.count()


def test_sales_job_to_two_writers(spark, tmp_path):
    base = int(at(0).timestamp() * 1000)
    records = [{"seller_id": "S", "amount_usd": a, "sale_ts": base + t} for a, t in ((1, 0), (2, 59_999), (4, 60_000), (8, 200_000))]
    values = read_json_lines(spark, _lines(tmp_path, "sales", [*records, "not json"]), streaming=True)
    first, second = [], []
    query = start_to(
        sales_job(values),
        str(tmp_path / "checkpoint"),
        lambda df, batch: first.extend(rows(df)),
        lambda df, batch: second.extend(rows(df)),
    )
    try:
        _until(lambda: len(second) == 2)
    finally:
        query.stop()
    assert first == second == [("S", 0.0, 60.0, 3), ("S", 60.0, 120.0, 4)]


def test_changelog_early_and_final(feed, tmp_path):
    feed.send(("A", 0, 1.0), ("A", 1, 1.0))
    seen = {True: [], False: []}
    for early, found in seen.items():
        counts = window_count(with_watermark(feed.read()))
        query = changelog(counts, lambda df, batch: found.extend(rows(df)), str(tmp_path / f"log-{early}"), early)
        query.processAllAvailable()
        query.stop()
    assert seen == {True: [("A", 0.0, 30.0, 2)], False: []}


def test_print(feed):
    feed.send(("A", 0, 1.0))
    query = print_rows(feed.read(), rows=5)
    query.processAllAvailable()
    progress = query.lastProgress
    query.stop()
    assert query.exception() is None and "Console" in progress.sink.description


def test_restarted_streams_use_what_they_kept(spark, monkeypatch):
    events = table_events(prepare(spark), "/root/testdata/sf0.001")
    parts, started = streamed.halves(events), []
    monkeypatch.setattr(streamed, "write_files", lambda *a, **k: started.append(write_files(*a, **k)) or started[-1])
    build = lambda some: stream_tick_advice(ticks_from_events(some, "event_type"))
    rows = streamed.restarted(build, parts, "restart-test").count()
    assert [sum(p["numInputRows"] for p in query.recentProgress) for query in started] == [part.count() for part in parts]
    assert all(part.count() for part in parts) and rows == events.count()


def test_halves_of_odd_tables(spark):
    events = table_events(prepare(spark), "/root/testdata/sf0.001")
    assert [part.count() for part in streamed.halves(events.limit(0))] == [0, 0]
    timeless = events.limit(5).withColumn("ts", F.lit(None).cast("timestamp_ntz"))
    assert sum(part.count() for part in streamed.halves(timeless.unionByName(events.limit(1)))) == 6
