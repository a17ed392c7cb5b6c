"""Expiry in event time, late rows, changelogs and functions over windows, against plain versions."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import START, at, plain_fold
from test_stream_state import TICKS, fed
from tidegauge.operators import SkewPolicy, tick_advice, window_drawdown
from tidegauge.session import fresh_folder
from tidegauge.streaming import compacted, judged_lateness, stream_tick_advice, stream_window_changes, with_watermark
from tidegauge.streaming.sinks import folder_batch, split_by
from tidegauge.streaming.state_rows import DEALT


def walk(rng, n, symbols=("A", "B", None)):
    time, rows = 0.0, []
    for i in range(n):
        time += rng.choice([1, 2, 5, 60, 90])
        rows.append((rng.choice(symbols), at(time), i, rng.uniform(1, 9)))
    return rows


def plain_expiring(rows, expire):
    out = {}
    for symbol in {r[0] for r in rows}:
        island, last = [], None
        for _, time, seq, close in sorted((r for r in rows if r[0] == symbol), key=lambda r: r[1:3]):
            if last is not None and (time - last).total_seconds() >= expire:
                island = []
            island.append(close)
            last = time
            out[seq] = (plain_fold(island, 10)[-1], plain_fold(island, 100)[-1])
    return out


@pytest.mark.parametrize("policy", [SkewPolicy(), SkewPolicy(hot_rows=50, run_rows=20, max_runs=16)])
def test_averages_start_again_after_a_gap(spark, policy):
    rows = walk(random.Random(1), 400)
    found = tick_advice(spark.createDataFrame(rows, TICKS), expire_after="90 seconds", policy=policy)
    assert {r.seq: (r.ema10, r.ema100) for r in found.collect()} == plain_expiring(rows, 90)
    assert tick_advice(spark.createDataFrame([], TICKS), expire_after="90 seconds").count() == 0
    with pytest.raises(ValueError):
        tick_advice(spark.createDataFrame(rows, TICKS), expire_after="90 seconds", zero_unset=True)


@pytest.mark.parametrize("cuts", [[], [200], [50, 60, 300]])
def test_streams_start_again_alike_however_they_are_sliced(spark, cuts):
    rows = walk(random.Random(2), 400)
    parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
    found, checkpoint = fed(spark, parts, lambda t: stream_tick_advice(with_watermark(t, "2 seconds"), expire_after="90 seconds"), "expiring")
    assert {r.seq: (r.ema10, r.ema100) for r in found.collect()} == plain_expiring(rows, 90)


def test_the_timer_drops_state(spark):
    rows = [("A", at(0), 1, 1.0), ("B", at(500), 2, 1.0)]
    _, checkpoint = fed(spark, [rows], lambda t: stream_tick_advice(with_watermark(t), expire_after="90 seconds"), "expired")
    left = spark.read.format("statestore").option("stateVarName", "last").load(checkpoint)
    assert [r.symbol for r in left.select("key.symbol").collect()] == ["B"]


def test_late_rows_are_told_and_none_is_lost(spark):
    early = [("A", at(t), t, 1.0) for t in range(0, 100, 10)] + [("A", None, 1000, 1.0)]  # the watermark is at 88
    late = [("A", at(59.9), 2000, 1.0), ("A", at(60), 2001, 1.0), (None, at(0), None, float("nan")), ("B", at(200), 2003, 1.0)]
    found, _ = fed(spark, [early, late], lambda t: judged_lateness(with_watermark(t), "30 seconds"), "lateness")
    rows = [(r.symbol, r.seq, r.reason) for r in found.collect()]
    told = [("A", t, None) for t in range(0, 100, 10)] + [("A", 1000, "no_time"), ("A", 2000, "late"), ("A", 2001, None), (None, None, "late"), ("B", 2003, None)]
    assert sorted(rows, key=str) == sorted(told, key=str)
    sliding, _ = fed(spark, [early, late], lambda t: judged_lateness(with_watermark(t), "60 seconds", "30 seconds"), "lateness")
    assert sorted(r.seq for r in sliding.collect() if r.reason == "late" and r.seq) == []
    good, bad = (fresh_folder(spark, side) for side in ("good", "bad"))
    split_by("reason", folder_batch(good), folder_batch(bad))(found, 0)
    assert (spark.read.parquet(good).count(), spark.read.parquet(bad).count()) == (12, 3)


def test_changes_add_up_in_any_slicing(spark):
    rng = random.Random(3)
    rows = [(rng.choice(["A", "B", None]), at(rng.uniform(0, 300)), i, float(rng.randint(-9, 9))) for i in range(300)] + [("A", None, 1, 5.0)]
    parts = [rows[:100], rows[100:101], rows[101:]]
    found, _ = fed(spark, parts, lambda t: stream_window_changes(with_watermark(t, "1 hour"), "symbol", "close"), "changes")
    wanted = {}
    for symbol, time, _, close in rows[:-1]:
        window = (symbol, int((time - START).total_seconds() // 60))
        wanted[window] = wanted.get(window, 0) + int(close)
    table = compacted(found.unionByName(found), ["symbol", "window_start"]).select("symbol", F.unix_seconds("window_start").alias("at"), "close")
    assert {(r.symbol, (r["at"] - int(START.timestamp())) // 60): r.close for r in table.collect()} == wanted
    sums, last = {}, {}
    for r in found.select("symbol", (F.unix_seconds("window_start") - int(START.timestamp())).alias("at"), "close", "change", "version").collect():
        window = (r.symbol, r["at"] // 60)
        sums[window] = sums.get(window, 0) + (-r.close if r.change == "retract" else r.close)
        assert (r.version == 0) == (r.change == "insert")
        if r.change != "retract" and r.version >= last.get(window, (-1, 0))[0]:
            last[window] = (r.version, r.close)
    assert sums == wanted and {w: c for w, (_, c) in last.items()} == wanted
    assert found.filter("change = 'retract'").count() > 0


def test_sums_of_many_keys_share_state(spark):
    rows = [(f"s{i}" if i else None, at(60 * t + i % 50), i, float(i + t)) for i in range(1000) for t in range(3)]
    late = [("s1", at(7), 1, 5.0), ("s1", at(130), 1, 5.0), ("END", at(50_000), 1, 1.0)]  # the watermark is at 109
    changes = lambda t: stream_window_changes(with_watermark(t, "1 minute"), "symbol", "close")
    found, checkpoint = fed(spark, [rows, late], changes, "many-keys")
    state = spark.read.format("statestore").option("stateVarName", "sums")
    assert DEALT // 2 < state.option("batchId", 0).load(checkpoint).count() <= 2 * DEALT  # of 3,000 sums
    assert spark.read.format("statestore").option("stateVarName", "sums").load(checkpoint).count() == 1  # the last row's
    table = compacted(found, ["symbol", "window_start"]).filter("symbol IS NULL OR symbol <> 'END'")
    sums = {(r.symbol, (int(r.window_start.timestamp()) - int(START.timestamp())) // 60): r.close for r in table.collect()}
    wanted = {(s, int((time - START).total_seconds()) // 60): int(close) for s, time, _, close in rows}
    assert sums == wanted | {("s1", 2): 3 + 5}


def test_largest_fall_within_windows(spark):
    rng = random.Random(4)
    rows = [(rng.choice(["A", "B", None]), at(rng.uniform(0, 600)), i, rng.uniform(1, 9)) for i in range(500)]
    rows += [("A", at(1), 1000, float("nan")), ("A", None, 1001, 1.0)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)  # windows cover many batches
    try:
        found = window_drawdown(spark.createDataFrame(rows, TICKS), "60 seconds", "30 seconds").select("symbol", F.unix_seconds("window_start").alias("start"), "drawdown").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    wanted = {}
    for symbol in ("A", "B", None):
        for start in range(-30, 600, 30):
            prices = [c for s, t, _, c in sorted(rows[:500], key=lambda r: r[1]) if s == symbol and start <= (t - START).total_seconds() < start + 60]
            if prices:
                wanted[symbol, start] = max(max(prices[: i + 1]) - p for i, p in enumerate(prices))
    assert {(r.symbol, r.start - int(START.timestamp())): r.drawdown for r in found} == wanted
