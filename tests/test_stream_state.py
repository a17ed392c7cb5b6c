"""Panes, state, history, rejects and fan-out of streams, against plain versions."""

import json
import random
import time

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import START, at, plain_fold
from tidegauge.__main__ import RejectLog
from tidegauge.operators import last_averages, tick_advice, window_averages
from tidegauge.plans.jobs import REASON, judged_sales, judged_ticks, readable_ticks, rejected_sales, sales_rows
from tidegauge.plans.streamed import quarantined
from tidegauge.session import fresh_folder
from tidegauge.streaming import averages_in_state, state_rows, stream_tick_advice, stream_window_averages, with_watermark, write_files
from tidegauge.streaming.sinks import fan_out_once, folder_batch
from tidegauge.streaming.state_rows import BUCKET, CHUNK, CHUNKS, DATA, DEALT, NO_SEQ, RUNS, TICK, Ticks, dealt, in_order, packed, read_chunks, unpacked
from tidegauge.streaming.windowed import HELD

TICKS = "symbol string, event_time timestamp, seq bigint, close double"


def fed(spark, parts, build, name):
    """What a stream has written that gets one part after the other, a start each; and its checkpoint."""
    source, path, checkpoint = (fresh_folder(spark, f"{name}-{x}") for x in ("source", "out", "checkpoint"))
    for part in parts:
        spark.createDataFrame(part, TICKS).coalesce(1).write.mode("append").parquet(source)
        rows = build(spark.readStream.schema(TICKS).parquet(source))
        write_files(rows, path, checkpoint, once=True).awaitTermination()
    return spark.read.schema(rows.schema).parquet(path), checkpoint


def by_window(df):
    return sorted((r.symbol or "", r.window_start.timestamp(), r.ema10, r.ema100) for r in df.collect())


@pytest.mark.parametrize("size, slide", [("60 seconds", "10 seconds"), ("70 seconds", "30 seconds"), ("30 seconds", None), ("1 minute", "7 seconds")])
def test_panes_give_the_windows_of_the_table(spark, size, slide):
    rng = random.Random(1)
    rows = [(rng.choice(["A", "B", None]), at(rng.uniform(0, 400)), i if i % 9 else None, rng.uniform(1, 9)) for i in range(300)]
    rows += [("A", at(5), 1000, float("nan")), ("A", None, 1001, 1.0), ("END", at(2000), 1002, 1.0)]
    found, _ = fed(spark, [rows], lambda t: stream_window_averages(with_watermark(t), size, slide), "panes")
    whole = window_averages(spark.createDataFrame(rows, TICKS), size, slide)
    assert by_window(found) == by_window(whole.filter("symbol IS NULL OR symbol <> 'END'"))


def test_a_row_late_for_one_window_counts_in_those_open(spark):
    early = [("A", at(0), 1, 1.0), ("A", at(50), 2, 2.0), ("A", at(83), 3, 3.0)]  # the watermark is at 81
    late = [("A", at(55), 4, 9.0), ("A", at(10), 5, 99.0), ("END", at(900), 6, 1.0)]
    found, _ = fed(spark, [early, late], lambda t: stream_window_averages(with_watermark(t), "60 seconds", "30 seconds"), "late-panes")
    windows = {(r.symbol, int(r.window_start.timestamp() - START.timestamp())): r.ema10 for r in found.collect()}
    fold = lambda *prices: plain_fold(prices, 10, seed_step=False)[-1]
    assert windows == {("A", -30): fold(1.0), ("A", 0): fold(1.0, 2.0), ("A", 30): fold(2.0, 9.0, 3.0), ("A", 60): fold(3.0)}


def test_state_holds_each_tick_once(spark):
    rows = [("A", at(i / 10), i, float(i)) for i in range(1000)]
    _, checkpoint = fed(spark, [rows], lambda t: stream_window_averages(with_watermark(t, "10 minutes"), "60 seconds", "5 seconds"), "pane-state")
    data = spark.read.format("statestore").option("stateVarName", "ticks").load(checkpoint)
    assert data.agg(F.sum(F.octet_length("user_map_value.data"))).first()[0] == 24 * len(rows)


def test_windows_of_many_symbols_share_state(spark):
    rows = [(f"s{i}" if i else None, at(t + i % 7), i, float(i % 13 + t)) for i in range(1000) for t in (0, 45)] + [("END", at(5000), 1, 1.0)]
    windows = lambda t: stream_window_averages(with_watermark(t, "2 hours"), "60 seconds", "30 seconds")
    _, checkpoint = fed(spark, [rows], windows, "bucket-state")
    assert spark.read.format("statestore").option("stateVarName", "entries").load(checkpoint).count() <= 3 * DEALT  # of 2,001 symbols and panes
    found, _ = fed(spark, [rows], lambda t: stream_window_averages(with_watermark(t), "60 seconds", "30 seconds"), "bucket-windows")
    whole = window_averages(spark.createDataFrame(rows, TICKS), "60 seconds", "30 seconds")
    assert by_window(found) == by_window(whole.filter("symbol IS NULL OR symbol <> 'END'"))


def test_state_after_two_starts_and_a_start_from_history(spark):
    rows = [(s, at(i), i, float(i * k % 7)) for i in range(60) for k, s in ((3, "A"), (5, None))] + [("C", at(70), 1, 4.0)]
    early, late = [r for r in rows if r[1] < at(30)], [r for r in rows if r[1] >= at(30)]
    whole, checkpoint = fed(spark, [early, late], stream_tick_advice, "two-starts")
    wanted = sorted(map(str, last_averages(spark.createDataFrame(rows, TICKS)).collect()))
    assert sorted(map(str, averages_in_state(spark, checkpoint).collect())) == wanted
    history = last_averages(spark.createDataFrame(early, TICKS))
    found, _ = fed(spark, [late], lambda t: stream_tick_advice(t, history=history), "from-history")
    later = whole.filter(F.col("timestamp") >= F.lit(at(30)))
    assert sorted(map(str, found.collect())) == sorted(map(str, later.collect()))


def test_no_record_is_lost(spark):
    sale = {"seller_id": "s", "amount_usd": 5, "sale_ts": 1_700_000_000_000}
    without = lambda name: json.dumps({k: v for k, v in sale.items() if k != name})
    texts = [json.dumps(sale), '{"foo":1}', without("seller_id"), without("sale_ts"), without("amount_usd"), "no json", "[1]", "", None, '{"seller_id":"s","amount_usd":"x","sale_ts":1}']
    reasons = [None, "no_seller", "no_seller", "no_time", "no_amount", "unreadable", "unreadable", "unreadable", "unreadable", "unreadable"]
    values = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, seq bigint")
    found = {r.value: r[REASON] for r in judged_sales(values).collect()}
    assert found == dict(zip(texts, reasons))
    assert sales_rows(values).count() + rejected_sales(values).count() == len(texts)
    tick = {"Symbol": "A", "Time": "1700000000000", "Close": 1.5}
    texts = [json.dumps(tick), json.dumps({k.lower(): v for k, v in tick.items()}), json.dumps({**tick, "Close": "x"}), json.dumps({**tick, "Time": "soon"}), json.dumps({**tick, "Symbol": None}), '{"foo":1}', "x", None]
    values = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "value string, seq bigint")
    assert {r.value: r[REASON] for r in judged_ticks(values).collect()} == dict(zip(texts, [None, None, "no_price", "no_time", "no_symbol", "no_symbol", "unreadable", "unreadable"]))
    path = fresh_folder(spark, "reject-records")
    values.write.parquet(path)
    good, bad = quarantined(judged_ticks(spark.readStream.schema(values.schema).parquet(path)), "rejects")
    assert good.count() == 2 and bad.count() == 6


def test_a_failure_between_two_targets_repeats_only_what_is_missing(spark):
    source, first, second, ledger, checkpoint = (fresh_folder(spark, f"fan-{x}") for x in "abcde")
    calls = []

    def writer(name, fails=False):
        def write(df, batch):
            calls.append((name, batch))
            if fails:
                raise RuntimeError("target is away")
            folder_batch(first if name == "first" else second)(df, batch)

        return write

    def run(**targets):
        rows = spark.readStream.schema("n long").parquet(source)
        query = rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(fan_out_once(ledger, **targets)).start()
        query.awaitTermination()

    spark.range(5).withColumnRenamed("id", "n").write.parquet(source)
    with pytest.raises(Exception, match="target is away"):
        run(first=writer("first"), second=writer("second", fails=True))
    run(first=writer("first"), second=writer("second"))
    assert calls == [("first", 0), ("second", 0), ("second", 0)]
    spark.range(5, 8).withColumnRenamed("id", "n").write.mode("append").parquet(source)
    run(first=writer("first"), second=writer("second"))
    for path in (first, second):
        assert sorted(r.n for r in spark.read.parquet(path).collect()) == list(range(8))


def test_chunks_hold_every_tick(spark):
    rng = random.Random(5)
    rows = [(rng.choice(["A", "", None, "é"]), rng.randrange(50), i if i % 3 else None, rng.uniform(1, 9)) for i in range(2000)]
    rows += [("HOT", i // 2, i, float(i)) for i in range(25_000)]
    ticks = spark.createDataFrame(rows, "symbol string, event_time long, seq long, close double").repartition(4)
    chunks = packed(ticks)
    assert chunks.agg(F.max(F.octet_length("data"))).first()[0] <= 24 * CHUNK
    assert chunks.count() <= 4 * (5 + 3)  # a chunk per symbol and task, and more of the hot one
    found = []
    for symbol in ("A", "", None, "é", "HOT"):
        some = Ticks.of_chunks(chunks.filter(F.col("symbol").eqNullSafe(F.lit(symbol))).collect())
        found += [(symbol, *row) for row in some.rows(some.close)]
        assert list(some.micros) == sorted(some.micros)
    assert sorted(map(str, found)) == sorted(map(str, rows))
    assert packed(ticks.limit(0)).count() == 0


def test_buckets_hold_every_tick(spark):
    rng = random.Random(6)
    rows = [(rng.choice(["A", "", None, "é"]), rng.randrange(50), i if i % 3 else None, rng.uniform(1, 9)) for i in range(2000)]
    rows += [("HOT", i // 2, i, float(i)) for i in range(25_000)]
    ticks = spark.createDataFrame(rows, "symbol string, event_time long, seq long, close double").repartition(4)
    chunks = dealt(ticks).collect()
    assert max(len(c[DATA]) for c in chunks) <= TICK.itemsize * CHUNK
    found, of = [], {}
    for c in chunks:
        symbols, codes, some = read_chunks([(c[RUNS], c[DATA])])
        names = [symbols[code].as_py() for code in codes]
        assert all(of.setdefault(name, c[BUCKET]) == c[BUCKET] for name in names)
        found += [(name, t, None if seq == NO_SEQ else seq, close) for name, (t, seq, close) in zip(names, some.tolist())]
    assert sorted(map(str, found)) == sorted(map(str, rows))
    assert dealt(ticks.limit(0)).count() == 0


@pytest.mark.parametrize("spread, at_once", [(10_000, 500), (3, 500), (1, 64), (10_000, 100_000)])
def test_ticks_of_a_hot_symbol_are_put_in_order_piece_by_piece(monkeypatch, spread, at_once):
    monkeypatch.setattr(state_rows, "SORTED", at_once)
    monkeypatch.setattr(state_rows, "SAMPLED", 16)
    rng = np.random.default_rng(7)
    ticks = np.empty(5003, TICK)
    ticks["micros"], ticks["seq"], ticks["close"] = rng.integers(-spread, spread, 5003), rng.permutation(5003), np.arange(5003)
    ticks["seq"][::11] = NO_SEQ
    frames = [pd.DataFrame({DATA: [part.tobytes() for part in np.array_split(some, 9)]}) for some in np.array_split(ticks, 5)]
    pieces = list(in_order(iter(frames)))
    found = [(m, s) for piece in pieces for m, s in zip(piece.micros.tolist(), piece.seqs.tolist())]
    assert found == sorted(zip(ticks["micros"].tolist(), ticks["seq"].tolist()))
    assert sorted(c for piece in pieces for c in piece.close.tolist()) == ticks["close"].tolist()
    untied = max(np.unique(ticks[["micros", "seq"]], return_counts=True)[1])  # equal ones are not parted
    assert max(len(piece.close) for piece in pieces) <= 2 * at_once + 16 * len(frames) * 45 + untied
    assert list(in_order([])) == []


def test_a_hot_symbol_is_averaged_piece_by_piece(spark):
    n = 2 * state_rows.SORTED + 10
    ticks = spark.range(0, n, 1, 4).select(
        F.when(F.col("id") % 50_000 == 0, "B").otherwise("A").alias("symbol"), F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("id") * 7919 % n * 1000).alias("event_time"),
        F.col("id").alias("seq"), (F.col("id") * 31 % 97).cast("double").alias("close"),
    )
    source, path, checkpoint = (fresh_folder(spark, f"hot-{x}") for x in ("source", "out", "checkpoint"))
    ticks.write.parquet(source)
    rows = stream_tick_advice(spark.readStream.schema(TICKS).parquet(source))
    write_files(rows, path, checkpoint, once=True).awaitTermination()
    found, whole = spark.read.parquet(path), tick_advice(ticks)
    assert found.count() == n
    assert found.exceptAll(whole.select(*found.columns)).count() == 0


def test_a_hot_window_is_taken_in_piece_by_piece(spark):
    n, start = 600_000, 1_700_006_400_000_000  # all in one day and symbol
    ticks = spark.range(0, n, 1, 4).select(
        F.lit("A").alias("symbol"), F.timestamp_micros(F.lit(start) + F.col("id") * 7919 % n * 1000).alias("event_time"),
        F.col("id").alias("seq"), (F.col("id") * 31 % 97).cast("double").alias("close"),
    )
    after = spark.createDataFrame([("END", at(0), n, 1.0)], TICKS)
    source, path, checkpoint = (fresh_folder(spark, f"hot-window-{x}") for x in ("source", "out", "checkpoint"))
    ticks.unionByName(after).write.parquet(source)
    rows = stream_window_averages(with_watermark(spark.readStream.schema(TICKS).parquet(source)), "1 day")
    write_files(rows, path, checkpoint, once=True).awaitTermination()
    entries = spark.read.format("statestore").option("stateVarName", "ticks").option("batchId", 0).load(checkpoint)
    sizes = [r[0] // TICK.itemsize for r in entries.select(F.octet_length("user_map_value.data")).collect()]
    assert sum(sizes) == n + 1 and max(sizes) < HELD + CHUNK
    assert by_window(spark.read.parquet(path)) == by_window(window_averages(ticks, "1 day"))


def test_chunks_come_back_as_rows(spark):
    ticks = Ticks(np.array([3, 1, 2]), np.array([7, NO_SEQ, 9]), np.array([1.0, 2.0, float("nan")]))
    chunks = [(s, bytearray(c)) for s in ("A", None) for c in ticks.chunks({"x": ticks.close, "y": ticks.close * 2}, {"first_time": 1})]
    rows = unpacked(spark.createDataFrame(chunks, CHUNKS), ["x", "y"], ["first_time", "event_time", "seq"]).collect()
    wanted = [(s, 1, t, seq, x, x * 2) for s in ("A", None) for t, seq, x in ((1, None, 2.0), (2, 9, float("nan")), (3, 7, 1.0))]
    assert sorted(map(str, map(tuple, rows))) == sorted(map(str, wanted))


def test_a_stream_counts_the_records_it_leaves_out(spark):
    log = RejectLog()
    spark.streams.addListener(log)
    source = fresh_folder(spark, "counted")
    texts = ['{"seller_id":"s","amount_usd":5,"sale_ts":1700000000000}', '{"foo":1}', "no json"]
    spark.createDataFrame([(t,) for t in texts], "value string").write.parquet(source)
    for job in (sales_rows, lambda values: readable_ticks(values.withColumn("seq", F.lit(0).cast("long")))):
        rows = job(spark.readStream.schema("value string").parquet(source))
        query = write_files(rows, fresh_folder(spark, "counted-out"), fresh_folder(spark, "counted-checkpoint"), once=True)
        query.awaitTermination()
    for _ in range(100):  # listeners are told a little later
        if log.read == 6:
            break
        time.sleep(0.1)
    spark.streams.removeListener(log)
    assert (log.read, log.rejected) == (6, 5)
