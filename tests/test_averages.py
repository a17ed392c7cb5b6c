import random

import pytest
from pyspark.sql import functions as F

from helpers import at, plain_advice, plain_fold, seconds, ticks
from tidegauge.operators import (
    SkewPolicy,
    adaptive_average,
    block_average,
    running_averages,
    tick_advice,
    window_advice,
    window_averages,
)

GOLDEN = [
    (100, 100.0, 100.0, "Stay"),
    (110, 101.81818181818181, 100.19801980198021, "Stay"),
    (120, 105.12396694214874, 100.59013822174298, "Stay"),
    (90, 102.37415477084896, 100.38043251438172, "Stay"),
    (60, 94.66976299433095, 99.58081998934445, "Sell"),
    (50, 86.5479879044526, 98.59902157371386, "Stay"),
    (80, 85.35744464909757, 98.23072411680863, "Stay"),
    (150, 97.11063653107982, 99.25585829271341, "Stay"),
    (160, 108.54506625270167, 100.4587125839468, "Buy"),
]


def by_seq(df, *columns):
    return [tuple(r) for r in df.orderBy("seq").select(*columns).collect()]


def test_golden_sequence(spark):
    frame = ticks(spark, [("AAA", i, float(row[0])) for i, row in enumerate(GOLDEN)])
    assert by_seq(tick_advice(frame), "ema10", "ema100", "advise") == [row[1:] for row in GOLDEN]


def test_symbols_do_not_mix_even_with_one_first_letter(spark):
    rows = [(symbol, i, float(row[0] * k)) for i, row in enumerate(GOLDEN) for k, symbol in ((1, "AB"), (3, "AC"))]
    result = tick_advice(ticks(spark, rows))
    for k, symbol in ((1, "AB"), (3, "AC")):
        prices = [float(row[0] * k) for row in GOLDEN]
        got = by_seq(result.filter(F.col("symbol") == symbol), "ema10", "advise")
        assert got == list(zip(plain_fold(prices, 10), plain_advice(prices)))


def test_late_rows_take_their_place_and_ties_go_by_seq(spark):
    frame = ticks(spark, [("A", 5, 3.0), ("A", 1, 1.0), ("A", 5, 4.0), ("A", 3, 2.0)])
    assert sorted(by_seq(running_averages(frame, (10,)), "ema10")) == sorted((v,) for v in plain_fold([1.0, 2.0, 3.0, 4.0], 10))


def test_missing_prices_are_skipped(spark):
    frame = ticks(spark, [("A", 0, 1.0), ("A", 1, None), ("A", 2, 5.0), ("B", 0, None)])
    assert by_seq(running_averages(frame, (10,)), "seq", "ema10") == [(0, 1.0), (2, plain_fold([1.0, 5.0], 10)[1])]


def test_null_symbol_is_a_symbol(spark):
    frame = ticks(spark, [(None, 0, 1.0), ("A", 0, 9.0), (None, 1, 5.0)])
    for policy in (SkewPolicy(), SkewPolicy(hot_rows=1, run_rows=1)):
        got = by_seq(running_averages(frame, (10,), policy=policy), "seq", "ema10")
        assert got == [(0, 1.0), (1, 9.0), (2, plain_fold([1.0, 5.0], 10)[1])]


@pytest.mark.parametrize("prices", [[0.0, 5.0, 6.0], [0.0, 0.0, 7.0], [4.0, -22.0, 3.0, 1.0]])
def test_zero_as_unset(spark, prices):
    frame = ticks(spark, [("A", i, p) for i, p in enumerate(prices)])
    fast = plain_fold(prices, 10, zero_unset=True)
    expected = [(i, e, a) for i, (e, a) in enumerate(zip(fast, plain_advice(prices, zero_unset=True))) if e != 0.0]
    assert by_seq(tick_advice(frame, zero_unset=True), "seq", "ema10", "advise") == expected
    plain = list(zip(range(len(prices)), plain_fold(prices, 10), plain_advice(prices)))
    assert by_seq(tick_advice(frame), "seq", "ema10", "advise") == plain


def test_spans_one_and_constant_prices(spark):
    frame = ticks(spark, [("A", i, p) for i, p in enumerate([3.0, 8.0, 5.0])])
    assert by_seq(running_averages(frame, (1,)), "ema1") == [(3.0,), (8.0,), (5.0,)]
    flat = ticks(spark, [("A", i, 0.1) for i in range(300)])
    assert all(abs(v - 0.1) < 1e-15 for (v,) in by_seq(running_averages(flat, (50,)), "ema50"))


def _walk(seed, rows, low=-50.0, high=80.0):
    draw = random.Random(seed)
    return [round(draw.uniform(low, high), 2) * draw.choice([0, 1, 1, 1]) for _ in range(rows)]


@pytest.mark.parametrize("zero_unset", [False, True])
@pytest.mark.parametrize("spans", [(10, 100), (3, 5000)])
def test_hot_symbols_in_runs_agree_to_the_last_bit(spark, spans, zero_unset):
    """Runs far shorter than the longer span, so bounds need several rounds."""
    series = {"hot": _walk(1, 1500), "warm": _walk(2, 400, 1.0, 2.0), "cold": _walk(3, 20)}
    frame = ticks(spark, [(s, i, p) for s, prices in series.items() for i, p in enumerate(prices)])
    policy = SkewPolicy(hot_rows=100, run_rows=150)
    result = tick_advice(frame, spans, zero_unset=zero_unset, policy=policy)
    names = [f"ema{span}" for span in spans]
    for symbol, prices in series.items():
        got = by_seq(result.filter(F.col("symbol") == symbol), *names, "advise")
        folds = [plain_fold(prices, span, zero_unset=zero_unset) for span in spans]
        rows = list(zip(*folds, plain_advice(prices, spans, zero_unset)))
        assert got == [row for row in rows if not zero_unset or row[0] != 0.0]


def test_more_symbols_over_the_limit_than_may_be_hot(spark):
    series = {f"s{k}": _walk(k, 60 + k) for k in range(6)}
    frame = ticks(spark, [(s, i, p) for s, prices in series.items() for i, p in enumerate(prices)])
    result = running_averages(frame, (10,), policy=SkewPolicy(hot_rows=50, max_hot=2, run_rows=20, max_runs=3))
    for symbol, prices in series.items():
        got = by_seq(result.filter(F.col("symbol") == symbol), "ema10")
        assert [v for (v,) in got] == plain_fold(prices, 10)


def test_many_batches_in_one_task(spark):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        prices = _walk(5, 1000)
        frame = ticks(spark, [("A", i, p) for i, p in enumerate(prices)])
        for policy in (SkewPolicy(), SkewPolicy(hot_rows=10, run_rows=90)):
            assert [v for (v,) in by_seq(running_averages(frame, (10,), policy=policy), "ema10")] == plain_fold(prices, 10)
            whole = window_averages(frame, "1 day", policy=policy).collect()
            assert [r.ema10 for r in whole] == [plain_fold(prices, 10, seed_step=False)[-1]]
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def _plain_adaptive(times, prices):
    out, last = [], None
    for i, price in enumerate(prices):
        if last is None:
            last = price
        else:
            gap = at(times[i]) - at(times[i - 1])
            weight = 2 / (len(str(gap.seconds + gap.microseconds / 1000000)) + 1)
            last = weight * price + (1 - weight) * last
        out.append(last)
    return out


def test_adaptive_average(spark):
    draw = random.Random(7)
    times, moment = [], 0.0
    for gap in [0.5, 60, 86_460, 0.000001, 0.000012, 0.25] + [round(draw.uniform(0, 90_000), 6) for _ in range(200)]:
        times.append(moment)
        moment = round(moment + gap, 6)
    prices = _walk(8, len(times))
    frame = ticks(spark, [("A", t, p) for t, p in zip(times, prices)])
    for policy in (SkewPolicy(), SkewPolicy(hot_rows=10, run_rows=30)):
        assert [v for (v,) in by_seq(adaptive_average(frame, policy), "ema")] == _plain_adaptive(times, prices)


@pytest.mark.parametrize("span", [1, 2, 10, 100, 3000])
def test_block_scan_is_close(spark, span):
    series = {"hot": _walk(1, 1500, 10.0, 90.0), "cold": _walk(3, 20, 10.0, 90.0)}
    frame = ticks(spark, [(s, i, p) for s, prices in series.items() for i, p in enumerate(prices)])
    for policy in (SkewPolicy(), SkewPolicy(hot_rows=100, run_rows=150)):
        result = block_average(frame, span, policy)
        for symbol, prices in series.items():
            got = [v for (v,) in by_seq(result.filter(F.col("symbol") == symbol), f"ema{span}")]
            assert got == pytest.approx(plain_fold(prices, span), abs=1e-9)
        several = block_average(frame, (10, span, 1), policy)
        assert {*several.columns} == {*frame.columns, "ema10", f"ema{span}", "ema1"}
        for symbol, prices in series.items():
            rows = by_seq(several.filter(F.col("symbol") == symbol), "ema10", "ema1")
            assert [a for a, _ in rows] == pytest.approx(plain_fold(prices, 10), abs=1e-9) and [b for _, b in rows] == prices


def test_sliding_windows_and_their_advice(spark):
    rows = [("A", t, p) for t, p in [(0, 10.0), (29.999, 12.0), (30, 20.0), (59, 5.0), (60, 7.0), (95, 30.0)]]
    rows += [("B", 0, 1.0), ("C", 3600, 2.0)]
    frame = ticks(spark, rows)
    expected = {
        ("A", -30.0): [10.0, 12.0],
        ("A", 0.0): [10.0, 12.0, 20.0, 5.0],
        ("A", 30.0): [20.0, 5.0, 7.0],
        ("A", 60.0): [7.0, 30.0],
        ("A", 90.0): [30.0],
        ("B", -30.0): [1.0],
        ("B", 0.0): [1.0],
        ("C", 3570.0): [2.0],
        ("C", 3600.0): [2.0],
    }
    got = seconds(window_averages(frame, "1 minute", "30 seconds")).collect()
    folded = {k: tuple(plain_fold(v, span, seed_step=False)[-1] for span in (10, 100)) for k, v in expected.items()}
    assert {(r.symbol, r.window_start): (r.ema10, r.ema100) for r in got} == folded
    assert all(r.window_end == r.window_start + 60 for r in got)

    advised = {(r.symbol, r.window_start): r.advise for r in seconds(window_advice(frame, "1 minute", "30 seconds")).collect()}
    wanted = {}
    for symbol in "ABC":
        starts = sorted(start for s, start in folded if s == symbol)
        for last, start in zip(starts, starts[1:]):
            was, now = (folded[symbol, s][0] - folded[symbol, s][1] for s in (last, start))
            wanted[symbol, start] = "Stay" if now * was >= 0 else "Buy" if now > was else "Sell"
    assert advised == wanted


def test_one_window_gives_no_window_advice(spark):
    frame = ticks(spark, [("A", 0, 1.0), ("A", 1, 2.0)])
    assert window_advice(frame, "30 seconds").count() == 0


@pytest.mark.parametrize("size, slide", [(120, 60), (70, 20), (3, 1), (50, None)])
def test_windows_whether_cut_or_not(spark, size, slide):
    """Also sizes that are no multiple of the slide, and times before 1970."""
    prices = _walk(11, 600)
    rows = [("A", i * 0.5 - 60, p) for i, p in enumerate(prices)] + [("B", 3, 1.0), ("B", -2e9, 4.0)]
    frame = ticks(spark, rows)
    windows = {}
    for symbol, moment, price in sorted(rows, key=lambda row: (row[0], row[1])):
        micros, step = round((at(moment).timestamp()) * 1e6), (slide or size) * 1_000_000
        start = micros // step * step
        while start + size * 1_000_000 > micros:
            windows.setdefault((symbol, start), []).append(price)
            start -= step
    plain = sorted(
        (s, start / 1e6 - at(0).timestamp(), *(plain_fold(v, n, seed_step=False)[-1] for n in (10, 100)))
        for (s, start), v in windows.items()
    )

    def got(policy):
        result = window_averages(frame, f"{size} seconds", slide and f"{slide} seconds", policy=policy)
        return sorted((r.symbol, r.window_start, r.ema10, r.ema100) for r in seconds(result).collect())

    assert got(SkewPolicy()) == plain
    for policy in (SkewPolicy(hot_rows=50, run_rows=90), SkewPolicy(hot_rows=200, run_rows=40, max_runs=12)):
        assert got(policy) == plain


def test_the_optimizer_leaves_the_fold_whole(spark):
    """A filter or an aggregate on top must not reach the rows being folded."""
    prices = _walk(21, 300)
    frame = ticks(spark, [(s, i, p) for i, p in enumerate(prices) for s in "AB"])
    fold = plain_fold(prices, 10)
    for policy in (SkewPolicy(), SkewPolicy(hot_rows=50, run_rows=70)):
        averaged = running_averages(frame, (10,), policy=policy)
        late = averaged.filter((F.col("symbol") == "A") & (F.col("seq") >= 500))
        assert [v for (v,) in by_seq(late, "ema10")] == fold[250:]
        total = averaged.groupBy("symbol").agg(F.max("ema10").alias("top"), F.count("*").alias("n")).collect()
        assert {tuple(row) for row in total} == {(s, max(fold), 300) for s in "AB"}
        advised = tick_advice(frame, policy=policy).groupBy("symbol", "advise").count().collect()
        wanted = plain_advice(prices)
        assert {tuple(row) for row in advised} == {(s, a, wanted.count(a)) for s in "AB" for a in set(wanted)}
        assert averaged.limit(5).count() == 5 and averaged.orderBy(F.desc("seq")).first().ema10 == fold[-1]


@pytest.mark.parametrize("zero_unset", [False, True])
@pytest.mark.parametrize("prices", [[0.3] * 24_000, [5.1] * 13_000 + [7.3] * 11_000, [0.1 + i // 6000 for i in range(24_000)], [0.0] * 24_000])
def test_flat_prices_take_three_rounds_at_most(spark, monkeypatch, prices, zero_unset):
    """Bounds of averages never meet under flat prices; tables of the few doubles between them do instead."""
    from tidegauge.operators import averages

    rounds = []
    for name in ("_fold_bounds", "_fold_tables"):
        plain = getattr(averages, name)
        monkeypatch.setattr(averages, name, lambda *args, plain=plain: rounds.append(1) or plain(*args))
    policy = SkewPolicy(hot_rows=1000, run_rows=3000, max_runs=8)
    frame = ticks(spark, [("HOT", i, price) for i, price in enumerate(prices)] + [("B", i, 1.0) for i in range(9)])
    found = running_averages(frame, zero_unset=zero_unset, policy=policy).filter("symbol = 'HOT'")
    folded = [plain_fold(prices, span, zero_unset=zero_unset) for span in (10, 100)]
    assert by_seq(found, "ema10", "ema100") == list(zip(*folded))
    assert len(rounds) <= 3


def test_flat_prices_with_adaptive_weights(spark):
    rows = [("HOT", i * (1 + i % 3), 2.7) for i in range(1200)]
    policy = SkewPolicy(hot_rows=100, run_rows=100, max_runs=12)
    cut, whole = (by_seq(adaptive_average(ticks(spark, rows), policy=p), "ema") for p in (policy, SkewPolicy()))
    assert cut == whole


def test_doubles_between():
    import numpy as np

    from tidegauge.operators.fold import count_between, doubles_between

    for low, high in ((1.0, np.nextafter(1.0, 2)), (-5e-324, 5e-324), (0.0, 0.0), (-1.0, np.nextafter(-1.0, 0)), (0.1, 0.1 + 1e-15)):
        found = doubles_between(low, high)
        assert found[0] == low and found[-1] == high and (np.diff(found) >= 0).all() and len(found) == count_between(low, high)
        assert len(set(found.tolist())) >= len(found) - 1
