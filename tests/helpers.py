"""Small fixtures and plain-Python folds to compare with."""

from datetime import datetime, timedelta, timezone

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
TICKS = "symbol string, event_time timestamp, seq bigint, close double"


def at(seconds: float) -> datetime:
    return START + timedelta(seconds=seconds)


def ticks(spark, rows):
    """Rows (symbol, seconds, close); the tie-breaker is the position."""
    return spark.createDataFrame([(s, at(t), i, c) for i, (s, t, c) in enumerate(rows)], TICKS)


def seconds(df):
    """Timestamps as seconds since START, which no time zone can shift."""
    from pyspark.sql import functions as F

    base = START.timestamp()
    return df.select(
        *[
            ((F.unix_micros(f.name) / 1e6) - base).alias(f.name) if f.dataType.typeName() == "timestamp" else f.name
            for f in df.schema
        ]
    )


def plain_fold(prices, span, seed_step=True, zero_unset=False):
    weight, out, last = 2 / (span + 1), [], None
    for price in prices:
        if last is None and not seed_step:
            last = price
        else:
            previous = price if last is None or (zero_unset and last == 0.0) else last
            last = weight * price + (1 - weight) * previous
        out.append(last)
    return out


def plain_advice(prices, spans=(10, 100), zero_unset=False):
    fast, slow = (plain_fold(prices, span, zero_unset=zero_unset) for span in spans)
    out = []
    for i, price in enumerate(prices):
        before = []
        for series in (fast, slow):
            unset = i == 0 or (zero_unset and series[i - 1] == 0.0)
            before.append(price if unset else series[i - 1])
        was, now = before[0] - before[1], fast[i] - slow[i]
        out.append("Stay" if now * was >= 0 else "Buy" if now > was else "Sell")
    return out
