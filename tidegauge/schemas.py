"""Declared row types. Field names and types are fixed by the data formats."""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)


def _struct(**fields) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


# Capitalised layout; Id is present in one variant of the feed and null otherwise.
TICK_CAPITALISED = _struct(
    Id=IntegerType(),
    Close=DoubleType(),
    High=DoubleType(),
    Interest=DoubleType(),
    Low=DoubleType(),
    Open=DoubleType(),
    Time=StringType(),
    Volume=DoubleType(),
    Symbol=StringType(),
)

# Lower-case layout; prices are declared single precision there and widened here.
TICK_LOWER = _struct(
    symbol=StringType(),
    close=DoubleType(),
    high=DoubleType(),
    interest=DoubleType(),
    low=DoubleType(),
    open=DoubleType(),
    time=StringType(),
    volume=DoubleType(),
)

# What every operator of this package reads.
TICK = _struct(
    symbol=StringType(),
    event_time=TimestampType(),
    seq=LongType(),
    close=DoubleType(),
    high=DoubleType(),
    interest=DoubleType(),
    low=DoubleType(),
    open=DoubleType(),
    volume=DoubleType(),
)

ADVICE = _struct(
    symbol=StringType(),
    timestamp=TimestampType(),
    ema10=DoubleType(),
    ema100=DoubleType(),
    advise=StringType(),
)

SALE = _struct(seller_id=StringType(), amount_usd=IntegerType(), sale_ts=LongType())

AGGREGATED_SALE = _struct(
    seller_id=StringType(),
    window_start=TimestampType(),
    window_end=TimestampType(),
    aggregated_amount=LongType(),
)

# Order of the ticks of one key: event time, then the tie-breaker.
TICK_ORDER = ("event_time", "seq")
