"""The same results in plain SQL, for a second engine to check them.

Averages use a recursive query, one step per tick, in the rounding order of
the fold; so they are compared without rounding.
"""

from __future__ import annotations

A10, A100 = "(2e0/11e0)", "(2e0/101e0)"

ADVISE = """CASE WHEN (ema10 - ema100) * (b10 - b100) >= 0 THEN 'Stay'
  WHEN ema10 - ema100 > b10 - b100 THEN 'Buy' ELSE 'Sell' END"""


def _ticks(key: str, price: str = "value") -> str:
    return f"""t AS (SELECT CAST({key} AS VARCHAR) AS symbol, ts, event_id AS seq, {price} AS close,
  row_number() OVER (PARTITION BY {key} ORDER BY ts, event_id) AS rn FROM events)"""


def _step(weight: str, price: str, before: str) -> str:
    return f"{weight} * {price} + (1e0 - {weight}) * {before}"


def _folded(key: str, price: str = "value") -> str:
    return f"""WITH RECURSIVE {_ticks(key, price)},
r AS (
  SELECT symbol, ts, seq, rn, close AS b10, close AS b100,
    {_step(A10, 'close', 'close')} AS ema10, {_step(A100, 'close', 'close')} AS ema100
  FROM t WHERE rn = 1
  UNION ALL
  SELECT t.symbol, t.ts, t.seq, t.rn, r.ema10, r.ema100,
    {_step(A10, 't.close', 'r.ema10')}, {_step(A100, 't.close', 'r.ema100')}
  FROM r JOIN t ON t.symbol = r.symbol AND t.rn = r.rn + 1)
"""


def advice(key: str, price: str = "value") -> str:
    return _folded(key, price) + f'SELECT symbol, ts AS "timestamp", seq, ema10, ema100, {ADVISE} AS advise FROM r'


def expiring(key: str, seconds: int) -> str:
    """Advice where a symbol starts again after a gap; its ticks between two gaps are an island."""
    return f"""WITH RECURSIVE g AS (SELECT CAST({key} AS VARCHAR) AS symbol, ts, event_id AS seq, value AS close,
  CASE WHEN ts - lag(ts) OVER w >= INTERVAL {seconds} SECOND THEN 1 ELSE 0 END AS opens FROM events WINDOW w AS (PARTITION BY {key} ORDER BY ts, event_id)),
i AS (SELECT *, sum(opens) OVER (PARTITION BY symbol ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS island FROM g),
t AS (SELECT *, row_number() OVER (PARTITION BY symbol, island ORDER BY ts, seq) AS rn FROM i),
r AS (
  SELECT symbol, island, ts, seq, rn, close AS b10, close AS b100,
    {_step(A10, 'close', 'close')} AS ema10, {_step(A100, 'close', 'close')} AS ema100
  FROM t WHERE rn = 1
  UNION ALL
  SELECT t.symbol, t.island, t.ts, t.seq, t.rn, r.ema10, r.ema100,
    {_step(A10, 't.close', 'r.ema10')}, {_step(A100, 't.close', 'r.ema100')}
  FROM r JOIN t ON t.symbol = r.symbol AND t.island = r.island AND t.rn = r.rn + 1)
SELECT symbol, ts AS "timestamp", seq, ema10, ema100, {ADVISE} AS advise FROM r"""


def drawdown(key: str, size: int, slide: int | None = None) -> str:
    return f"""WITH {_placed(key, size, slide)},
m AS (SELECT *, max(close) OVER (PARTITION BY symbol, window_start ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS top FROM w)
SELECT symbol, window_start, window_end, max(top - close) AS drawdown FROM m GROUP BY ALL"""


def _averages(key: str, columns: str) -> str:
    return _folded(key) + f"SELECT symbol, seq, {columns} FROM r"


def _advice_zero_unset() -> str:
    next10 = "CASE WHEN r.ema10 = 0 THEN t.close ELSE r.ema10 END"
    next100 = "CASE WHEN r.ema100 = 0 THEN t.close ELSE r.ema100 END"
    return f"""WITH RECURSIVE {_ticks('user_id')},
r AS (
  SELECT symbol, ts, seq, rn, close AS b10, close AS b100,
    {_step(A10, 'close', 'close')} AS ema10, {_step(A100, 'close', 'close')} AS ema100
  FROM t WHERE rn = 1
  UNION ALL
  SELECT t.symbol, t.ts, t.seq, t.rn, {next10}, {next100},
    {_step(A10, 't.close', f'({next10})')}, {_step(A100, 't.close', f'({next100})')}
  FROM r JOIN t ON t.symbol = r.symbol AND t.rn = r.rn + 1)
SELECT symbol, ts AS "timestamp", seq, ema10, ema100, {ADVISE} AS advise FROM r WHERE ema10 <> 0"""


def _placed(key: str, size: int, slide: int | None, more: str = "") -> str:
    """Rows with their windows; size and slide in seconds, starts aligned to the epoch."""
    slide = slide or size
    micros = slide * 1_000_000
    return f"""w AS (SELECT CAST({key} AS VARCHAR) AS symbol, ts, event_id AS seq, value AS close{more},
  make_timestamp(epoch_us(ts) - epoch_us(ts) % {micros} - i * {micros}) AS window_start,
  make_timestamp(epoch_us(ts) - epoch_us(ts) % {micros} - i * {micros} + {size * 1_000_000}) AS window_end
  FROM events, (SELECT unnest(range({size // slide})) AS i))"""


def _window_folded(key: str, size: int, slide: int | None) -> str:
    return f"""WITH RECURSIVE {_placed(key, size, slide)},
t AS (SELECT *, row_number() OVER (PARTITION BY symbol, window_start ORDER BY ts, seq) AS rn,
  count(*) OVER (PARTITION BY symbol, window_start) AS n FROM w),
r AS (
  SELECT symbol, window_start, window_end, rn, n, close AS ema10, close AS ema100 FROM t WHERE rn = 1
  UNION ALL
  SELECT t.symbol, t.window_start, t.window_end, t.rn, t.n,
    {_step(A10, 't.close', 'r.ema10')}, {_step(A100, 't.close', 'r.ema100')}
  FROM r JOIN t ON t.symbol = r.symbol AND t.window_start = r.window_start AND t.rn = r.rn + 1),
e AS (SELECT symbol, window_start, window_end, ema10, ema100 FROM r WHERE rn = n)
"""


def window_averages(key: str, size: int, slide: int | None = None, where: str = "true") -> str:
    return _window_folded(key, size, slide) + f"SELECT * FROM e WHERE {where}"


def window_advice(key: str, size: int, slide: int | None = None, where: str = "true") -> str:
    return (
        _window_folded(key, size, slide)
        + f""", p AS (SELECT *, lag(ema10) OVER (PARTITION BY symbol ORDER BY window_end) AS b10,
  lag(ema100) OVER (PARTITION BY symbol ORDER BY window_end) AS b100 FROM e WHERE {where})
SELECT symbol, window_start, window_end, window_end AS "timestamp", ema10, ema100, {ADVISE} AS advise
FROM p WHERE b10 IS NOT NULL"""
    )


def window_sum(where: str = "true") -> str:
    return f"""WITH {_placed('user_id', 60, None)}
SELECT symbol AS seller_id, window_start, window_end,
  CAST(sum(CAST(round(close * 100) AS INTEGER)) AS BIGINT) AS aggregated_amount
FROM w WHERE {where} GROUP BY ALL"""


def window_count(key: str, size: int, slide: int | None = None, where: str = "true") -> str:
    return f"""WITH {_placed(key, size, slide)}
SELECT symbol, window_start, window_end, count(*) AS n FROM w WHERE {where} GROUP BY ALL"""


def window_average_row(where: str = "true") -> str:
    return f"""WITH {_placed('event_type', 86400, None)}
SELECT symbol, window_start, window_end, min(ts) AS event_time, arg_min(seq, ts) AS seq,
  round(avg(close), 9) AS temperature
FROM w WHERE {where} GROUP BY symbol, window_start, window_end"""


def adaptive(key: str) -> str:
    seconds = "(((epoch_us(t.ts) - epoch_us(r.ts)) % 86400000000) / 1e6)"
    weight = f"(2e0 / (length(CAST({seconds} AS VARCHAR)) + 1))"
    return f"""WITH RECURSIVE {_ticks(key)},
r AS (
  SELECT symbol, ts, seq, rn, close AS ema FROM t WHERE rn = 1
  UNION ALL
  SELECT t.symbol, t.ts, t.seq, t.rn, {_step(weight, 't.close', 'r.ema')}
  FROM r JOIN t ON t.symbol = r.symbol AND t.rn = r.rn + 1)
SELECT symbol, seq, ema FROM r"""


def inactivity(key: str, seconds: int) -> str:
    return f"""WITH n AS (SELECT CAST({key} AS VARCHAR) AS symbol, ts, event_id, value,
  lead(ts) OVER (PARTITION BY {key} ORDER BY ts, event_id) AS after,
  min(ts) OVER (PARTITION BY {key}) AS first_time FROM events)
SELECT symbol, first_time, ts AS event_time, event_id AS seq, value AS ema,
  ts + INTERVAL {seconds} SECOND AS fired_at
FROM n WHERE after IS NULL OR after >= ts + INTERVAL {seconds} SECOND"""


MILLIS = "make_timestamp(epoch_us(ts) - epoch_us(ts) % 1000)"


def table_oracles() -> dict[str, str]:
    return {
        "ticks_normalized": f"""SELECT CAST(user_id AS VARCHAR) AS symbol, {MILLIS} AS event_time,
  CASE WHEN event_type IN ('click', 'view') THEN event_id END AS seq, value AS close, value + 1 AS high,
  0e0 AS interest, value - 1 AS low, value AS open, CAST(json_extract(props, '$.k') AS DOUBLE) AS volume
FROM events""",
        "json_decode": """SELECT event_id,
  CASE WHEN event_type <> 'error' THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS k,
  CASE WHEN event_type = 'error' THEN event_type END AS rejected FROM events""",
        "json_encode": """SELECT event_id, CAST(json_object('symbol', CAST(user_id AS VARCHAR),
  'timestamp', epoch_us(ts) // 1000, 'ema10', value, 'advise', event_type) AS VARCHAR) AS value FROM events""",
        "numeric_coercion": """SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS close FROM events""",
        "event_time_ms": f"SELECT event_id, {MILLIS} AS event_time FROM events",
        "event_time_s": f"SELECT event_id, {MILLIS} AS event_time FROM events",
        "event_time_str": "SELECT event_id, date_trunc('second', ts) AS event_time FROM events",
        "event_time_long": f"SELECT event_id, {MILLIS} AS event_time FROM events",
        "ema_step": f"""SELECT event_id, {_step(A10, 'value', 'k')} AS ema10, {_step(A100, 'value', 'k')} AS ema100
FROM (SELECT event_id, value, CAST(json_extract(props, '$.k') AS DOUBLE) AS k FROM events)""",
        "ema_running": _averages("user_id", "ema10"),
        "ema_dual": _averages("user_id", "ema10, ema100"),
        "ema_advice": advice("user_id"),
        "ema_advice_by_type": advice("event_type"),
        "ema_advice_cut": advice("event_type"),
        "ema_advice_flat_cut": advice("event_type", "CAST(length(event_type) AS DOUBLE) / 7e0"),
        "ema_advice_zero_unset": _advice_zero_unset(),
        "ema_advice_expiring": expiring("user_id", 86400),
        "ema_advice_expiring_cut": expiring("event_type", 1800),
        "ema_block_scan": _averages("user_id", "round(ema10, 6) AS ema10, round(ema100, 6) AS ema100"),
        "ema_block_scan_cut": _averages("event_type", "round(ema10, 6) AS ema10, round(ema100, 6) AS ema100"),
        "ema_window_sliding": window_averages("user_id", 60, 30),
        "ema_window_sliding_by_type": window_averages("event_type", 86400, 43200),
        "ema_window_tumbling": window_averages("user_id", 30),
        "ema_window_cut": window_averages("event_type", 20 * 86400),
        "window_advice": window_advice("user_id", 60, 30),
        "window_advice_by_type": window_advice("event_type", 86400, 43200),
        "window_advice_tumbling": window_advice("event_type", 30),
        "window_sum": window_sum(),
        "window_count": window_count("user_id", 30),
        "window_count_by_type": window_count("event_type", 86400, 43200),
        "window_avg_row": window_average_row(),
        "window_rows": f"""WITH {_placed('user_id', 60, 30)}
SELECT symbol, window_start, window_end, ts AS event_time, seq, close FROM w""",
        "window_drawdown": drawdown("user_id", 86400),
        "window_drawdown_sliding": drawdown("event_type", 86400, 43200),
        "ema_adaptive": adaptive("user_id"),
        "ema_adaptive_cut": adaptive("event_type"),
        "latest_close": """SELECT CAST(user_id AS VARCHAR) AS symbol, min(ts) AS first_time, max(ts) AS event_time,
  arg_max(value, ts) AS ema FROM events GROUP BY user_id""",
        "latest_per_tick": """SELECT CAST(user_id AS VARCHAR) AS symbol,
  min(ts) OVER (PARTITION BY user_id) AS first_time, ts AS event_time, event_id AS seq, value AS ema FROM events""",
        "inactivity_timeout": inactivity("user_id", 10),
        "inactivity_timeout_cut": inactivity("event_type", 600),
    }


#: Half of the time that the events cover.
HALF = "(SELECT make_timestamp(epoch_us(min(ts)) + (epoch_us(max(ts)) - epoch_us(min(ts))) // 2) FROM events)"


def closed(seconds: int) -> str:
    """Windows that a watermark this far behind the last event has passed."""
    return f"window_end <= (SELECT max(ts) FROM events) - INTERVAL {seconds} SECOND"


def _silent_stream(seconds: int, delay: int) -> str:
    return f"""SELECT * FROM ({inactivity("user_id", seconds)}) AS g
WHERE event_time + INTERVAL {seconds + delay} SECOND < (SELECT max(ts) FROM events)
   OR EXISTS (SELECT 1 FROM events e WHERE CAST(e.user_id AS VARCHAR) = g.symbol AND e.ts > g.event_time)"""


def _as_record(query: str) -> str:
    return f"""SELECT symbol, epoch_us("timestamp") // 1000 AS "timestamp", ema10, ema100, advise FROM ({query})"""


REJECTS = """SELECT kind, CASE event_id % 7 WHEN 0 THEN 'unreadable' WHEN 2 THEN 'no_time'
  WHEN 1 THEN CASE kind WHEN 'tick' THEN 'no_symbol' ELSE 'no_seller' END
  WHEN 4 THEN CASE kind WHEN 'tick' THEN 'no_symbol' ELSE 'no_seller' END
  WHEN 3 THEN CASE kind WHEN 'tick' THEN 'no_price' ELSE 'no_amount' END ELSE 'kept' END AS reason, count(*) AS n
FROM events, (VALUES ('tick'), ('sale')) AS k(kind) GROUP BY ALL"""


def stream_oracles() -> dict[str, str]:
    return {
        "stream_tick_advice": advice("user_id"),
        "stream_tick_advice_by_type": advice("event_type"),
        "stream_adaptive": adaptive("user_id"),
        "stream_latest_per_tick": table_oracles()["latest_per_tick"],
        "stream_window_averages": window_averages("event_type", 86400, 43200, closed(2)),
        "stream_pane_windows": window_averages("event_type", 86400, 3600, closed(2)),
        "stream_window_advice": window_advice("event_type", 86400, 43200, closed(2)),
        "stream_window_sum": window_sum(closed(2)),
        "stream_window_count": window_count("event_type", 30, where=closed(2)),
        "stream_window_avg_row": window_average_row(closed(2)),
        "stream_inactivity": _silent_stream(10, 2),
        "stream_restart": advice("event_type"),
        "stream_restart_windows": window_advice("event_type", 86400, 43200, closed(2)),
        "stream_restart_inactivity": _silent_stream(10, 2),
        "stream_late_windows": window_count("event_type", 30, where=f"{closed(2)} AND ts >= {HALF}"),
        "stream_state": _folded("user_id")
        + """SELECT symbol, max(ts) AS event_time, arg_max(ema10, rn) AS ema10, arg_max(ema100, rn) AS ema100 FROM r GROUP BY symbol""",
        "stream_from_history": f"""SELECT * FROM ({advice("event_type")}) WHERE "timestamp" >= {HALF}""",
        "stream_rejects": REJECTS,
        "stream_ttl_event_time": expiring("user_id", 86400),
        "stream_late_rows": f"""SELECT event_type AS symbol, ts AS event_time, event_id AS seq, value AS close, CASE WHEN ts < {HALF}
  AND epoch_us(ts) // 30000000 * 30 + 30 <= (SELECT epoch(max(ts)) FROM events) - 2 THEN 'late' END AS reason FROM events""",
        "stream_changelog": f"""SELECT seller_id, window_start, window_end, aggregated_amount, aggregated_amount AS summed FROM ({window_sum()})""",
        "stream_fan_out": f"""SELECT c.*, target FROM ({window_count("event_type", 30, where=closed(2))}) AS c, (VALUES ('first'), ('second')) AS t(target)""",
        "job_ticks": _as_record(advice("user_id")),
        "job_windows": _as_record(window_advice("user_id", 86400, 43200, closed(2))),
        "job_sales": window_sum(closed(0)),
    }
