"""DuckDB SQL of the market queries, layer on layer, written from the definitions and not from the Spark code's structure.

Averages are weighted directly (weights grow from 1 at a series' first row), which is exact enough for series of some
thousand rows.
"""

from __future__ import annotations


def bar(source: str, symbol: str, ts: str, price: str, qty: str, taker: str, order: str, minutes: int) -> str:
    start = f"to_timestamp(floor(epoch({ts}) / {minutes * 60}) * {minutes * 60}) AT TIME ZONE 'UTC'"
    return f"""SELECT 'BINANCE' AS exchange, {symbol} AS symbol, {start} AS open_time,
    {start} + INTERVAL {minutes} MINUTE - INTERVAL 1 MILLISECOND AS close_time,
    arg_min({price}, {order}) AS open_price, max({price}) AS high_price, min({price}) AS low_price, arg_max({price}, {order}) AS close_price,
    sum({qty})::DOUBLE AS volume, sum({price} * {qty}) AS quote_asset_volume, count(*)::BIGINT AS number_of_trades,
    coalesce(sum({qty}) FILTER (WHERE {taker}), 0)::DOUBLE AS taker_buy_base_volume, coalesce(sum({price} * {qty}) FILTER (WHERE {taker}), 0)::DOUBLE AS taker_buy_quote_volume, max({ts}) AS ingested_at
    FROM {source} GROUP BY ALL"""


def longer(source: str, minutes: int, parts: int) -> str:
    start = f"to_timestamp(floor(epoch(open_time) / {minutes * 60}) * {minutes * 60}) AT TIME ZONE 'UTC'"
    return f"""SELECT exchange, symbol, {start} AS open_time, max(close_time) AS close_time,
    arg_min(open_price, close_time) AS open_price, max(high_price) AS high_price, min(low_price) AS low_price, arg_max(close_price, close_time) AS close_price,
    sum(volume) AS volume, sum(quote_asset_volume) AS quote_asset_volume, sum(number_of_trades)::BIGINT AS number_of_trades,
    sum(taker_buy_base_volume) AS taker_buy_base_volume, sum(taker_buy_quote_volume) AS taker_buy_quote_volume, max(ingested_at) AS ingested_at
    FROM {source} GROUP BY exchange, symbol, {start} HAVING count(*) = {parts}"""


HOURS = bar("events", "event_type", "ts", "value", "1.0", "event_id % 2 = 0", "ts", 60)
DAYS = bar("lineitem", "l_returnflag", "l_shipdate", "l_extendedprice", "l_quantity", "l_linenumber % 2 = 0", "(l_orderkey::BIGINT * 8 + l_linenumber) * 1048576 + (l_partkey::BIGINT * 7919 + l_suppkey) % 1048576", 1440)
CANDLES = f"""hours AS ({HOURS}), days AS ({DAYS}),
bars AS (SELECT *, '1h' AS timeframe FROM hours UNION ALL SELECT *, '1d' FROM ({longer("hours", 1440, 24)}) UNION ALL SELECT *, '1d' FROM days UNION ALL SELECT *, '7d' FROM ({longer("days", 10080, 7)})),
candles AS (SELECT *, CASE WHEN close_price > open_price THEN 1 WHEN close_price < open_price THEN -1 ELSE 0 END AS candle_direction, abs(close_price - open_price) AS body_size,
    high_price - greatest(open_price, close_price) AS upper_wick, least(open_price, close_price) - low_price AS lower_wick, high_price - low_price AS candle_range,
    (high_price + low_price + close_price) / 3 AS typical_price, (open_price + high_price + low_price + close_price) / 4 AS ohlc_average FROM bars)"""


def ema(x: str, n: int) -> str:
    w = f"pow({1 - 2 / (n + 1)!r}, 1 - rn)"
    return f"sum({x} * {w}) OVER s / sum({w}) OVER s"


def frame(x: str, n: int) -> str:
    return f"{x} OVER (PARTITION BY timeframe, exchange, symbol ORDER BY open_time ROWS {n - 1} PRECEDING)"


S = "WINDOW s AS (PARTITION BY timeframe, exchange, symbol ORDER BY open_time ROWS UNBOUNDED PRECEDING)"
O = "WINDOW s AS (PARTITION BY timeframe, exchange, symbol ORDER BY open_time)"
INDICATORS = f"""i0 AS (SELECT *, row_number() OVER s AS rn, lag(close_price) OVER s AS prev FROM candles {O}),
i1 AS (SELECT *, greatest(high_price - low_price, abs(high_price - prev), abs(low_price - prev)) AS tr, greatest(close_price - prev, 0) AS gain, greatest(prev - close_price, 0) AS loss FROM i0),
i2 AS (SELECT *, {", ".join(f"{ema('close_price', n)} AS ema_{n}" for n in (9, 12, 21, 26, 50, 200))},
    {", ".join(f"{frame('avg(close_price)', n)} AS sma_{n}" for n in (20, 50, 200))},
    100 - 100 / (1 + nullif({frame("avg(gain)", 14)}, 0) / nullif({frame("avg(loss)", 14)}, 0)) AS rsi_14, {frame("avg(tr)", 14)} AS atr_14,
    {frame("avg(close_price)", 20)} AS bb_middle, {frame("stddev_samp(close_price)", 20)} AS bb_std FROM i1 {S}),
i3 AS (SELECT *, bb_middle + 2 * bb_std AS bb_upper, bb_middle - 2 * bb_std AS bb_lower, ema_12 - ema_26 AS macd FROM i2),
i4 AS (SELECT *, {ema("macd", 9)} AS macd_signal FROM i3 {S}),
indicators AS (SELECT *, macd - macd_signal AS macd_histogram FROM i4)"""


def pct(a: str, b: str) -> str:
    return f"({a}) / nullif({b}, 0) * 100"


def change(x: str, n: int = 1) -> str:
    return pct(f"{x} - lag({x}, {n}) OVER s", f"lag({x}, {n}) OVER s")


FEATURES = f"""features AS (SELECT *,
    {", ".join(f"{pct(f'close_price - ema_{n}', f'ema_{n}')} AS ema{n}_distance_pct" for n in (9, 21, 50, 200))},
    CASE WHEN ema_9 > ema_21 AND ema_21 > ema_50 AND ema_50 > ema_200 THEN 1 ELSE 0 END AS ema_alignment,
    {", ".join(f"{change(f'ema_{n}')} AS ema_slope_{n}" for n in (9, 21, 50))},
    {pct("close_price - ema_50", "ema_50")} AS price_vs_ema50_pct, {pct("close_price - ema_200", "ema_200")} AS price_vs_ema200_pct,
    (rsi_14 - 50) / 50 AS rsi_normalized, {pct("macd", "close_price")} AS macd_strength, {pct("macd_histogram", "close_price")} AS macd_histogram_pct,
    {", ".join(f"{change('close_price', n)} AS price_change_{n}" for n in (5, 10, 20))},
    {pct("atr_14", "close_price")} AS atr_pct, {pct("bb_std", "close_price")} AS rolling_std, {pct("bb_upper - bb_lower", "bb_middle")} AS bollinger_width,
    (close_price - bb_lower) / nullif(bb_upper - bb_lower, 0) AS bollinger_position,
    body_size / nullif(candle_range, 0) AS candle_body_ratio, upper_wick / nullif(candle_range, 0) AS upper_wick_ratio, lower_wick / nullif(candle_range, 0) AS lower_wick_ratio,
    {", ".join(f"{pct(frame('max(high_price)', n) + ' - close_price', 'close_price')} AS distance_to_{n}_high, {pct('close_price - ' + frame('min(low_price)', n), 'close_price')} AS distance_to_{n}_low" for n in (20, 50))}
    FROM indicators {O})"""


def cross(a: str, b: str, up: bool) -> str:
    return f"({a} {'>' if up else '<'} {b} AND lag({a}) OVER s {'<=' if up else '>='} lag({b}) OVER s)"


SIGNALS = f"""data AS (SELECT *, ema_alignment = 1 AS ema_bullish_alignment, ema_alignment = 0 AS ema_bearish_alignment,
    price_vs_ema50_pct > 0 AS price_above_ema50, price_vs_ema200_pct > 0 AS price_above_ema200,
    {cross("ema_50", "ema_200", True)} AS golden_cross, {cross("ema_50", "ema_200", False)} AS death_cross,
    rsi_14 >= 70 AS rsi_overbought, rsi_14 <= 30 AS rsi_oversold, (rsi_14 > lag(rsi_14) OVER s AND rsi_14 > 30) AS rsi_recovering,
    {cross("macd", "macd_signal", True)} AS macd_bullish_cross, {cross("macd", "macd_signal", False)} AS macd_bearish_cross, macd > 0 AS macd_positive,
    (atr_pct > 1.5 OR bollinger_width > 4) AS high_volatility, (atr_pct < 0.6 AND bollinger_width < 2) AS low_volatility,
    bollinger_position > 1 AS bollinger_breakout_up, bollinger_position < 0 AS bollinger_breakout_down,
    {", ".join(f"distance_to_{n}_{x} <= 0.05 AS new_{n}_{x}" for n in (20, 50) for x in ("high", "low"))},
    ((distance_to_20_high <= 0.05 OR distance_to_50_high <= 0.05) AND (price_change_5 > 0 OR ema_alignment = 1)) AS breakout_confirmation
    FROM features {O})"""

ALL = f"WITH {CANDLES}, {INDICATORS}, {FEATURES}, {SIGNALS}"
TO_INDICATORS = f"WITH {CANDLES}, {INDICATORS}"
TO_CANDLES = f"WITH {CANDLES}"


def any_of(*names: str) -> str:
    return "(" + " OR ".join(f"coalesce({n}, false)" for n in names) + ")"


def bias(by: str) -> str:
    """CTEs up to `scores`: the parts of the market bias by the given columns."""
    up = f"({any_of('bollinger_breakout_up', 'new_20_high', 'new_50_high')} OR (coalesce(breakout_confirmation, false) AND coalesce(price_vs_ema50_pct, 0) >= 0))"
    down = f"({any_of('bollinger_breakout_down', 'new_20_low', 'new_50_low')} OR (coalesce(breakout_confirmation, false) AND coalesce(price_vs_ema50_pct, 0) < 0))"
    latest = lambda x: f"coalesce(max({x}) FILTER (WHERE open_time = t_{x}), 0)"
    cols = ("rsi_normalized", "macd_strength", "bollinger_position", "price_vs_ema50_pct")
    step = lambda x, hi, lo: f"CASE WHEN {x} >= {hi} THEN 1 WHEN {x} <= {lo} THEN -1 ELSE 0 END"
    sgn = lambda x: f"CASE WHEN {x} > 0 THEN 1 WHEN {x} < 0 THEN -1 ELSE 0 END"
    return f"""b0 AS (SELECT *, max(open_time) OVER (PARTITION BY {by}) AS t, {", ".join(f"max(open_time) FILTER (WHERE {x} IS NOT NULL) OVER (PARTITION BY {by}) AS t_{x}" for x in cols)} FROM data),
b1 AS (SELECT {by}, max(ema_alignment) FILTER (WHERE open_time = t) AS ema, {", ".join(f"{latest(x)} AS {x}" for x in cols)},
    count(*) FILTER (WHERE open_time = t AND {up}) AS ups, count(*) FILTER (WHERE open_time = t AND {down}) AS downs,
    count(*) FILTER (WHERE open_time = t AND coalesce(macd_bullish_cross, false)) AS bulls, count(*) FILTER (WHERE open_time = t AND coalesce(macd_bearish_cross, false)) AS bears FROM b0 GROUP BY {by}),
b2 AS (SELECT {by}, {sgn("ema")} AS ema_score, {sgn("macd_strength")} AS macd_score, {step("rsi_normalized", 0.2, -0.2)} AS rsi_score, {step("bollinger_position", 0.6, 0.4)} AS bollinger_score, {sgn("price_vs_ema50_pct")} AS ema50_score,
    CASE WHEN ups > 0 AND downs = 0 THEN 1 WHEN downs > 0 AND ups = 0 THEN -1 ELSE 0 END AS breakout_score,
    CASE WHEN bulls > 0 AND bears = 0 THEN 1 WHEN bears > 0 AND bulls = 0 THEN -1 ELSE {sgn("macd_strength")} END AS macd_confirmation FROM b1),
b3 AS (SELECT *, ema_score + macd_score + rsi_score + bollinger_score + ema50_score + breakout_score AS bias_score FROM b2),
scores AS (SELECT *, CASE WHEN bias_score >= 4 THEN '🟢 Strong Bullish' WHEN bias_score >= 1 THEN '🟢 Bullish' WHEN bias_score <= -4 THEN '🔴 Strong Bearish' WHEN bias_score <= -1 THEN '🔴 Bearish' ELSE '⚪ Neutral' END AS bias FROM b3)"""
