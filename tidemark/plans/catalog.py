"""Registered market queries and their SQL counterparts.

Both sides give times as text and numbers in a form that the order of additions doesn't change: sums at two decimals (which the
data have), averages as 32-bit floats, MACD at five decimals, ratios and percentages at four.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import FEATURE_GROUPS, FEATURES, KEY, SIGNALS
from tidemark.operators import candles as C
from tidemark.operators import incremental as I
from tidemark.operators import ingest as G
from tidemark.operators import technical as T
from tidemark.operators import validation as V
from tidemark.plans import market_sql as Q
from tidemark.plans import semantic as M
from tidemark.sources import klines as K
from tidemark.sources.klines import KINDS
from tidemark.sources.ticks import event_ticks, scan

TIME, DUCK_TIME = "yyyy-MM-dd HH:mm:ss", "%Y-%m-%d %H:%M:%S"
FRAMES = ["1h", "1d", "7d"]
BARS = ["open_price", "high_price", "low_price", "close_price", "number_of_trades"]
SUMS = ["volume", "quote_asset_volume", "taker_buy_base_volume", "taker_buy_quote_volume"]
ATTRIBUTES = ["candle_direction", "body_size", "upper_wick", "lower_wick", "candle_range", "typical_price", "ohlc_average"]
MACD = ["macd", "macd_signal", "macd_histogram"]

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def rounded(name: str) -> str:
    """How a number is given: f (32-bit), so many decimals, or as it is."""
    if name in SUMS or name.startswith("total_") or name == "latest_volume":
        return "2"
    if name in MACD:
        return "5"  # a series' second row has values of exactly five decimals
    if name in T.INDICATORS or name.startswith(("average_", "value")) and not name.endswith(("pct", "normalized", "strength", "position")):
        return "f"
    if name in T.feature_names() and name != "ema_alignment" or name.startswith(("current_", "average_")) or name in ("period_change", "bullish_ratio", "bearish_ratio", "value"):
        return "4"
    return ""


TIMES = ("open_time", "close_time", "ingested_at", "latest_time", "snapshot_time", "top_time")


def col(name: str):
    how, x = rounded(name), F.col(name)
    if name in TIMES:
        x = F.date_format(x, TIME)
    elif how == "f":
        x = x.cast("float").cast("double")
    elif how:
        x = F.round(x, int(how)) + F.lit(0.0)
    return x.alias(name)


def sql(name: str) -> str:
    how = rounded(name)
    if name in TIMES:
        return f"strftime({name}, '{DUCK_TIME}') AS {name}"
    return f"{name}::FLOAT::DOUBLE AS {name}" if how == "f" else f"round({name}, {how}) + 0.0 AS {name}" if how else name


def shown(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[col(n) for n in names])


def query(name: str, oracle: str | None = None):
    def add(f: Query) -> Query:
        _queries[name] = f
        if oracle:
            _sql[name] = oracle
        return f

    return add


def picked(name: str, prefix: str, relation: str, make: Callable[[SparkSession, str], DataFrame], names: list[str], where: str = "true") -> None:
    """A query whose rows are those of a layer, and its SQL."""
    query(name, f"{prefix} SELECT {', '.join(sql(n) for n in names)} FROM {relation} WHERE {where}")(lambda s, d: shown(make(s, d).where(where), names))


def candles(s: SparkSession, d: str) -> DataFrame:
    return C.candles(s, d)


def indicated(s: SparkSession, d: str) -> DataFrame:
    return T.with_indicators(candles(s, d))


def featured(s: SparkSession, d: str) -> DataFrame:
    return T.with_features(indicated(s, d))


def data(s: SparkSession, d: str) -> DataFrame:
    return T.with_signals(featured(s, d))


picked("ohlcv_hour", Q.TO_CANDLES, "candles", candles, [*KEY, "close_time", *BARS, *SUMS, "ingested_at"], "timeframe = '1h'")
picked("ohlcv_day_complete", Q.TO_CANDLES, "candles", candles, [*KEY, "close_time", *BARS, *SUMS], "timeframe = '1d'")
picked("ohlcv_week_complete", Q.TO_CANDLES, "candles", candles, [*KEY, "close_time", *BARS, *SUMS], "timeframe = '7d'")
picked("candle_attributes", Q.TO_CANDLES, "candles", candles, [*KEY, *ATTRIBUTES])
picked("candles_bi", Q.TO_CANDLES, "candles", candles, [*KEY, "close_time", *BARS, *SUMS, *ATTRIBUTES])
for _name, _columns in {"ema": ["ema_9", "ema_21", "ema_50", "ema_200"], "sma": ["sma_20", "sma_50", "sma_200"], "rsi": ["rsi_14"], "atr": ["atr_14"], "bollinger": ["bb_middle", "bb_upper", "bb_lower"], "macd": MACD}.items():
    picked(_name, Q.TO_INDICATORS, "indicators", indicated, [*KEY, *_columns])
picked("indicators", Q.TO_INDICATORS, "indicators", indicated, [*KEY, *T.INDICATORS])
picked("indicators_hourly", Q.TO_INDICATORS, "indicators", lambda s, d: T.with_indicators(C.candles(s, d, ("1h",))), [*KEY, *T.INDICATORS], "timeframe = '1h'")
for _name, _group in FEATURES.items():
    picked(f"features_{_name}", Q.ALL, "features", featured, [*KEY, *_group])
for _name, _group in SIGNALS.items():
    picked(f"signals_{_name}", Q.ALL, "data", data, [*KEY, *_group])
picked("dataset", Q.ALL, "data", data, [*KEY, *T.feature_names(), *T.signal_names()])
_crosses = ["macd_bullish_cross", "macd_bearish_cross", "golden_cross", "death_cross", "breakout_confirmation"]
query("recent_signals", f"{Q.ALL} SELECT {', '.join(sql(n) for n in [*KEY, *_crosses])} FROM data WHERE {' OR '.join(_crosses)} ORDER BY data.open_time DESC, timeframe, symbol")(
    lambda s, d: data(s, d).where(" OR ".join(_crosses)).orderBy(F.desc("open_time"), "timeframe", "symbol").select(*[col(n) for n in [*KEY, *_crosses]])
)

# Dimensions and constant tables.
query("dim_symbol", f"{Q.ALL} SELECT symbol FROM candles UNION SELECT symbol FROM data")(lambda s, d: M.dim(candles(s, d), data(s, d), "symbol"))
query("dim_exchange", f"{Q.ALL} SELECT exchange FROM candles UNION SELECT exchange FROM data")(lambda s, d: M.dim(candles(s, d), data(s, d), "exchange"))


@query("dim_datetime", f"{Q.TO_CANDLES} SELECT DISTINCT strftime(open_time, '{DUCK_TIME}') AS open_time, strftime(open_time, '%Y-%m-%d') AS date, year(open_time)::INT AS year, month(open_time)::INT AS month_number, strftime(open_time, '%B') AS month_name, day(open_time)::INT AS day, hour(open_time)::INT AS hour, minute(open_time)::INT AS minute, strftime(open_time, '%d %b %Y %H:%M') AS date_label FROM candles")
def dim_datetime(s, d):
    x = candles(s, d)
    out = M.dim_datetime(x, data(s, d))
    return out.select(col("open_time"), F.col("date").cast("string").alias("date"), "year", "month_number", "month_name", "day", "hour", "minute", "date_label")


def _values(rows: list[tuple], names: str) -> str:
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(repr(x) for x in r) + ')' for r in rows)}) t({names})"


query("dim_timeframe", _values(M.TIMEFRAMES, "timeframe, sort_order"))(lambda s, d: M.dim_timeframe(s))
query("indicator_selector", _values([(k, i + 1) for i, k in enumerate(M.INDICATORS)], "indicator, sort"))(lambda s, d: M.selector(s))
query("signal_matrix", _values([(k, i + 1) for i, k in enumerate(M.MATRIX)], "signal, sort"))(lambda s, d: M.signal_matrix(s))
query("signal_types", _values([(k, p, i + 1) for i, (k, (p, _)) in enumerate(M.SIGNAL_TYPES.items())], "signal_type, polarity, sort"))(lambda s, d: M.signal_types(s))

# Measures and reports, by timeframe and symbol.
BY = ["timeframe", "symbol"]
_by = ", ".join(BY)
_mark = f"m AS (SELECT *, max(open_time) OVER (PARTITION BY {_by}) AS l, min(open_time) OVER (PARTITION BY {_by}) AS f FROM candles)"
_measures = ["latest_close", "latest_open", "latest_high", "latest_low", "latest_time", "period_open", "period_close", "period_high", "period_low", "total_volume", "latest_volume", "average_volume", "close_price", "candle_count", "period_change"]
query("candle_measures", f"""{Q.TO_CANDLES}, {_mark}, g AS (SELECT {_by}, max(close_price) FILTER (WHERE open_time = l) AS latest_close, max(open_price) FILTER (WHERE open_time = l) AS latest_open, max(high_price) FILTER (WHERE open_time = l) AS latest_high,
    min(low_price) FILTER (WHERE open_time = l) AS latest_low, max(open_time) AS latest_time, min(open_price) FILTER (WHERE open_time = f) AS period_open, max(close_price) FILTER (WHERE open_time = l) AS period_close, max(high_price) AS period_high, min(low_price) AS period_low,
    sum(volume) AS total_volume, sum(volume) FILTER (WHERE open_time = l) AS latest_volume, avg(volume) AS average_volume, max(close_price) AS close_price, count(*) AS candle_count FROM m GROUP BY {_by}),
    h AS (SELECT *, (period_close - period_open) / nullif(period_open, 0) AS period_change FROM g) SELECT {_by}, {", ".join(sql(n) for n in _measures)} FROM h""")(lambda s, d: shown(M.candle_measures(candles(s, d), BY), [*BY, *_measures]))

_current = ("rsi_normalized", "atr_pct", "macd_strength", "macd_histogram_pct", "bollinger_position", "price_vs_ema50_pct")
query("current_indicators", f"{Q.ALL}, g AS (SELECT {_by}, {', '.join(f'arg_max({x}, open_time) FILTER (WHERE {x} IS NOT NULL) AS current_{x}' for x in _current)} FROM data GROUP BY {_by}) SELECT {_by}, {', '.join(sql(f'current_{x}') for x in _current)} FROM g")(
    lambda s, d: shown(M.current_indicators(data(s, d), BY), [*BY, *[f"current_{x}" for x in _current]])
)
_bull, _bear = Q.any_of(*M.BULLISH), Q.any_of(*M.BEARISH)
query("signal_counts", f"{Q.ALL}, g AS (SELECT {_by}, count(*) FILTER (WHERE {_bull}) AS bullish, count(*) FILTER (WHERE {_bear}) AS bearish, count(*) FILTER (WHERE NOT ({_bull} OR {_bear})) AS neutral, count(*) AS states FROM data GROUP BY {_by}) SELECT *, round(bullish / states, 4) + 0.0 AS bullish_ratio, round(bearish / states, 4) + 0.0 AS bearish_ratio FROM g")(
    lambda s, d: shown(M.signal_counts(data(s, d), BY), [*BY, "bullish", "bearish", "neutral", "states", "bullish_ratio", "bearish_ratio"])
)
query("indicator_averages", f"{Q.ALL}, g AS (SELECT {_by}, {', '.join(f'avg({x}) AS average_{x}' for x in M.INDICATORS.values())} FROM data GROUP BY {_by}) SELECT {_by}, {', '.join(sql(f'average_{x}') for x in M.INDICATORS.values())} FROM g")(
    lambda s, d: shown(M.indicator_averages(data(s, d), BY), [*BY, *[f"average_{x}" for x in M.INDICATORS.values()]])
)
query("indicator_explorer", f"{Q.ALL} SELECT timeframe, strftime(open_time, '{DUCK_TIME}') AS open_time, round(avg(bollinger_position), 4) + 0.0 AS value, 'Bollinger Position over time' AS title FROM data GROUP BY timeframe, data.open_time")(
    lambda s, d: M.selected_indicator(data(s, d), ["timeframe", "open_time"], "Bollinger Position").select("timeframe", col("open_time"), (F.round("value", 4) + 0.0).alias("value"), "title")
)
query("price_series", f"{Q.TO_CANDLES} SELECT timeframe, strftime(open_time, '{DUCK_TIME}') AS open_time, max(high_price) AS high_price, max(low_price) AS low_price, max(close_price) AS close_price, max(open_price) AS open_price, round(sum(volume), 2) + 0.0 AS volume FROM candles GROUP BY timeframe, candles.open_time")(
    lambda s, d: shown(candles(s, d).groupBy("timeframe", "open_time").agg(*[F.max(x).alias(x) for x in BARS[:4]], F.sum("volume").alias("volume")), ["timeframe", "open_time", "open_price", "high_price", "low_price", "close_price", "volume"])
)
query("rsi_macd_series", f"{Q.ALL} SELECT timeframe, strftime(open_time, '{DUCK_TIME}') AS open_time, {', '.join(f'round(avg({x}), 4) + 0.0 AS average_{x}' for x in ('rsi_normalized', 'macd_strength', 'macd_histogram_pct'))} FROM data GROUP BY timeframe, data.open_time")(
    lambda s, d: shown(M.indicator_averages(data(s, d), ["timeframe", "open_time"]), ["timeframe", "open_time", "average_rsi_normalized", "average_macd_strength", "average_macd_histogram_pct"])
)
_parts = ["ema_score", "macd_score", "rsi_score", "bollinger_score", "ema50_score", "breakout_score", "bias_score", "bias", "macd_confirmation"]
query("market_bias", f"{Q.ALL}, {Q.bias(_by)} SELECT {_by}, {', '.join(_parts)} FROM scores")(lambda s, d: M.bias_scores(data(s, d), BY))
query("timeframe_bias", f"{Q.ALL}, {Q.bias('timeframe')} SELECT timeframe, CASE WHEN bias_score > 0 THEN bias_score END AS bullish, CASE WHEN bias_score < 0 THEN bias_score END AS bearish, CASE WHEN bias_score = 0 THEN 0.25::DOUBLE END AS neutral FROM scores")(
    lambda s, d: M.timeframe_bias(data(s, d), ["timeframe"]).withColumn("neutral", F.col("neutral").cast("double"))
)
_sign = "CASE WHEN score > 0 THEN '🟢 Alcista' WHEN score < 0 THEN '🔴 Bajista' ELSE '⚪ Neutral' END"
_confirm = f"k AS (SELECT timeframe, unnest(['EMA Alignment', 'MACD', 'RSI', 'Bollinger', 'Breakout', 'Resultado']) AS signal, unnest([ema_score, macd_confirmation, rsi_score, bollinger_score, breakout_score, sign(bias_score)::INT]) AS score FROM scores)"
query("signal_confirmation", f"{Q.ALL}, {Q.bias('timeframe')}, {_confirm} SELECT *, {_sign} AS label FROM k")(lambda s, d: M.confirmations(data(s, d), ["timeframe"]))
_pivot = lambda row, value: ", ".join(f"max({value}) FILTER (WHERE timeframe = '{t}') AS \"{t}\"" for t in FRAMES)
query("confirmation_matrix", f"{Q.ALL}, {Q.bias('timeframe')}, {_confirm} SELECT signal, {_pivot('signal', _sign)} FROM k GROUP BY signal")(lambda s, d: M.confirmation_matrix(data(s, d), FRAMES))
query("bias_matrix", f"{Q.ALL}, {Q.bias(_by)} SELECT symbol, {_pivot('symbol', 'bias')} FROM scores GROUP BY symbol")(lambda s, d: M.bias_matrix(data(s, d), FRAMES))
query("strength_ranking", f"{Q.ALL}, {Q.bias(_by)} SELECT {_by}, bias_score FROM scores ORDER BY bias_score DESC, {_by}")(lambda s, d: M.strength_ranking(data(s, d), BY))
query("signal_events", f"{Q.ALL}, e AS (" + " UNION ALL ".join(f"SELECT {_by}, '{k}' AS signal_type, count(*) AS events FROM data WHERE {Q.any_of(*n)} GROUP BY {_by}" for k, (_, n) in M.SIGNAL_TYPES.items()) + ") SELECT * FROM e")(lambda s, d: M.signal_events(data(s, d), BY))
query("risk_scatter", f"{Q.ALL} SELECT a.*, total_volume FROM (SELECT {_by}, round(avg(atr_pct), 4) + 0.0 AS average_atr_pct, round(avg(rsi_normalized), 4) + 0.0 AS average_rsi_normalized FROM data GROUP BY {_by}) a JOIN (SELECT {_by}, round(sum(volume), 2) + 0.0 AS total_volume FROM candles GROUP BY {_by}) USING ({_by})")(
    lambda s, d: shown(M.risk_scatter(candles(s, d), data(s, d), BY), [*BY, "average_atr_pct", "average_rsi_normalized", "total_volume"])
)
query("volume_treemap", f"{Q.TO_CANDLES} SELECT {_by}, round(sum(volume), 2) + 0.0 AS total_volume FROM candles GROUP BY {_by}")(lambda s, d: shown(candles(s, d).groupBy(*BY).agg(F.sum("volume").alias("total_volume")), [*BY, "total_volume"]))
_category = f"""c0 AS (SELECT timeframe, symbol, CASE WHEN ema_bullish_alignment THEN 1 WHEN ema_bearish_alignment THEN -1 ELSE 0 END + CASE WHEN {Q.any_of("macd_bullish_cross", "macd_positive")} THEN 1 WHEN macd_bearish_cross THEN -1 ELSE 0 END
    + CASE WHEN coalesce(rsi_normalized, 0) >= 0.6 THEN 1 WHEN coalesce(rsi_normalized, 0) <= 0.4 THEN -1 ELSE 0 END
    + CASE WHEN coalesce(bollinger_breakout_up, false) OR coalesce(bollinger_position, 0) >= 0.6 THEN 1 WHEN coalesce(bollinger_breakout_down, false) OR coalesce(bollinger_position, 0) <= 0.4 THEN -1 ELSE 0 END
    + CASE WHEN coalesce(breakout_confirmation, false) AND {Q.any_of("new_20_high", "new_50_high")} THEN 1 WHEN coalesce(breakout_confirmation, false) AND {Q.any_of("new_20_low", "new_50_low")} THEN -1 ELSE 0 END AS score FROM data),
c1 AS (SELECT timeframe, symbol, CASE WHEN score >= 2 THEN 'Bullish' WHEN score <= -2 THEN 'Bearish' ELSE 'Neutral' END AS bias_category FROM c0)"""
query("state_distribution", f"{Q.ALL}, {_category} SELECT {_by}, bias_category, count(*) AS states, CASE bias_category WHEN 'Bullish' THEN 1 WHEN 'Bearish' THEN -1 ELSE 0 END AS distribution_score FROM c1 GROUP BY ALL")(lambda s, d: M.state_distribution(data(s, d), BY))


# Snapshots, incremental protocols and keyed writes: the target is what was there before the cut.
CUT = {"1h": "2024-01-20 00:00:00", "1d": "1998-06-01 00:00:00"}


def _before(df: DataFrame, late: bool = False) -> DataFrame:
    """The table as it was: up to the cut, and (late) without every seventh hour, as rows that come late."""
    out = df.where(F.col("open_time") < F.lit(CUT["1h"]).cast("timestamp"))
    return out.where(F.hour("open_time") % 7 != 3) if late else out


def hours(s: SparkSession, d: str) -> DataFrame:
    return C.candles(s, d, ("1h",))


_h = "h AS (SELECT * FROM candles WHERE timeframe = '1h')"
_cut = f"TIMESTAMP '{CUT['1h']}'"
_late = f"t AS (SELECT * FROM h WHERE open_time < {_cut} AND hour(open_time) % 7 <> 3)"
_keys = [*KEY, "close_price"]
_shown_keys = ", ".join(sql(k) for k in _keys)
query("high_water_global", f"{Q.TO_CANDLES}, {_h}, {_late} SELECT {_shown_keys} FROM h WHERE open_time > (SELECT max(open_time) FROM t)")(lambda s, d: shown(I.above_high_water(hours(s, d), _before(hours(s, d), True), "global"), _keys))
query("high_water_by_key", f"{Q.TO_CANDLES}, {_h}, {_late}, x AS (SELECT symbol, max(open_time) AS top FROM t GROUP BY symbol) SELECT {_shown_keys} FROM h LEFT JOIN x USING (symbol) WHERE top IS NULL OR open_time > top")(lambda s, d: shown(I.above_high_water(hours(s, d), _before(hours(s, d), True)), _keys))
_ind = [*KEY, "ema_9", "sma_20", "rsi_14", "macd"]
query("incremental_set_difference", f"{Q.TO_INDICATORS}, {_h}, {_late} SELECT {', '.join(sql(k) for k in _ind)} FROM indicators i WHERE timeframe = '1h' AND NOT EXISTS (SELECT 1 FROM t WHERE t.symbol = i.symbol AND t.open_time = i.open_time)")(
    lambda s, d: shown(I.set_difference(hours(s, d), _before(hours(s, d), True), T.with_indicators), _ind)
)
query("incremental_lookback", f"{Q.ALL}, {_h} SELECT {', '.join(sql(k) for k in [*KEY, 'distance_to_20_high', 'price_change_5'])} FROM (SELECT timeframe, exchange, symbol, open_time, {Q.pct(Q.frame('max(high_price)', 20) + ' - close_price', 'close_price')} AS distance_to_20_high, {Q.change('close_price', 5)} AS price_change_5 FROM h WHERE open_time >= (SELECT max(open_time) FROM h WHERE open_time < {_cut}) - INTERVAL 5 DAY {Q.O}) WHERE open_time >= {_cut}")(
    lambda s, d: shown(I.lookback(hours(s, d), _before(hours(s, d)), lambda x: x.withColumns({k: v for g in (FEATURE_GROUPS["price_action"]().items(), FEATURE_GROUPS["momentum"]().items()) for k, v in g if k in ("distance_to_20_high", "price_change_5")}), 5, "global"), [*KEY, "distance_to_20_high", "price_change_5"])
)
query("upsert_merge", f"{Q.TO_CANDLES}, {_h} SELECT {_shown_keys.replace('close_price', 'CASE WHEN open_time >= ' + _cut + ' - INTERVAL 2 DAY THEN close_price + 1 ELSE close_price END AS close_price')} FROM h")(
    lambda s, d: shown(I.upserted(_before(hours(s, d)), hours(s, d).where(F.col("open_time") >= F.lit(CUT["1h"]).cast("timestamp") - F.expr("INTERVAL 2 DAYS")).withColumn("close_price", F.col("close_price") + 1), KEY), _keys)
)
query("insert_ignore", f"{Q.TO_CANDLES}, {_h} SELECT {_shown_keys} FROM h WHERE open_time >= {_cut}")(lambda s, d: shown(I.not_yet_there(hours(s, d).union(hours(s, d)), _before(hours(s, d)), KEY), _keys))


@query("latest_snapshot", f"""WITH p AS (SELECT event_type AS symbol, arg_max(value, ts) AS price, max(ts) AS price_at FROM events GROUP BY 1),
t AS (SELECT event_type AS symbol, max(value) AS high_price, min(value) AS low_price, count(*) AS count FROM events e JOIN (SELECT event_type, max(ts) AS top FROM events GROUP BY 1) USING (event_type) WHERE ts > top - INTERVAL 24 HOUR GROUP BY 1)
SELECT 'BINANCE' AS exchange, symbol, price, high_price, low_price, count, strftime(price_at, '{DUCK_TIME}') AS snapshot_time FROM p JOIN t USING (symbol)""")
def latest_snapshot(s, d):
    ticks = event_ticks(s, d).withColumn("ingested_at", F.col("ts"))
    tops = ticks.groupBy("exchange", "symbol").agg(F.max("ts").alias("top"))
    day = ticks.join(tops, ["exchange", "symbol"]).where(F.col("ts") > F.col("top") - F.expr("INTERVAL 24 HOURS"))
    tickers = day.groupBy("exchange", "symbol").agg(F.max("price").alias("high_price"), F.min("price").alias("low_price"), F.count(F.lit(1)).alias("count"), F.max("ts").alias("ingested_at"))
    return C.latest_snapshot(ticks.select("exchange", "symbol", "price", "ingested_at"), tickers).select("exchange", "symbol", "price", "high_price", "low_price", "count", col("snapshot_time"))


# Validation and data tests.
@query("price_violations", "SELECT event_id, CASE WHEN trim(event_type) = '' THEN 'symbol_blank' ELSE 'price_not_positive' END AS violation FROM (SELECT event_id, event_type, CASE WHEN event_id % 97 = 0 THEN -value WHEN event_id % 101 = 0 THEN 'nan'::DOUBLE ELSE value END AS price FROM events) WHERE NOT (price > 0 AND NOT isnan(price))")
def price_violations(s, d):
    price = F.when(F.col("event_id") % 97 == 0, -F.col("value")).when(F.col("event_id") % 101 == 0, F.lit(float("nan"))).otherwise(F.col("value"))
    return V.violations(scan(s, d, "events").select("event_id", F.col("event_type").alias("symbol"), price.alias("price")), "price").select("event_id", "violation")


@query("kline_violations", f"{Q.TO_CANDLES}, k AS (SELECT *, CASE WHEN number_of_trades % 5 = 4 THEN low_price - 1 ELSE high_price END AS h FROM candles WHERE timeframe = '1h') SELECT {', '.join(sql(x) for x in KEY)}, CASE WHEN low_price <= 0 OR h <= 0 OR open_price <= 0 OR close_price <= 0 THEN 'price' ELSE 'high_below_low' END AS violation FROM k WHERE open_price <= 0 OR close_price <= 0 OR low_price <= 0 OR h <= 0 OR h < low_price")
def kline_violations(s, d):
    bad = hours(s, d).withColumn("high_price", F.when(F.col("number_of_trades") % 5 == 4, F.col("low_price") - 1).otherwise(F.col("high_price")))
    out = V.violations(bad, "kline")
    return out.select(*[col(x) for x in KEY], F.when(F.col("violation").contains("price_not"), "price").otherwise(F.col("violation")).alias("violation"))


_day = "day(open_time)"


def seeded(df: DataFrame) -> DataFrame:
    """Indicators with each kind of error put in on some days of the month, so that the tests have something to find."""
    on = lambda n: F.day("open_time") == n
    out = df.withColumn("macd_histogram", F.when(on(5), F.col("macd_histogram") + 1e-3).otherwise(F.col("macd_histogram")))
    out = out.withColumn("bb_upper", F.when(on(9), F.col("bb_lower") - 1).when(on(13), F.lit(None)).otherwise(F.col("bb_upper")))
    return out.withColumn("bb_middle", F.when(on(17), F.lit(None)).otherwise(F.col("bb_middle"))).withColumn("macd", F.when(on(21), F.lit(None)).when(on(25), F.col("macd") + 1e-6).otherwise(F.col("macd")))


_seeded = f"""x AS (SELECT * REPLACE (CASE WHEN {_day} = 5 THEN macd_histogram + 1e-3 ELSE macd_histogram END AS macd_histogram,
    CASE {_day} WHEN 9 THEN bb_lower - 1 WHEN 13 THEN NULL ELSE bb_upper END AS bb_upper, CASE {_day} WHEN 17 THEN NULL ELSE bb_middle END AS bb_middle,
    CASE {_day} WHEN 21 THEN NULL WHEN 25 THEN macd + 1e-6 ELSE macd END AS macd) FROM indicators)"""
_k = ", ".join(sql(x) for x in KEY)
query(
    "indicator_invariants",
    f"""{Q.TO_INDICATORS}, {_seeded} SELECT {_k}, 'histogram' AS broken FROM x WHERE abs(macd_histogram - (macd - macd_signal)) > 1e-9
    UNION ALL SELECT {_k}, 'band_order' FROM x WHERE NOT (bb_upper >= bb_middle AND bb_middle >= bb_lower)
    UNION ALL SELECT {_k}, 'band_missing' FROM x WHERE rn >= 20 AND (bb_upper IS NULL OR bb_middle IS NULL OR bb_lower IS NULL)""",
)(lambda s, d: V.invariants(seeded(indicated(s, d))).select(*[col(x) for x in KEY], "broken"))


@query(
    "historical_reference",
    f"""{Q.TO_INDICATORS}, {_seeded}, b AS (SELECT x.*, {", ".join(f"i.{c} AS {c}_r" for c in V.REFERENCE)} FROM x JOIN indicators i USING (timeframe, exchange, symbol, open_time))
    SELECT {_k} FROM b WHERE {" OR ".join(f"({c} IS NULL) IS DISTINCT FROM ({c}_r IS NULL) OR abs({c} - {c}_r) > 1e-7" for c in V.REFERENCE)}""",
)
def historical_reference(s, d):
    """Rows of a table of indicators that differ from what other formulas give: those with seeded errors, and no others."""
    x = candles(s, d)
    return V.differences(seeded(T.with_indicators(x)), V.reference_indicators(x), V.REFERENCE, tolerance=1e-7).select(*[col(k) for k in KEY])


_flat = "x AS (SELECT * REPLACE (CASE WHEN timeframe = '1d' AND symbol IN ('A', 'N') THEN 1.5 ELSE macd_signal END AS macd_signal) FROM indicators)"
query("macd_signal_flat", f"{Q.TO_INDICATORS}, {_flat}, n AS (SELECT *, row_number() OVER (PARTITION BY timeframe, exchange, symbol ORDER BY open_time DESC) AS k FROM x), g AS (SELECT timeframe, count(*) AS c, count(DISTINCT macd_signal) AS v FROM n WHERE k <= 20 GROUP BY timeframe, exchange, symbol) SELECT timeframe, count(*) FILTER (WHERE c = 20) AS series, count(*) FILTER (WHERE c = 20 AND v <= 1) AS flat FROM g GROUP BY timeframe HAVING count(*) FILTER (WHERE c = 20 AND v <= 1) > 0")(
    lambda s, d: V.flat_signals(indicated(s, d).withColumn("macd_signal", F.when((F.col("timeframe") == "1d") & F.col("symbol").isin("A", "N"), 1.5).otherwise(F.col("macd_signal"))))
)
query("coverage_anti_join", f"{Q.TO_CANDLES}, {_h}, {_late} SELECT {', '.join(sql(x) for x in KEY)} FROM h ANTI JOIN t USING (timeframe, exchange, symbol, open_time)")(lambda s, d: V.uncovered(hours(s, d), _before(hours(s, d), True)).select(*[col(x) for x in KEY]))
query("not_null", "SELECT 'rsi_14' AS \"column\", count(*) AS nulls FROM (" + f"{Q.TO_INDICATORS} SELECT * FROM indicators) WHERE rsi_14 IS NULL")(lambda s, d: V.null_counts(indicated(s, d), ["symbol", "ema_9", "sma_20", "rsi_14"]))
query("accepted_timeframes", f"{Q.TO_CANDLES} SELECT timeframe AS value, count(*) AS rows FROM candles WHERE timeframe NOT IN ('5m', '15m', '30m', '1h', '1d') GROUP BY timeframe")(lambda s, d: V.unaccepted(candles(s, d), "timeframe", ["5m", "15m", "30m", "1h", "1d"]))
query("top20_per_key", f"{Q.TO_CANDLES} SELECT {_shown_keys}, rn FROM (SELECT *, row_number() OVER (PARTITION BY timeframe, exchange, symbol ORDER BY open_time DESC) AS rn FROM candles) WHERE rn <= 20")(
    lambda s, d: candles(s, d).withColumn("rn", F.row_number().over(Window.partitionBy(*KEY[:3]).orderBy(F.desc("open_time")))).where("rn <= 20").select(*[col(x) for x in _keys], F.col("rn").cast("long").alias("rn"))
)
query("table_counts", f"{Q.ALL} SELECT 'candles' AS layer, count(*) AS rows FROM candles UNION ALL SELECT 'dataset', count(*) FROM data")(lambda s, d: candles(s, d).agg(F.count(F.lit(1)).alias("rows")).select(F.lit("candles").alias("layer"), "rows").union(data(s, d).agg(F.count(F.lit(1)).alias("rows")).select(F.lit("dataset"), "rows")))


# Staging: events as raw prices, hourly candles as klines, days as tickers.
def _hour_klines(s: SparkSession, d: str) -> DataFrame:
    return hours(s, d).select("symbol", *KINDS["kline"].keys() - {"symbol"}, "ingested_at")


query("staging_prices", f"SELECT 'BINANCE' AS exchange, event_type AS symbol, value AS price, strftime(ts, '{DUCK_TIME}') AS ingested_at FROM events")(
    lambda s, d: G.staging(scan(s, d, "events").select(F.col("event_type").alias("symbol"), F.col("value").alias("price"), F.col("ts").alias("ingested_at")), "price").select("exchange", "symbol", "price", col("ingested_at"))
)
_kline = ["exchange", "symbol", "open_time", "close_time", *BARS, *SUMS, "ingested_at"]
query("staging_klines", f"{Q.TO_CANDLES} SELECT {', '.join(sql(x) for x in _kline)} FROM candles WHERE timeframe = '1h'")(lambda s, d: shown(G.staging(_hour_klines(s, d), "kline"), _kline))
query("market_candles", f"{Q.TO_CANDLES} SELECT {', '.join(sql(x) for x in _kline)}, '1m' AS interval FROM candles WHERE timeframe = '1h'")(
    lambda s, d: shown(G.of_interval(G.market_candles(G.staging(_hour_klines(s, d), "kline")).unionByName(G.market_candles(G.staging(_hour_klines(s, d), "kline"), "5m"))), [*_kline, "interval"])
)
_ticker = ["symbol", "price_change", "last_price", "open_price", "high_price", "low_price", "volume", "count"]
_tickers = "t AS (SELECT symbol, close_price - open_price AS price_change, close_price AS last_price, open_price, high_price, low_price, volume, number_of_trades AS count, open_time, close_time FROM candles WHERE timeframe = '1h')"


def _raw_tickers(s: SparkSession, d: str) -> DataFrame:
    """Hours as an exchange's ticker records: JSON with its own names, numbers as text."""
    text = lambda x: F.col(x).cast("decimal(28,8)").cast("string")
    fields = {"priceChange": (F.col("close_price") - F.col("open_price")).cast("decimal(28,8)").cast("string"), "lastPrice": text("close_price"), "openPrice": text("open_price"), "highPrice": text("high_price"), "lowPrice": text("low_price"), "volume": text("volume"), "quoteVolume": text("quote_asset_volume")}
    zero = [k for k, (_, t) in K.TICKER.items() if t.startswith("decimal") and k not in fields]
    times = {"openTime": F.unix_millis("open_time"), "closeTime": F.unix_millis("close_time"), "firstId": F.lit(1), "lastId": F.lit(2), "count": F.col("number_of_trades")}
    value = F.struct(F.col("symbol"), *[x.alias(k) for k, x in (fields | times).items()], *[F.lit("0").alias(k) for k in zero])
    return hours(s, d).select("symbol", F.to_json(value).alias("value"), "ingested_at")


query("staging_tickers", f"{Q.TO_CANDLES}, {_tickers} SELECT 'BINANCE' AS exchange, symbol, round(price_change, 4) + 0.0 AS price_change, last_price, open_price, high_price, low_price, round(volume, 2) + 0.0 AS volume, count, strftime(open_time, '{DUCK_TIME}') AS open_time, strftime(close_time, '{DUCK_TIME}') AS close_time FROM t")(
    lambda s, d: G.staging(K.typed(K.named(_raw_tickers(s, d).select("symbol", "value"), "ticker"), "ticker").withColumn("ingested_at", F.col("close_time")), "ticker").select("exchange", "symbol", (F.round(F.col("price_change").cast("double"), 4) + 0.0).alias("price_change"), *[F.col(x).cast("double").alias(x) for x in _ticker[2:-2]], (F.round(F.col("volume").cast("double"), 2) + 0.0).alias("volume"), "count", col("open_time"), col("close_time"))
)


@query(
    "ticker_violations",
    f"""{Q.TO_CANDLES}, {_tickers}, v AS (SELECT symbol, open_time, CASE count % 7 WHEN 1 THEN 'high_below_low' WHEN 2 THEN 'last_price_negative' WHEN 3 THEN 'volume_negative' WHEN 4 THEN 'count_invalid' WHEN 5 THEN 'times_out_of_order' END AS violation FROM t)
    SELECT symbol, strftime(open_time, '{DUCK_TIME}') AS open_time, violation FROM v WHERE violation IS NOT NULL""",
)
def ticker_violations(s, d):
    """Every rule on tickers, broken by the number of trades modulo 7; the record is otherwise in order."""
    n = F.col("count").cast("int") % 7
    x = K.named(_raw_tickers(s, d).select("symbol", "value"), "ticker").withColumn("number", n).withColumn("own", F.col("open_time"))
    bad = {"high_price": (1, F.lit("-1")), "last_price": (2, F.lit("-0.1")), "volume": (3, F.lit("-5")), "count": (4, F.lit("1.5")), "close_time": (5, F.col("open_time"))}
    x = x.withColumns({k: F.when(F.col("number") == m, v).otherwise(F.col(k)) for k, (m, v) in bad.items()})
    return V.violations(x, "ticker").select("symbol", F.date_format(F.timestamp_millis(F.col("own").cast("bigint")), TIME).alias("open_time"), "violation")


# Star joins, views, selections, formats.
query("star_joins", f"{Q.ALL} SELECT timeframe, CASE timeframe WHEN '1h' THEN 4 WHEN '1d' THEN 5 END AS sort_order, month(open_time)::INT AS month_number, count(*) AS candles FROM candles GROUP BY ALL")(
    lambda s, d: M.star(candles(s, d), {"timeframe": F.broadcast(M.dim_timeframe(s)), "open_time": M.dim_datetime(candles(s, d), candles(s, d).limit(0))}).groupBy("timeframe", "sort_order", "month_number").agg(F.count(F.lit(1)).alias("candles"))
)
query("sliced_candles", f"{Q.TO_CANDLES} SELECT {_shown_keys} FROM candles WHERE timeframe = '1d' AND symbol IN ('A', 'R') AND open_time BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1996-06-30'")(
    lambda s, d: shown(M.sliced(candles(s, d), symbol=["A", "R"], timeframe=["1d"], start="1995-01-01", end="1996-06-30"), _keys)
)
query("volume_cards", f"{Q.TO_CANDLES}, v AS (SELECT {_by}, sum(volume) AS x FROM candles GROUP BY {_by}) SELECT {_by}, CASE WHEN abs(x) >= 1e9 THEN printf('%.2fB', x / 1e9) WHEN abs(x) >= 1e6 THEN printf('%.2fM', x / 1e6) WHEN abs(x) >= 1e3 THEN printf('%.2fK', x / 1e3) ELSE format('{{:,.2f}}', x) END AS shown FROM v")(
    lambda s, d: candles(s, d).groupBy(*BY).agg(F.sum("volume").alias("x")).select(*BY, M.number_format(F.col("x")).alias("shown"))
)


@query("view_latest", f"{Q.TO_CANDLES} SELECT timeframe, symbol, strftime(max(open_time), '{DUCK_TIME}') AS top_time, count(*) AS candles FROM candles GROUP BY timeframe, symbol")
def view_latest(s, d):
    """The candles as a view, asked by SQL."""
    (name,) = M.views(s, {"market_candles_bi": candles(s, d)}, "gold")
    return s.sql(f"SELECT timeframe, symbol, date_format(max(open_time), '{TIME}') AS top_time, count(*) AS candles FROM {name} GROUP BY timeframe, symbol")


# Runs on keyed tables, in a folder of their own.
def _table(s: SparkSession, name: str, df: DataFrame, key: list[str], by=None) -> I.Table:
    return I.Table(s, I.scratch(s, name), df.schema, key, by)


@query("reprocess_window_run", f"{Q.TO_CANDLES}, {_h}, r AS ({Q.longer('h', 1440, 24)}) SELECT {', '.join(sql(x) for x in ['exchange', 'symbol', 'open_time', 'close_price', 'number_of_trades'])} FROM r")
def reprocess_window_run(s, d):
    """Days from hours, some of which come late, by runs that each make the last three days anew: the same as a full refresh."""
    x = hours(s, d).drop("timeframe")
    late = (F.hour("open_time") == 7) & (F.day("open_time") % 3 == 0)
    day = lambda df: C.aggregate(df, 1440, 60)
    target = _table(s, "days", day(x), KEY[1:], F.date_trunc("month", "open_time"))
    target.replace(day(x.where(~late | (F.col("open_time") < F.lit("2024-01-08").cast("timestamp")))))
    for _ in range(2):  # the late hours are there; days that they complete may be older than the newest day by any time
        I.reprocess(x, target, day, 400)
    return target.read().select(*[col(k) for k in KEY[1:]], "close_price", "number_of_trades")


@query("append_run", f"{Q.TO_CANDLES}, {_h} SELECT {_shown_keys} FROM h UNION ALL SELECT {_shown_keys} FROM h WHERE open_time >= {_cut}")
def append_run(s, d):
    x = hours(s, d).select(*_keys)
    target = _table(s, "appended", x, KEY, F.to_date("open_time"))
    target.append(x)
    target.append(x.where(F.col("open_time") >= F.lit(CUT["1h"]).cast("timestamp")))
    return shown(target.read(), _keys)


@query("insert_ignore_run", f"{Q.TO_CANDLES}, {_h} SELECT {_shown_keys} FROM h")
def insert_ignore_run(s, d):
    """What is there stays, and of new rows of one key the first by price comes in."""
    x = hours(s, d).select(*_keys)
    target = _table(s, "inserted", x, KEY, F.to_date("open_time"))
    target.insert_ignore(_before(x, True))
    target.insert_ignore(x.unionByName(x.withColumn("close_price", F.col("close_price") + 7)), [F.col("close_price")])
    return shown(target.read(), _keys)


@query("snapshot_run", f"""{Q.TO_CANDLES}, {_h}, t AS (SELECT exchange, symbol, arg_max(close_price, open_time) AS price, max(close_time) AS snapshot_time FROM h GROUP BY ALL
    UNION ALL SELECT exchange, symbol, arg_max(close_price, open_time), max(close_time) FROM h WHERE open_time < {_cut} GROUP BY ALL) SELECT exchange, symbol, price, {sql('snapshot_time')} FROM t""")
def snapshot_run(s, d):
    """The snapshot of two times, upserted by its own time; a run on the same data changes nothing."""
    x = hours(s, d)
    at = lambda df: C.latest_snapshot(df.select("exchange", "symbol", F.col("close_price").alias("price"), F.col("close_time").alias("ingested_at")), df.select("exchange", "symbol", F.col("volume").alias("ticker_volume"), F.col("close_time").alias("ingested_at"))).select("exchange", "symbol", "price", "snapshot_time")
    target = _table(s, "snapshots", at(x), ["exchange", "symbol", "snapshot_time"])
    for df in (_before(x), x, x):
        target.upsert(at(df))
    return target.read().select("exchange", "symbol", "price", col("snapshot_time"))


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)
