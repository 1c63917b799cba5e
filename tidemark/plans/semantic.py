"""The semantic layer: dimensions, measures by any grouping, and report queries.

A measure is an aggregate over the rows of a group; a filter on the input is the rest of its context. Null flags count as
false, and blanks compare as 0, as in the reports that these measures serve.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

c = F.col


def flag(*names: str) -> Column:
    """Whether any of the flags is true."""
    return reduce(lambda a, b: a | b, [F.coalesce(c(n), F.lit(False)) for n in names])


# Rows of the constant tables.
TIMEFRAMES = [("5m", 1), ("15m", 2), ("30m", 3), ("1h", 4), ("1d", 5)]
INDICATORS = {"RSI Normalized": "rsi_normalized", "MACD Strength": "macd_strength", "MACD Histogram": "macd_histogram_pct", "ATR %": "atr_pct", "Bollinger Position": "bollinger_position", "Price vs EMA50 %": "price_vs_ema50_pct"}
MATRIX = ["EMA Alignment", "MACD", "RSI", "Bollinger", "Breakout", "Resultado"]
SIGNAL_TYPES = {
    "MACD Bullish Cross": ("Bullish", ("macd_bullish_cross",)),
    "MACD Bearish Cross": ("Bearish", ("macd_bearish_cross",)),
    "Golden Cross": ("Bullish", ("golden_cross",)),
    "Death Cross": ("Bearish", ("death_cross",)),
    "Breakout": ("Neutral", ("breakout_confirmation", "bollinger_breakout_up", "bollinger_breakout_down")),
    "New High": ("Bullish", ("new_20_high", "new_50_high")),
    "New Low": ("Bearish", ("new_20_low", "new_50_low")),
}
BULLISH = ("ema_bullish_alignment", "golden_cross", "rsi_recovering", "macd_bullish_cross", "macd_positive", "bollinger_breakout_up", "new_20_high", "new_50_high", "breakout_confirmation")
BEARISH = ("ema_bearish_alignment", "death_cross", "rsi_overbought", "macd_bearish_cross", "bollinger_breakout_down", "new_20_low", "new_50_low")


def dim_timeframe(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TIMEFRAMES, "timeframe string, sort_order int")


def selector(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, i + 1) for i, k in enumerate(INDICATORS)], "indicator string, sort int")


def signal_matrix(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, i + 1) for i, k in enumerate(MATRIX)], "signal string, sort int")


def signal_types(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(k, p, i + 1) for i, (k, (p, _)) in enumerate(SIGNAL_TYPES.items())], "signal_type string, polarity string, sort int")


def number_format(x: Column) -> Column:
    """A number as cards show it, with two decimals: thousands with K, millions with M, billions with B, smaller ones with commas."""
    size, shown = F.abs(x), lambda unit, mark: F.format_string(f"%.2f{mark}", x / unit)
    return F.when(size >= 1e9, shown(1e9, "B")).when(size >= 1e6, shown(1e6, "M")).when(size >= 1e3, shown(1e3, "K")).otherwise(F.format_number(x, 2))


def star(fact: DataFrame, dimensions: dict[str, DataFrame]) -> DataFrame:
    """A fact with the columns of its dimensions, each joined by its key (facts filter through them); a dimension has one row a key, so none is lost or doubled."""
    for key, dimension in dimensions.items():
        fact = fact.join(dimension, key, "left")
    return fact


def views(spark: SparkSession, tables: dict[str, DataFrame], schema: str = "") -> list[str]:
    """Temporary views of the layers by name, for SQL; with a schema, its name goes before theirs as it is."""
    names = [f"{schema}_{k}" if schema else k for k in tables]
    for name, df in zip(names, tables.values()):
        df.createOrReplaceTempView(name)
    return names


def sliced(df: DataFrame, exchange: list[str] | None = None, symbol: list[str] | None = None, timeframe: list[str] | None = None, start=None, end=None) -> DataFrame:
    """Rows of a report's selection; none given selects all. Plain comparisons, so they reach the scans."""
    for name, values in (("exchange", exchange), ("symbol", symbol), ("timeframe", timeframe)):
        if values:
            df = df.where(c(name).isin(*values))
    if start is not None:
        df = df.where(c("open_time") >= F.lit(start).cast("timestamp"))
    return df if end is None else df.where(c("open_time") <= F.lit(end).cast("timestamp"))


def dim(candles: DataFrame, data: DataFrame, column: str) -> DataFrame:
    """Distinct values of a key column of both facts."""
    return candles.select(column).union(data.select(column)).distinct()


def dim_datetime(candles: DataFrame, data: DataFrame) -> DataFrame:
    t = c("open_time")
    parts = {"date": F.to_date(t), "year": F.year(t), "month_number": F.month(t), "month_name": F.date_format(t, "MMMM"), "day": F.day(t), "hour": F.hour(t), "minute": F.minute(t), "date_label": F.date_format(t, "dd MMM yyyy HH:mm")}
    return dim(candles, data, "open_time").withColumns(parts)


def with_bias_category(data: DataFrame) -> DataFrame:
    """Row-wise state: Bullish, Bearish or Neutral by five scores. A missing number scores as 0 would."""
    rsi, boll = F.coalesce("rsi_normalized", F.lit(0.0)), F.coalesce("bollinger_position", F.lit(0.0))
    score = (
        F.when(flag("ema_bullish_alignment"), 1).when(flag("ema_bearish_alignment"), -1).otherwise(0)
        + F.when(flag("macd_bullish_cross", "macd_positive"), 1).when(flag("macd_bearish_cross"), -1).otherwise(0)
        + F.when(rsi >= 0.60, 1).when(rsi <= 0.40, -1).otherwise(0)
        + F.when(flag("bollinger_breakout_up") | (boll >= 0.60), 1).when(flag("bollinger_breakout_down") | (boll <= 0.40), -1).otherwise(0)
        + F.when(flag("breakout_confirmation") & flag("new_20_high", "new_50_high"), 1).when(flag("breakout_confirmation") & flag("new_20_low", "new_50_low"), -1).otherwise(0)
    )
    return data.withColumn("bias_category", F.when(score >= 2, "Bullish").when(score <= -2, "Bearish").otherwise("Neutral"))


def newest(value: Column) -> Column:
    """The largest of the value at the latest time: one aggregate, no join to the group's own maximum."""
    return F.max(F.struct(c("open_time"), value.alias("v")))["v"]


def oldest(value: Column) -> Column:
    """The smallest of the value at the first time."""
    return F.min(F.struct(c("open_time"), value.alias("v")))["v"]


def candle_measures(candles: DataFrame, by: list[str]) -> DataFrame:
    """All measures of candles for each group."""
    out = candles.groupBy(*by).agg(
        *[newest(c(f"{k}_price")).alias(f"latest_{k}") for k in ("close", "open", "high")],
        (-newest(-c("low_price"))).alias("latest_low"),
        F.max("open_time").alias("latest_time"),
        oldest(c("open_price")).alias("period_open"),
        newest(c("close_price")).alias("period_close"),
        F.max("high_price").alias("period_high"),
        F.min("low_price").alias("period_low"),
        F.sum("volume").alias("total_volume"),
        F.avg("volume").alias("average_volume"),
        F.max("close_price").alias("close_price"),
        F.count(F.lit(1)).alias("candle_count"),
    )
    # A sum at the latest time: by time first, added up within each task.
    at_last = candles.groupBy(*by, "open_time").agg(F.sum("volume").alias("v")).groupBy(*by).agg(newest(c("v")).alias("latest_volume"))
    out = out.join(at_last, by)
    return out.withColumn("period_change", F.try_divide(c("period_close") - c("period_open"), c("period_open")))


def current(x: str) -> Column:
    """The column's value at the latest time that has one."""
    return F.max(F.when(c(x).isNotNull(), F.struct("open_time", c(x).alias("v"))))["v"]


def current_indicators(data: DataFrame, by: list[str]) -> DataFrame:
    return data.groupBy(*by).agg(*[current(x).alias(f"current_{x}") for x in ("rsi_normalized", "atr_pct", "macd_strength", "macd_histogram_pct", "bollinger_position", "price_vs_ema50_pct")])


def signal_counts(data: DataFrame, by: list[str]) -> DataFrame:
    """Rows with a bullish, a bearish, or neither condition, and their shares."""
    bull, bear = flag(*BULLISH), flag(*BEARISH)
    out = data.groupBy(*by).agg(F.count_if(bull).alias("bullish"), F.count_if(bear).alias("bearish"), F.count_if(~(bull | bear)).alias("neutral"), F.count(F.lit(1)).alias("states"))
    return out.withColumn("bullish_ratio", c("bullish") / c("states")).withColumn("bearish_ratio", c("bearish") / c("states"))


def indicator_averages(data: DataFrame, by: list[str]) -> DataFrame:
    return data.groupBy(*by).agg(*[F.avg(x).alias(f"average_{x}") for x in INDICATORS.values()])


def selected_indicator(data: DataFrame, by: list[str], indicator: str | None = None) -> DataFrame:
    """Average of the indicator chosen by name (unknown or none: the first), with its title."""
    name = indicator if indicator in INDICATORS else next(iter(INDICATORS))
    return data.groupBy(*by).agg(F.avg(INDICATORS[name]).alias("value")).withColumn("title", F.lit(f"{name} over time"))


def sign(x: Column) -> Column:
    return F.when(x > 0, 1).when(x < 0, -1).otherwise(0)


def bias_scores(data: DataFrame, by: list[str]) -> DataFrame:
    """The parts of the market bias for each group, their sum, its label, and the scores of the confirmation matrix."""
    confirmed = flag("breakout_confirmation")
    up = flag("bollinger_breakout_up", "new_20_high", "new_50_high") | (confirmed & F.coalesce(c("price_vs_ema50_pct") >= 0, F.lit(True)))
    down = flag("bollinger_breakout_down", "new_20_low", "new_50_low") | (confirmed & F.coalesce(c("price_vs_ema50_pct") < 0, F.lit(False)))
    g = data.groupBy(*by).agg(
        newest(c("ema_alignment")).alias("ema"),
        *[F.coalesce(current(x), F.lit(0.0)).alias(k) for k, x in (("rsi", "rsi_normalized"), ("macd", "macd_strength"), ("boll", "bollinger_position"), ("ema50", "price_vs_ema50_pct"))],
        *[newest(x.cast("int")).alias(k) for k, x in (("ups", up), ("downs", down), ("bull_crosses", flag("macd_bullish_cross")), ("bear_crosses", flag("macd_bearish_cross")))],
    )
    one_side = lambda a, b: F.when((c(a) > 0) & (c(b) == 0), 1).when((c(b) > 0) & (c(a) == 0), -1)
    parts = {
        "ema_score": sign(c("ema")),
        "macd_score": sign(c("macd")),
        "rsi_score": F.when(c("rsi") >= 0.20, 1).when(c("rsi") <= -0.20, -1).otherwise(0),
        "bollinger_score": F.when(c("boll") >= 0.60, 1).when(c("boll") <= 0.40, -1).otherwise(0),
        "ema50_score": sign(c("ema50")),
        "breakout_score": one_side("ups", "downs").otherwise(0),
    }
    out = g.withColumns(parts).withColumn("bias_score", reduce(lambda a, b: a + b, [c(p) for p in parts]))
    label = F.when(c("bias_score").isNull(), "Sin datos").when(c("bias_score") >= 4, "🟢 Strong Bullish").when(c("bias_score") >= 1, "🟢 Bullish").when(c("bias_score") <= -4, "🔴 Strong Bearish").when(c("bias_score") <= -1, "🔴 Bearish").otherwise("⚪ Neutral")
    cross = one_side("bull_crosses", "bear_crosses").otherwise(c("macd_score"))
    return out.withColumn("bias", label).withColumn("macd_confirmation", cross).select(*by, *parts, "bias_score", "bias", "macd_confirmation")


def timeframe_bias(data: DataFrame, by: list[str]) -> DataFrame:
    """Bullish, bearish and neutral component of the bias score."""
    s = c("bias_score")
    return bias_scores(data, by).select(*by, F.when(s > 0, s).alias("bullish"), F.when(s < 0, s).alias("bearish"), F.when(s == 0, 0.25).alias("neutral"))


def confirmations(data: DataFrame, by: list[str]) -> DataFrame:
    """(by, signal, score, label): one row for each row of the confirmation matrix."""
    of = dict(zip(MATRIX, (c("ema_score"), c("macd_confirmation"), c("rsi_score"), c("bollinger_score"), c("breakout_score"), sign(c("bias_score")))))
    rows = bias_scores(data, by).select(*by, F.explode(F.array(*[F.struct(F.lit(k).alias("signal"), x.cast("int").alias("score")) for k, x in of.items()])).alias("x")).select(*by, "x.*")
    return rows.withColumn("label", F.when(c("score") > 0, "🟢 Alcista").when(c("score") < 0, "🔴 Bajista").otherwise("⚪ Neutral"))


def confirmation_matrix(data: DataFrame, timeframes: list[str]) -> DataFrame:
    """Labels of signal by timeframe over all symbols."""
    return confirmations(data, ["timeframe"]).groupBy("signal").pivot("timeframe", timeframes).agg(F.first("label"))


def signal_events(data: DataFrame, by: list[str]) -> DataFrame:
    """(by, signal_type, events): rows with each type of signal, where there are any. Added up before rows are made, never exploded."""
    counts = data.groupBy(*by).agg(*[F.count_if(flag(*names)).alias(k) for k, (_, names) in SIGNAL_TYPES.items()])
    rows = counts.select(*by, F.explode(F.array(*[F.struct(F.lit(k).alias("signal_type"), c(f"`{k}`").alias("events")) for k in SIGNAL_TYPES])).alias("x"))
    return rows.select(*by, "x.*").where("events > 0")


def bias_matrix(data: DataFrame, timeframes: list[str]) -> DataFrame:
    return bias_scores(data, ["symbol", "timeframe"]).groupBy("symbol").pivot("timeframe", timeframes).agg(F.first("bias"))


def strength_ranking(data: DataFrame, by: list[str]) -> DataFrame:
    return bias_scores(data, by).select(*by, "bias_score").orderBy(F.desc("bias_score"), *by)


def risk_scatter(candles: DataFrame, data: DataFrame, by: list[str]) -> DataFrame:
    """Average ATR % against average RSI, with total volume; each fact is aggregated before they meet."""
    return indicator_averages(data, by).select(*by, "average_atr_pct", "average_rsi_normalized").join(candles.groupBy(*by).agg(F.sum("volume").alias("total_volume")), by)


def state_distribution(data: DataFrame, by: list[str]) -> DataFrame:
    score = F.when(c("bias_category") == "Bullish", 1).when(c("bias_category") == "Bearish", -1).otherwise(0)
    return with_bias_category(data).groupBy(*by, "bias_category").agg(F.count(F.lit(1)).alias("states")).withColumn("distribution_score", score)
