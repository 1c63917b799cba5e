"""Indicators, features, signals and the dataset that joins them: one projection each, no self-joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import FEATURE_GROUPS, FEATURES, KEY, SIGNAL_GROUPS, SIGNALS, averages, moves
from tidemark.functions.ema import with_ema

EMAS = (9, 21, 50, 200)
INDICATORS = ["ema_9", "ema_21", "ema_50", "ema_200", "sma_20", "sma_50", "sma_200", "rsi_14", "atr_14", "bb_middle", "bb_upper", "bb_lower", "macd", "macd_signal", "macd_histogram"]


def with_indicators(candles: DataFrame) -> DataFrame:
    """candles with the fifteen indicators."""
    out = candles.withColumns(moves()).withColumns(averages()).drop("tr", "gain", "loss")
    out = with_ema(out, {f"ema_{n}": ("close_price", n) for n in (*EMAS, 12, 26)})
    out = out.withColumn("macd", F.col("ema_12") - F.col("ema_26")).drop("ema_12", "ema_26")
    return with_ema(out, {"macd_signal": ("macd", 9)}).withColumn("macd_histogram", F.col("macd") - F.col("macd_signal"))


def feature_names() -> list[str]:
    return [n for g in FEATURES.values() for n in g]


def signal_names() -> list[str]:
    return [n for g in SIGNALS.values() for n in g]


def with_features(indicated: DataFrame) -> DataFrame:
    """Indicators (with their candles) and the twenty-seven features."""
    return indicated.withColumns({n: x for g in FEATURE_GROUPS.values() for n, x in g().items()})


def with_signals(featured: DataFrame) -> DataFrame:
    """Features (with their indicators) and the twenty-one signals, null where a part of them is."""
    return featured.withColumns({n: x for g in SIGNAL_GROUPS.values() for n, x in g().items()})


def dataset(candles: DataFrame) -> DataFrame:
    """Key, features and signals of every candle."""
    return with_signals(with_features(with_indicators(candles))).select(*KEY, *feature_names(), *signal_names())
