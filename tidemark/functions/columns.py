"""Column builders: buckets, candle attributes, indicators, features, signals.

Windows are by series (timeframe, exchange, symbol) in order of open_time. All builders of one step share the partitioning
and order, so Spark plans one exchange and one sort for them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

SERIES = ["timeframe", "exchange", "symbol"]
KEY = [*SERIES, "open_time"]


def series():
    """The window over a series in order of time."""
    return Window.partitionBy(*SERIES).orderBy("open_time")


def last(n: int):
    """The last n rows of the series, this one included; fewer at its start."""
    return series().rowsBetween(1 - n, 0)


def nz(x: Column) -> Column:
    """Null for 0, so that a division by it is null."""
    return F.nullif(x, F.lit(0.0))


def bucket(ts: Column, minutes: int) -> Column:
    """Start of the bucket of so many minutes, counted from the epoch in UTC."""
    s = minutes * 60
    return F.timestamp_seconds(F.floor(F.unix_timestamp(ts) / F.lit(s)) * F.lit(s))


c = F.col



def attributes() -> dict[str, Column]:
    o, h, low, close = (c(f"{x}_price") for x in ("open", "high", "low", "close"))
    return {
        "candle_direction": F.when(close > o, 1).when(close < o, -1).otherwise(0),
        "body_size": F.abs(close - o),
        "upper_wick": h - F.greatest(o, close),
        "lower_wick": F.least(o, close) - low,
        "candle_range": h - low,
        "typical_price": (h + low + close) / 3,
        "ohlc_average": (o + h + low + close) / 4,
    }


def moves() -> dict[str, Column]:
    """True range, gain and loss against the close before; greatest() skips the nulls of a series' first row."""
    before, close = F.lag("close_price").over(series()), c("close_price")
    return {
        "tr": F.greatest(c("high_price") - c("low_price"), F.abs(c("high_price") - before), F.abs(c("low_price") - before)),
        "gain": F.greatest(close - before, F.lit(0.0)),
        "loss": F.greatest(before - close, F.lit(0.0)),
    }


def sma(x: str, n: int) -> Column:
    return F.avg(x).over(last(n))


def rsi(n: int = 14) -> Column:
    """Of simple averages; null if either is 0. Needs moves()."""
    return 100 - 100 / (1 + nz(sma("gain", n)) / nz(sma("loss", n)))


def atr(n: int = 14) -> Column:
    return sma("tr", n)


def deviation(x: str = "close_price", n: int = 20) -> Column:
    return F.stddev_samp(x).over(last(n))


def averages() -> dict[str, Column]:
    """Every indicator of plain frames."""
    return {
        **{f"sma_{n}": sma("close_price", n) for n in (20, 50, 200)},
        "rsi_14": rsi(),
        "atr_14": atr(),
        "bb_middle": sma("close_price", 20),
        "bb_upper": sma("close_price", 20) + 2 * deviation(),
        "bb_lower": sma("close_price", 20) - 2 * deviation(),
    }


def pct(part: Column, whole: Column) -> Column:
    return part / nz(whole) * 100


def change(x: str, n: int = 1) -> Column:
    before = F.lag(x, n).over(series())
    return pct(c(x) - before, before)


def trend_features() -> dict[str, Column]:
    close = c("close_price")
    away = lambda n: pct(close - c(f"ema_{n}"), c(f"ema_{n}"))
    return {
        **{f"ema{n}_distance_pct": away(n) for n in (9, 21, 50, 200)},
        "ema_alignment": F.when((c("ema_9") > c("ema_21")) & (c("ema_21") > c("ema_50")) & (c("ema_50") > c("ema_200")), 1).otherwise(0),
        **{f"ema_slope_{n}": change(f"ema_{n}") for n in (9, 21, 50)},
        "price_vs_ema50_pct": away(50),
        "price_vs_ema200_pct": away(200),
    }


def momentum_features() -> dict[str, Column]:
    return {
        "rsi_normalized": (c("rsi_14") - 50) / 50,
        "macd_strength": pct(c("macd"), c("close_price")),
        "macd_histogram_pct": pct(c("macd_histogram"), c("close_price")),
        **{f"price_change_{n}": change("close_price", n) for n in (5, 10, 20)},
    }


def volatility_features() -> dict[str, Column]:
    width = c("bb_upper") - c("bb_lower")
    return {
        "atr_pct": pct(c("atr_14"), c("close_price")),
        "rolling_std": pct(deviation(), c("close_price")),
        "bollinger_width": pct(width, c("bb_middle")),
        "bollinger_position": (c("close_price") - c("bb_lower")) / nz(width),
    }


def price_action_features() -> dict[str, Column]:
    close, span = c("close_price"), nz(c("candle_range"))
    return {
        "candle_body_ratio": c("body_size") / span,
        "upper_wick_ratio": c("upper_wick") / span,
        "lower_wick_ratio": c("lower_wick") / span,
        **{f"distance_to_{n}_high": pct(F.max("high_price").over(last(n)) - close, close) for n in (20, 50)},
        **{f"distance_to_{n}_low": pct(close - F.min("low_price").over(last(n)), close) for n in (20, 50)},
    }


#: Names of the features of each group, in order; known without a session.
FEATURES = {
    "trend": ["ema9_distance_pct", "ema21_distance_pct", "ema50_distance_pct", "ema200_distance_pct", "ema_alignment", "ema_slope_9", "ema_slope_21", "ema_slope_50", "price_vs_ema50_pct", "price_vs_ema200_pct"],
    "momentum": ["rsi_normalized", "macd_strength", "macd_histogram_pct", "price_change_5", "price_change_10", "price_change_20"],
    "volatility": ["atr_pct", "rolling_std", "bollinger_width", "bollinger_position"],
    "price_action": ["candle_body_ratio", "upper_wick_ratio", "lower_wick_ratio", "distance_to_20_high", "distance_to_50_high", "distance_to_20_low", "distance_to_50_low"],
}
FEATURE_GROUPS: dict[str, Callable[[], dict[str, Column]]] = {"trend": trend_features, "momentum": momentum_features, "volatility": volatility_features, "price_action": price_action_features}


def crosses(a: str, b: str, up: bool) -> Column:
    """a goes above (below) b on this row, having been at or under (over) it on the row before."""
    x, y = F.lag(a).over(series()), F.lag(b).over(series())
    return (c(a) > c(b)) & (x <= y) if up else (c(a) < c(b)) & (x >= y)


def trend_signals() -> dict[str, Column]:
    return {
        "ema_bullish_alignment": c("ema_alignment") == 1,
        "ema_bearish_alignment": c("ema_alignment") == 0,
        "price_above_ema50": c("price_vs_ema50_pct") > 0,
        "price_above_ema200": c("price_vs_ema200_pct") > 0,
        "golden_cross": crosses("ema_50", "ema_200", True),
        "death_cross": crosses("ema_50", "ema_200", False),
    }


def momentum_signals() -> dict[str, Column]:
    return {
        "rsi_overbought": c("rsi_14") >= 70,
        "rsi_oversold": c("rsi_14") <= 30,
        "rsi_recovering": (c("rsi_14") > F.lag("rsi_14").over(series())) & (c("rsi_14") > 30),
        "macd_bullish_cross": crosses("macd", "macd_signal", True),
        "macd_bearish_cross": crosses("macd", "macd_signal", False),
        "macd_positive": c("macd") > 0,
    }


def volatility_signals() -> dict[str, Column]:
    return {
        "high_volatility": (c("atr_pct") > 1.5) | (c("bollinger_width") > 4.0),
        "low_volatility": (c("atr_pct") < 0.6) & (c("bollinger_width") < 2.0),
        "bollinger_breakout_up": c("bollinger_position") > 1.0,
        "bollinger_breakout_down": c("bollinger_position") < 0.0,
    }


#: Percent from an extreme within which a close counts as at it.
NEAR = 0.05


def breakout_signals() -> dict[str, Column]:
    at = lambda n, side: c(f"distance_to_{n}_{side}") <= NEAR
    return {
        **{f"new_{n}_{side}": at(n, side) for n in (20, 50) for side in ("high", "low")},
        "breakout_confirmation": (at(20, "high") | at(50, "high")) & ((c("price_change_5") > 0) | (c("ema_alignment") == 1)),
    }


#: Names of the signals of each group.
SIGNALS = {
    "trend": ["ema_bullish_alignment", "ema_bearish_alignment", "price_above_ema50", "price_above_ema200", "golden_cross", "death_cross"],
    "momentum": ["rsi_overbought", "rsi_oversold", "rsi_recovering", "macd_bullish_cross", "macd_bearish_cross", "macd_positive"],
    "volatility": ["high_volatility", "low_volatility", "bollinger_breakout_up", "bollinger_breakout_down"],
    "breakout": ["new_20_high", "new_20_low", "new_50_high", "new_50_low", "breakout_confirmation"],
}
SIGNAL_GROUPS: dict[str, Callable[[], dict[str, Column]]] = {"trend": trend_signals, "momentum": momentum_signals, "volatility": volatility_signals, "breakout": breakout_signals}
