"""Fail-fast validation of raw prices, tickers and klines, and invariants of the finished tables.

A rule set is one projection: every row gets the code of the first rule that it breaks. Values may still be text.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import KEY, SERIES


class DataQualityError(ValueError):
    """The first broken rule of a batch."""


def number(x: str) -> Column:
    """A finite decimal, or null for what isn't one (missing, text, NaN, infinite, a boolean)."""
    value = F.col(x).try_cast("string").try_cast("double")
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def integer(x: str) -> Column:
    value = number(x)
    return F.when(value == F.floor(value), value)


def moment(x: str) -> Column:
    """A timestamp from a timestamp, epoch milliseconds, or ISO 8601 text; naive is UTC."""
    text = F.col(x).cast("string")
    return F.coalesce(F.timestamp_millis(text.try_cast("bigint")), F.try_to_timestamp(text))


def broken(rules: dict[str, Column]) -> Column:
    """Code of the first rule that doesn't hold (null counts as not holding), or null."""
    return F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(code)) for code, ok in rules.items()])


def symbol_rule() -> dict[str, Column]:
    return {"symbol_blank": F.trim("symbol") != ""}


def price_rules() -> dict[str, Column]:
    return {**symbol_rule(), "price_not_positive": number("price") > 0}


def ticker_rules() -> dict[str, Column]:
    at_least_0 = ("weighted_avg_price", "prev_close_price", "last_price", "bid_price", "ask_price", "volume", "quote_volume")
    return {**symbol_rule(), "high_below_low": number("high_price") >= number("low_price"), **{f"{x}_negative": number(x) >= 0 for x in at_least_0}, "count_invalid": integer("count") >= 0, "times_out_of_order": moment("open_time") < moment("close_time")}


def kline_rules() -> dict[str, Column]:
    at_least_0 = ("volume", "quote_asset_volume", "taker_buy_base_volume", "taker_buy_quote_volume")
    return {
        **symbol_rule(),
        **{f"{x}_price_not_positive": number(f"{x}_price") > 0 for x in ("open", "high", "low", "close")},
        "high_below_low": number("high_price") >= number("low_price"),
        **{f"{x}_negative": number(x) >= 0 for x in at_least_0},
        "number_of_trades_invalid": integer("number_of_trades") >= 0,
        "times_out_of_order": moment("open_time") < moment("close_time"),
    }


RULES = {"price": price_rules, "ticker": ticker_rules, "kline": kline_rules}


def violations(df: DataFrame, kind: str) -> DataFrame:
    """Rows that break a rule, with the first one's code."""
    return df.withColumn("violation", broken(RULES[kind]())).where("violation is not null")


def validate(df: DataFrame, kind: str) -> DataFrame:
    """df, if every row holds; else DataQualityError with the first found."""
    bad = violations(df, kind).limit(1).collect()
    if bad:
        raise DataQualityError(f"{kind}: {bad[0]['violation']} in {bad[0].asDict()}")
    return df


def invariants(indicated: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """(key, broken): rows where the histogram isn't macd less signal, the bands are out of order, or a band is missing from row 20 on."""
    rn = F.row_number().over(Window.partitionBy(*SERIES).orderBy("open_time"))
    rows = indicated.select(*KEY, "macd", "macd_signal", "macd_histogram", "bb_middle", "bb_upper", "bb_lower", rn.alias("rn"))
    codes = F.filter(
        F.array(
            F.when(F.abs(F.col("macd_histogram") - (F.col("macd") - F.col("macd_signal"))) > tolerance, "histogram"),
            F.when(~((F.col("bb_upper") >= F.col("bb_middle")) & (F.col("bb_middle") >= F.col("bb_lower"))), "band_order"),
            F.when((F.col("rn") >= 20) & (F.col("bb_upper").isNull() | F.col("bb_middle").isNull() | F.col("bb_lower").isNull()), "band_missing"),
        ),
        lambda x: x.isNotNull(),
    )
    return rows.select(*KEY, F.explode(codes).alias("broken"))


def flat_signals(indicated: DataFrame, n: int = 20) -> DataFrame:
    """Timeframes with any series whose last n macd_signal values are all equal: (timeframe, series, flat)."""
    newest = F.row_number().over(Window.partitionBy(*SERIES).orderBy(F.desc("open_time")))
    per = indicated.withColumn("rn", newest).where(F.col("rn") <= n).groupBy(*SERIES).agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("macd_signal").alias("values"))
    full = F.col("rows") == n
    out = per.groupBy("timeframe").agg(F.count_if(full).alias("series"), F.count_if(full & (F.col("values") <= 1)).alias("flat"))
    return out.where("flat > 0")


def horner(x: str, factor: float, rows: int = 512) -> Column:
    """The adjusted exponential average by its recursion over the last `rows` rows; older ones must not count (the factor to that power is below 1e-16)."""
    last = Window.partitionBy(*SERIES).orderBy("open_time").rowsBetween(1 - rows, 0)
    both = F.aggregate(F.collect_list(x).over(last), F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("w")), lambda a, v: F.struct((a["n"] * factor + v).alias("n"), (a["w"] * factor + 1).alias("w")))
    return both["n"] / both["w"]


def reference_indicators(candles: DataFrame) -> DataFrame:
    """MACD and Bollinger columns by other formulas than the engine's, to hold its tables against."""
    out = candles.withColumn("macd", horner("close_price", 1 - 2 / 13) - horner("close_price", 1 - 2 / 27))
    out = out.withColumn("macd_signal", horner("macd", 1 - 2 / 10)).withColumn("macd_histogram", F.col("macd") - F.col("macd_signal"))
    last = F.collect_list("close_price").over(Window.partitionBy(*SERIES).orderBy("open_time").rowsBetween(-19, 0))
    n, total = F.size("__x"), F.aggregate("__x", F.lit(0.0), lambda a, v: a + v)
    out = out.withColumn("__x", last).withColumn("bb_middle", total / n)
    square = F.aggregate("__x", F.lit(0.0), lambda a, v: a + (v - F.col("bb_middle")) * (v - F.col("bb_middle")))
    out = out.withColumn("__d", F.sqrt(square / F.nullif(n - 1, F.lit(0))))
    return out.withColumn("bb_upper", F.col("bb_middle") + 2 * F.col("__d")).withColumn("bb_lower", F.col("bb_middle") - 2 * F.col("__d")).select(*KEY, *REFERENCE)


REFERENCE = ["macd", "macd_signal", "macd_histogram", "bb_upper", "bb_middle", "bb_lower"]


def uncovered(source: DataFrame, target: DataFrame, key: list[str] = KEY) -> DataFrame:
    """Keys of source that the target lacks."""
    return source.select(*key).distinct().join(target.select(*key), key, "left_anti")


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, nulls) of those that must have none but do; one pass."""
    counts = df.agg(*[F.count_if(F.col(x).isNull()).alias(x) for x in columns])
    return counts.select(F.explode(F.array(*[F.struct(F.lit(x).alias("column"), F.col(x).alias("nulls")) for x in columns])).alias("x")).select("x.*").where("nulls > 0")


def unaccepted(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """(value, rows) of values outside the accepted ones."""
    return df.where(~F.coalesce(F.col(column).isin(values), F.lit(False))).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("rows"))


def differences(a: DataFrame, b: DataFrame, columns: list[str], key: list[str] = KEY, tolerance: float = 1e-8) -> DataFrame:
    """Keys in both where a column differs by more than the tolerance, or is null in one only."""
    x, y = a.select(*key, *[F.col(c).alias(f"{c}__a") for c in columns]), b.select(*key, *[F.col(c).alias(f"{c}__b") for c in columns])
    off = [(F.abs(F.col(f"{c}__a") - F.col(f"{c}__b")) > tolerance) | ~F.col(f"{c}__a").isNull().eqNullSafe(F.col(f"{c}__b").isNull()) for c in columns]
    return x.join(y, key).where(reduce(lambda p, q: p | q, [F.coalesce(o, F.lit(False)) for o in off]))
