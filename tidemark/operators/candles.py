"""Candles of longer timeframes, their attributes, and the latest snapshot."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import attributes, bucket
from tidemark.sources.ticks import bars, event_ticks, item_ticks

COLUMNS = ["exchange", "symbol", "open_time", "close_time", "open_price", "high_price", "low_price", "close_price", "volume", "quote_asset_volume", "number_of_trades", "taker_buy_base_volume", "taker_buy_quote_volume", "ingested_at"]


def aggregate(base: DataFrame, minutes: int, base_minutes: int = 1, complete: bool = True) -> DataFrame:
    """Candles of `minutes` from shorter ones; with complete, only buckets that have all of them.

    Open and close follow close_time. The gate counts in the same aggregation, so there is one shuffle and no join.
    """
    out = base.groupBy("exchange", "symbol", bucket(F.col("open_time"), minutes).alias("bucket")).agg(
        F.min_by("open_price", "close_time").alias("open_price"),
        F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"),
        F.max_by("close_price", "close_time").alias("close_price"),
        F.max("close_time").alias("close_time"),
        *[F.sum(x).alias(x) for x in ("volume", "quote_asset_volume", "number_of_trades", "taker_buy_base_volume", "taker_buy_quote_volume")],
        F.max("ingested_at").alias("ingested_at"),
        F.count(F.lit(1)).alias("parts"),
    )
    if complete:
        out = out.where(F.col("parts") == minutes // base_minutes)
    return out.withColumnRenamed("bucket", "open_time").select(*COLUMNS)


def with_attributes(candles: DataFrame) -> DataFrame:
    return candles.withColumns(attributes())


def all_timeframes(minutes: DataFrame, timeframes: dict[str, int], base_minutes: int = 1) -> DataFrame:
    """Complete candles of several timeframes in one table with its timeframe.

    Each is made from the longest shorter one that fits into it: a bucket is complete exactly if the complete buckets in it are all there. So
    the minutes are read and shuffled for the shortest only.
    """
    made = {base_minutes: minutes}
    for m in sorted(set(timeframes.values())):
        if m not in made:
            part = max(k for k in made if m % k == 0)
            made[m] = aggregate(made[part], m, part)
    return reduce(DataFrame.unionByName, [made[m].select(*COLUMNS).withColumn("timeframe", F.lit(name)) for name, m in timeframes.items()])


def candles(spark: SparkSession, sf_dir: str, timeframes: tuple[str, ...] = ("1h", "1d", "7d")) -> DataFrame:
    """All candles of the test tables with attributes: hours and complete days of events, days and complete weeks of line items.

    The timeframe is a literal in each branch, so a filter on it prunes whole branches.
    """
    hours, days = bars(event_ticks(spark, sf_dir), 60).select(*COLUMNS), bars(item_ticks(spark, sf_dir), 1440).select(*COLUMNS)
    parts = {"1h": [hours], "1d": [aggregate(hours, 1440, 60), days], "7d": [aggregate(days, 7 * 1440, 1440)]}
    found = [p.withColumn("timeframe", F.lit(t)) for t in timeframes for p in parts[t]]
    return with_attributes(reduce(DataFrame.unionByName, found))


def latest_snapshot(prices: DataFrame, tickers: DataFrame) -> DataFrame:
    """Latest price and latest ticker of each (exchange, symbol), joined; both have ingested_at. The rest of the ticker's columns follow."""
    newest = lambda df: df.groupBy("exchange", "symbol").agg(F.max_by(F.struct(*df.columns), "ingested_at").alias("x")).select("x.*")
    p = newest(prices).select("exchange", "symbol", "price", F.col("ingested_at").alias("price_at"))
    t = newest(tickers).withColumnRenamed("ingested_at", "ticker_at")
    return p.join(t, ["exchange", "symbol"]).withColumn("snapshot_time", F.greatest("price_at", "ticker_at"))
