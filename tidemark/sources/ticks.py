"""Ticks and bars from tables of events and line items, and synthetic minutes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import bucket

EXCHANGE = "BINANCE"


def scan(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as ticks: the type is the symbol, the value the price, one unit each; even ids are taker buys."""
    e = scan(spark, sf_dir, "events")
    return e.select(F.lit(EXCHANGE).alias("exchange"), F.col("event_type").alias("symbol"), F.col("ts").cast("timestamp").alias("ts"), F.col("value").alias("price"), F.lit(1.0).alias("quantity"), (F.col("event_id") % 2 == 0).alias("taker"), F.col("ts").cast("timestamp").alias("tick"))


def item_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as ticks by return flag; ticks of a day are in order of one number from their keys, so that first and last need no sort."""
    t = scan(spark, sf_dir, "lineitem")
    order = F.shiftleft(F.col("l_orderkey").cast("long") * 8 + F.col("l_linenumber"), 20) + F.pmod(F.col("l_partkey").cast("long") * 7919 + F.col("l_suppkey"), F.lit(1 << 20))
    return t.select(F.lit(EXCHANGE).alias("exchange"), F.col("l_returnflag").alias("symbol"), F.col("l_shipdate").cast("timestamp").alias("ts"), F.col("l_extendedprice").alias("price"), F.col("l_quantity").cast("double").alias("quantity"), (F.col("l_linenumber") % 2 == 0).alias("taker"), order.alias("tick"))


def bars(ticks: DataFrame, minutes: int) -> DataFrame:
    """Base candles of ticks. One shuffle by (exchange, symbol, bucket), added up before it."""
    taken = lambda x: F.sum(F.when(F.col("taker"), x).otherwise(0.0))
    worth: Column = F.col("price") * F.col("quantity")
    out = ticks.groupBy("exchange", "symbol", bucket(F.col("ts"), minutes).alias("open_time")).agg(
        F.min_by("price", "tick").alias("open_price"),
        F.max("price").alias("high_price"),
        F.min("price").alias("low_price"),
        F.max_by("price", "tick").alias("close_price"),
        F.sum("quantity").alias("volume"),
        F.sum(worth).alias("quote_asset_volume"),
        F.count(F.lit(1)).alias("number_of_trades"),
        taken(F.col("quantity")).alias("taker_buy_base_volume"),
        taken(worth).alias("taker_buy_quote_volume"),
        F.max("ts").alias("ingested_at"),
    )
    return out.withColumn("close_time", F.col("open_time") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes), F.lit(0)) - F.expr("INTERVAL '0.001' SECOND"))


def synthetic_minutes(spark: SparkSession, n: int, symbols: tuple[str, ...] = ("BTCUSDT",), start: str = "2026-07-01 00:00:00") -> DataFrame:
    """n consecutive 1-minute candles of each symbol, by the formula of the end-to-end fixture."""
    i = F.col("i")
    part = lambda base, m: (F.lit(base) + i % m).cast("double")
    names = F.explode(F.array(*map(F.lit, symbols)))
    rows = spark.range(n).withColumnRenamed("id", "i").select("i", names.alias("symbol"))
    at = F.timestamp_seconds(F.unix_timestamp(F.lit(start).cast("timestamp")) + i * 60)
    return rows.select(
        F.lit(EXCHANGE).alias("exchange"), "symbol", at.alias("open_time"), part(60000, 100).alias("open_price"), part(60010, 100).alias("high_price"), part(59990, 50).alias("low_price"), part(60005, 80).alias("close_price"),
        part(100, 50).alias("volume"), (6_000_000 + i % 1000 * 1000).cast("double").alias("quote_asset_volume"), (50 + i % 30).alias("number_of_trades"), part(40, 20).alias("taker_buy_base_volume"), (2_400_000 + i % 50 * 500).cast("double").alias("taker_buy_quote_volume"),
        at.alias("ingested_at"), (at + F.expr("INTERVAL 1 MINUTE")).alias("close_time"),
    )
