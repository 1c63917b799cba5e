"""Candles from a stream of 1-minute candles: tumbling windows with the reprocess window as the allowed lateness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.config import Timeframe
from tidemark.operators.candles import COLUMNS
from tidemark.operators.incremental import Table


def candle_stream(minutes: DataFrame, timeframe: Timeframe) -> DataFrame:
    """Complete candles so far of a streaming DataFrame; a late minute within the lateness completes or corrects its bucket."""
    late = minutes.withWatermark("open_time", f"{timeframe.reprocess_days} days")
    out = late.groupBy("exchange", "symbol", F.window("open_time", f"{timeframe.minutes} minutes").alias("w")).agg(
        F.min_by("open_price", "close_time").alias("open_price"),
        F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"),
        F.max_by("close_price", "close_time").alias("close_price"),
        F.max("close_time").alias("close_time"),
        *[F.sum(x).alias(x) for x in ("volume", "quote_asset_volume", "number_of_trades", "taker_buy_base_volume", "taker_buy_quote_volume")],
        F.max("ingested_at").alias("ingested_at"),
        F.count(F.lit(1)).alias("parts"),
    )
    return out.where(F.col("parts") == timeframe.minutes).withColumn("open_time", F.col("w.start")).select(*COLUMNS)


def upsert_stream(candles: DataFrame, target: Table, checkpoint: str, **trigger) -> StreamingQuery:
    """Upserts each batch's new and changed candles into the table; by default it takes what there is and ends."""
    return candles.writeStream.outputMode("update").foreachBatch(lambda df, _: target.upsert(df)).option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
