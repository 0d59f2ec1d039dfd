"""Stateful streams: hourly bars and de-duplication under a watermark.

State is bounded by the watermark: rows later than it are dropped, and windows behind it are
written once and forgotten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.functions.scalars import time_key


def hourly_bars(trades: DataFrame, delay: str = "2 hours") -> DataFrame:
    """Hourly bars per symbol; open and close by trade time, ties by trade id."""
    moment = time_key("trade_time", "trade_id")
    value = F.col("price") * F.col("quantity")
    return (
        trades.withWatermark("trade_time", delay)
        .groupBy(F.window("trade_time", "1 hour").alias("w"), "symbol")
        .agg(
            F.min_by("price", moment).cast("double").alias("open_price"),
            F.max("price").cast("double").alias("high_price"),
            F.min("price").cast("double").alias("low_price"),
            F.max_by("price", moment).cast("double").alias("close_price"),
            F.sum(value).cast("double").alias("volume_usd"),
            F.count("*").alias("trades_count"),
            F.try_divide(F.sum(value).cast("double"), F.sum("quantity").cast("double")).alias("vwap"),
        )
        .select(
            "symbol", F.col("w.start").alias("price_hour"), "open_price", "high_price", "low_price", "close_price",
            "volume_usd", "trades_count", "vwap",
        )
    )


def unique_trades(trades: DataFrame, delay: str = "2 hours") -> DataFrame:
    """One row per trade id, as long as copies arrive within the delay of each other."""
    return trades.withWatermark("trade_time", delay).dropDuplicatesWithinWatermark(["trade_id"])
