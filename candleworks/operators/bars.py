"""Grouped daily bars (OHLCV) from tick rows, and the vendor landing projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candleworks.functions import times


def daily_bars(ticks: DataFrame, symbol: Column, ts: str, price: str, size: Column,
               tiebreak: str | None = None) -> DataFrame:
    """One bar per (symbol, trade day): open/close by time, high/low, volume,
    trade count and volume-weighted price.

    Every aggregate here has a partial (map-side) form, so a hot symbol-day costs
    one partial row per input split before the shuffle, never a giant group.
    ``tiebreak`` orders ticks that share a timestamp. The volume-weighted price of
    a bar without volume is the IEEE quotient (NaN for 0/0), never an error.
    """
    order = F.struct(F.col(ts), F.col(tiebreak)) if tiebreak else F.col(ts)
    px = F.col(price)
    traded, volume = F.sum(F.col("_px") * F.col("_sz")), F.sum("_sz")
    return (ticks
            .select(symbol.alias("stock_symbol"), F.to_date(F.col(ts)).alias("trade_date"),
                    px.alias("_px"), size.alias("_sz"), order.alias("_ord"))
            .groupBy("stock_symbol", "trade_date")
            .agg(F.min_by("_px", "_ord").alias("o"),
                 F.max("_px").alias("h"),
                 F.min("_px").alias("l"),
                 F.max_by("_px", "_ord").alias("c"),
                 volume.alias("v"),
                 F.count(F.lit(1)).alias("trans"),
                 F.when(volume == 0, traded * F.lit(float("inf"))).otherwise(traded / volume).alias("vwap"))
            .withColumn("t", times.epoch_millis_text_at("trade_date")))


def to_landing_rows(bars: DataFrame) -> DataFrame:
    """Vendor bar -> landing row with the short attribute names (ticker,o,c,h,l,v,vwap,time,trans)."""
    return bars.select(
        F.col("stock_symbol").alias("ticker"), "o", "c", "h", "l",
        F.col("v").cast("double").alias("v"), "vwap",
        F.col("t").alias("time"), F.col("trans").cast("long").alias("trans"),
        F.col("trade_date"))
