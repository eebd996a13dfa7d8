"""Bars over streams: the batch bars with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stream_bars(ticks: DataFrame, *, width: str = "1 minute", late: str = "10 minutes", time: str = "time", symbol: str = "symbol", price: str = "price", volume: str = "volume", seq: str = "seq") -> DataFrame:
    """OHLCV of a stream (or a batch) by event time. Rows later than `late` are dropped, and a bar is final when the watermark has passed it."""
    at = F.when(F.col(price).isNotNull(), F.struct(time, seq))
    rows = ticks.withWatermark(time, late) if ticks.isStreaming else ticks
    bars = rows.groupBy(symbol, F.window(time, width).alias("w")).agg(
        F.min_by(price, at).alias("open"),
        F.max(price).alias("high"),
        F.min(price).alias("low"),
        F.max_by(price, at).alias("close"),
        F.sum(volume).alias("volume"),
        F.sum(F.col(price) * F.col(volume)).alias("notional"),
        F.count(price).alias("trade_count"),
    )
    return bars.select(symbol, F.col("w.start").alias("bar"), "open", "high", "low", "close", "volume", "notional", "trade_count")
