"""Canonical schemas. Timestamps are epoch microseconds as longs; `min.ts` and all that follows from it are on the exchange's local clock."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, I, H, B, D = T.StringType(), T.LongType(), T.IntegerType(), T.ShortType(), T.ByteType(), T.DoubleType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields])


EVENT = _struct(("symbol", S), ("ts", L), ("event", S), ("order_id", L), ("side", S), ("price", D), ("volume", L), ("buy_no", L), ("sell_no", L))
ENRICHED = T.StructType([*EVENT.fields, T.StructField("notional", D), T.StructField("trade_side", B)])
BAR = _struct(("ts", L), ("trade_date", I), ("minute", H), ("minute_str", S), ("open", D), ("high", D), ("low", D), ("close", D), ("volume", L), ("notional", D), ("trade_count", L), ("symbol", S))
SNAPSHOT = _struct(("symbol", S), ("ts", L), ("side", S), ("level", H), ("price", D), ("volume", L))
BOOK_EVENT = _struct(("symbol", S), ("ts", L), ("event", S), ("order_id", L), ("side", S), ("price", D), ("volume", L), ("notional", D))
ORDER_FLOW = _struct(("symbol", S), ("minute", T.TimestampNTZType()), ("add_volume", L), ("cancel_volume", L), ("net_volume", L), ("add_notional", D), ("cancel_notional", D), ("event_count", L))
FILL = _struct(("ts", L), ("symbol", S), ("side", S), ("qty", L), ("price", D))
IC_SERIES = _struct(("update_day", S), ("eval_day", S), ("ic", D))


def require(df, columns, who: str) -> None:
    """ValueError if `df` lacks a column; looks at the schema only."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{who}: missing columns {missing}")
