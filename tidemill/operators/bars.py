"""Trade enrichment and bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemill.functions.timeaxis import MINUTE, floor_to, hh_mm, hhmm, local, yyyymmdd
from tidemill.schemas import require


def order_of(*columns: str | None) -> list[str]:
    return [c for c in columns if c]


def per_symbol(symbol: str, *order: str | None, by: tuple[str, ...] = ()) -> WindowSpec:
    return Window.partitionBy(symbol, *by).orderBy(*order_of(*order))


def enrich(df: DataFrame, *, symbol: str = "symbol", ts: str = "ts", seq: str | None = "seq", price: str = "price", volume: str = "volume", by: tuple[str, ...] = (), trades_only: bool = False, notional: str = "notional", side: str = "trade_side") -> DataFrame:
    """Adds price * volume and the tick rule's side: +1 if the price rose against the row before, -1 if it fell, else 0 (first, equal, null).

    All rows take part, whatever their event, unless `trades_only`. Existing columns of these names are replaced.
    """
    require(df, [symbol, ts, price, volume], "enrich")
    df = df.where("event = 'TRADE'") if trades_only else df
    change = F.col(price) - F.lag(price).over(per_symbol(symbol, ts, seq, by=by))
    return df.withColumns({notional: F.col(price).cast("double") * F.col(volume).cast("double"), side: F.coalesce(F.signum(change), F.lit(0.0)).cast("byte")})


def check_sorted(df: DataFrame, *, symbol: str = "symbol", ts: str = "ts", seq: str = "seq") -> DataFrame:
    """Fails when it runs if time goes back within a symbol in the order of `seq`."""
    before = F.lag(ts).over(per_symbol(symbol, seq))
    return df.withColumn(ts, F.when(F.col(ts) < before, F.raise_error(F.lit("input isn't sorted by time")).cast("long")).otherwise(F.col(ts)))


def time_columns(ts: Column) -> dict[str, Column]:
    return {"trade_date": yyyymmdd(ts), "minute": hhmm(ts), "minute_str": hh_mm(ts)}


def ohlcv(df: DataFrame, *, step: int = MINUTE, exchange: str | None = "CN", symbol: str = "symbol", ts: str = "ts", seq: str | None = "seq", price: str = "price", volume: str = "volume", notional: str = "notional") -> DataFrame:
    """Bars of `step` microseconds on the local clock (exchange None: on ts as it is). Open and close are the first and last price that isn't null,
    by (ts, seq); trade_count counts such prices. Gaps are not filled.

    The order is part of the aggregate, so partial aggregation works and one shuffle on (symbol, bar) is all.
    """
    require(df, [symbol, ts, price, volume, notional], "ohlcv")
    clock = local(F.col(ts), exchange) if exchange else F.col(ts)
    at = F.when(F.col(price).isNotNull(), F.struct(*order_of(ts, seq)))
    bars = (
        df.withColumn("__bar", floor_to(clock, step))
        .groupBy(symbol, "__bar")
        .agg(
            F.min_by(price, at).alias("open"),
            F.max(price).alias("high"),
            F.min(price).alias("low"),
            F.max_by(price, at).alias("close"),
            F.sum(volume).alias("volume"),
            F.sum(notional).alias("notional"),
            F.count(price).alias("trade_count"),
        )
    )
    times = time_columns(F.col("__bar"))
    return bars.select(F.col("__bar").alias("ts"), *[c.alias(n) for n, c in times.items()], "open", "high", "low", "close", "volume", "notional", "trade_count", symbol)


def order_flow(df: DataFrame, *, step: int = MINUTE, symbol: str = "symbol", ts: str = "ts", event: str = "event", volume: str = "volume", notional: str = "notional", event_count: bool = True, local_clock: str | None = None) -> DataFrame:
    """Volume and notional added and cancelled in each bar (UTC unless `local_clock` names an exchange); event_count counts all events, trades too.

    A row without an event adds nothing, not even a zero.
    """
    require(df, [symbol, ts, event, volume, notional], "order_flow")
    clock = local(F.col(ts), local_clock) if local_clock else F.col(ts)

    def only(kind: str, value: str) -> Column:
        return F.sum(F.when(F.col(event).isNull(), None).when(F.col(event) == kind, F.col(value)).otherwise(0))

    out = (
        df.groupBy(symbol, floor_to(clock, step).alias("bar_us"))
        .agg(only("ADD", volume).alias("add_volume"), only("CANCEL", volume).alias("cancel_volume"), only("ADD", notional).cast("double").alias("add_notional"), only("CANCEL", notional).cast("double").alias("cancel_notional"), F.count(event).alias("event_count"))
        .withColumn("net_volume", F.col("add_volume") - F.col("cancel_volume"))
    )
    columns = [symbol, "bar_us", "add_volume", "cancel_volume", "net_volume", "add_notional", "cancel_notional", *(["event_count"] if event_count else [])]
    return out.select(*columns)


def minute_of(bar_us: str = "bar_us") -> Column:
    """A bar as a timestamp without a time zone."""
    return F.expr(f"timestampadd(MICROSECOND, {bar_us}, timestamp_ntz'1970-01-01 00:00:00')")


__all__ = ["check_sorted", "enrich", "minute_of", "ohlcv", "order_flow", "order_of", "per_symbol", "time_columns"]
