"""Bar features. Rolling statistics see the rows before the current one only, and a full window of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tidemill.operators.bars import per_symbol
from tidemill.schemas import require

FEATURE_PREFIXES = ("l0_", "l1_", "l2_")


def finite(c: Column) -> Column:
    """NaN and infinities to null."""
    return F.when(~F.isnan(c) & (F.abs(c) != float("inf")), c)


def ratio(a: Column, b: Column, otherwise: float = 0.0) -> Column:
    """a / b where b is above 0."""
    return F.when(b > 0, a.cast("double") / b.cast("double")).otherwise(otherwise)


def l0(df: DataFrame) -> DataFrame:
    """Features of a bar by itself; the two of buying and selling only if both volumes are there. Row count stays, reruns replace."""
    require(df, ["open", "high", "low", "close", "volume", "trade_count"], "l0")
    v, n = F.col("volume"), F.col("trade_count")
    new = {"l0_amount": F.col("close") * v, "l0_avg_trade_size": ratio(v, n)}
    if {"buy_volume", "sell_volume"} <= set(df.columns):
        buy, sell = F.col("buy_volume"), F.col("sell_volume")
        new |= {"l0_buy_ratio": ratio(buy, buy + sell), "l0_imbalance": ratio(buy - sell, buy + sell)}
    new |= {"l0_range": F.col("high") - F.col("low"), "l0_abs_move": F.abs(F.col("close") - F.col("open")), "l0_log_volume": F.log1p(v.cast("double")), "l0_log_trade_count": F.log1p(n.cast("double"))}
    return df.withColumns(new)


def history(window: int, symbol: str, ts: str, by: Sequence[str]) -> WindowSpec:
    """The `window` rows before the current one."""
    if window < 1:
        raise ValueError("window: 1 at least")
    return per_symbol(symbol, ts, by=tuple(by)).rowsBetween(-window, -1)


def full(value: Column, x: Column, frame: WindowSpec, window: int, otherwise: float | None = 0.0) -> Column:
    """`value` where the frame holds `window` finite values of x."""
    return F.coalesce(F.when(F.count(x).over(frame) == window, value), F.lit(otherwise))


def l1_statistics(df: DataFrame, window: int = 20, *, symbol: str = "symbol", ts: str = "ts", by: Sequence[str] = ()) -> DataFrame:
    """Rolling mean, sum, deviation and ratios of those l0 columns that are there, and the log return. One sort serves them all.

    A window of one row has no deviation (0). A log return after a close of 0 is infinite, as it is downstream.
    """
    frame, w = history(window, symbol, ts, by), per_symbol(symbol, ts, by=tuple(by))
    have, new = set(df.columns), {}
    x = lambda c: finite(F.col(c).cast("double"))

    def mean(c: str, otherwise: float | None = 0.0) -> Column:
        return full(F.avg(x(c)).over(frame), x(c), frame, window, otherwise)

    if "l0_volume" in have:
        new[f"l1_mean_w{window}_volume"] = mean("l0_volume")
    if "l0_trade_count" in have:
        new[f"l1_sum_w{window}_trade_count"] = full(F.sum(x("l0_trade_count")).over(frame), x("l0_trade_count"), frame, window)
    if "l0_abs_move" in have:
        new[f"l1_std_w{window}_abs_move"] = full(F.stddev_samp(x("l0_abs_move")).over(frame), x("l0_abs_move"), frame, window)
    if "close" in have:
        close, before = F.col("close").cast("double"), F.lag(F.col("close").cast("double")).over(w)
        step = F.try_divide(close, before)
        new[f"l1_ret_w{window}_1"] = F.when((before == 0) & (close > 0), float("inf")).when(~F.isnan(step) & (step > 0), F.log(step)).otherwise(0.0)
    for c, name in (("l0_volume", "volume"), ("l0_range", "range")):
        if c in have:
            new[f"l1_ratio_w{window}_{name}"] = F.coalesce(finite(F.try_divide(F.col(c).cast("double"), mean(c, None))), F.lit(0.0))
    return df.withColumns(new)


def z_columns(df: DataFrame, *, l0: bool = True, l1: bool = True) -> list[str]:
    """Numeric columns to standardise; the flags leave out prefixed ones only, so times and prices are among them."""
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType) and not f.name.startswith("l1_z_") and (l0 or not f.name.startswith("l0_")) and (l1 or not f.name.startswith("l1_"))]


def l1_zscores(df: DataFrame, window: int = 20, *, symbol: str = "symbol", ts: str = "ts", by: Sequence[str] = (), l0: bool = True, l1: bool = True, columns: Sequence[str] | None = None) -> DataFrame:
    """(x - mean) / deviation over the rows before, for each numeric column; 0 without a full window of finite values, without spread and for what isn't a number.

    An infinite x after such a window has an infinite score, as it has downstream and in SQL.
    """
    frame = history(window, symbol, ts, by)
    new = {}
    for c in columns if columns is not None else z_columns(df, l0=l0, l1=l1):
        value = F.col(c).cast("double")
        x = finite(value)
        std = F.stddev_samp(x).over(frame)
        # rounding gives equal values a deviation of their own, so spread is told by the values: some must differ by more than rounding
        high, low = F.max(x).over(frame), F.min(x).over(frame)
        z = F.when((F.count(x).over(frame) == window) & (high - low > 1e-12 * F.greatest(F.abs(high), F.abs(low))) & (std > 0), (value - F.avg(x).over(frame)) / std)
        new[f"l1_z_w{window}_{c}"] = F.coalesce(F.when(~F.isnan(z), z), F.lit(0.0))
    return df.withColumns(new)


def feature_chain(bars: DataFrame, window: int = 20, *, symbol: str = "symbol", ts: str = "ts", by: Sequence[str] = ()) -> DataFrame:
    """l0, statistics and z-scores of bars, 40 columns for 12; everything shares one exchange and one sort on (symbol, ts)."""
    return l1_zscores(l1_statistics(l0(bars), window, symbol=symbol, ts=ts, by=by), window, symbol=symbol, ts=ts, by=by)


def merge_features(base: DataFrame, made: DataFrame, keys: Sequence[str] = ("symbol", "ts")) -> DataFrame:
    """`base` with the feature columns of `made`, row by row of equal keys; other columns of `base` are never replaced.

    Where `made` comes from `base` by withColumns, selecting from `made` does the same without a join.
    """
    new = [c for c in made.columns if c.startswith(FEATURE_PREFIXES)]
    return base.drop(*new).join(made.select(*keys, *new), list(keys), "left")
