"""Replay of a strategy: as-of view, scores, targets, fills and equity, as window expressions.

Exact for targets that are not negative and don't depend on the portfolio (long only, so a sale never exceeds what is held). Strategies that look
at the portfolio run through `replay`, the sequential form.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.numeric import sum_before
from tidemill.functions.timeaxis import MINUTE

INITIAL_CASH = 1_000_000.0


def valid_price(p: Column) -> Column:
    """Not null, not NaN, finite and above 0. NaN is larger than all numbers here, so it is tested first."""
    return F.coalesce(~F.isnan(p) & (p > 0) & (p < float("inf")), F.lit(False))


def threshold_target(score: Column, threshold: float = 0.0, qty: int = 1) -> Column:
    """qty above the threshold, else 0."""
    return F.when(score > threshold, qty).otherwise(0).cast("long")


def probability_target(probability: Column, threshold: float = 0.5, qty: int = 1) -> Column:
    """qty from the threshold on, else 0."""
    return F.when(probability >= threshold, qty).otherwise(0).cast("long")


def positions(grid: DataFrame, *, symbol: str = "symbol", ts: str = "ts", price: str = "price", target: str = "target") -> DataFrame:
    """Adds pos (held after t), prev_pos and delta. Orders are placed on whole minutes and only at a valid price; others leave the position."""
    w = Window.partitionBy(symbol).orderBy(ts)
    decided = F.when((F.pmod(ts, F.lit(MINUTE)) == 0) & valid_price(F.col(price)), F.col(target))
    pos = F.coalesce(F.last(decided, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)), F.lit(0))
    out = grid.withColumn("pos", pos)
    return out.withColumn("prev_pos", F.coalesce(F.lag("pos").over(w), F.lit(0))).withColumn("delta", F.col("pos") - F.col("prev_pos"))


def fills(held: DataFrame, *, symbol: str = "symbol", ts: str = "ts", price: str = "price") -> DataFrame:
    """Full quantity at the as-of price."""
    return held.where("delta <> 0").select(ts, symbol, F.when(F.col("delta") > 0, "BUY").otherwise("SELL").alias("side"), F.abs("delta").cast("long").alias("qty"), F.col(price).alias("price"))


def equity_curve(held: DataFrame, *, ts: str = "ts", price: str = "price", cash: float = INITIAL_CASH) -> DataFrame:
    """(ts, cash, equity) before the decision at each tick. Symbols are summed first; only one row a tick meets the running total."""
    ok = valid_price(F.col(price))
    ticks = held.groupBy(ts).agg(F.sum(F.when(F.col("delta") != 0, F.col("delta") * F.col(price)).otherwise(0.0)).alias("spent"), F.sum(F.when(ok & (F.col("prev_pos") != 0), F.col("prev_pos") * F.col(price)).otherwise(0.0)).alias("worth"))
    left = F.lit(cash) - F.col("__before")
    return sum_before(ticks, ts, "spent", "__before").select(ts, left.alias("cash"), (left + F.col("worth")).alias("equity"))


def report(held: DataFrame, *, symbol: str = "symbol", ts: str = "ts", price: str = "price", cash: float = INITIAL_CASH) -> DataFrame:
    """(symbol, qty, final_cash): last positions, and the cash that all fills leave."""
    last = held.groupBy(symbol).agg(F.max_by("pos", ts).alias("qty"), F.sum(F.when(F.col("delta") != 0, F.col("delta") * F.col(price)).otherwise(0.0)).alias("spent"))
    spent = last.agg(F.sum("spent")).first()[0] or 0.0
    return last.select(symbol, "qty", F.lit(cash - spent).alias("final_cash"))


def replay(grid: DataFrame, decide: Callable[[int, dict, dict, float], dict], *, features: list[str], cash: float = INITIAL_CASH) -> DataFrame:
    """The sequential form, for strategies that look at the portfolio: decide(ts, {symbol: features}, {symbol: qty}, cash) -> {symbol: target}.

    The portfolio couples all symbols, so one task holds one run; runs (a column `run`) are dealt out. Returns (run, ts, cash, equity).
    """

    def go(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        money, held, out = cash, {}, []
        for ts, tick in rows.sort_values(["ts", "symbol"]).groupby("ts"):
            price = {s: p for s, p in zip(tick.symbol, tick.price, strict=True) if p == p and p is not None and 0 < p < float("inf")}
            out.append((key[0], int(ts), money, money + sum(q * price[s] for s, q in held.items() if q and s in price)))
            if ts % MINUTE:
                continue
            seen = {r["symbol"]: {f: r[f] for f in features} for r in tick.to_dict("records")}
            for s, target in decide(int(ts), seen, dict(held), money).items():
                change = target - held.get(s, 0)
                if not change or s not in price:
                    continue
                change = max(change, -held.get(s, 0))
                held[s] = held.get(s, 0) + change
                money -= change * price[s]
        return pd.DataFrame(out, columns=["run", "ts", "cash", "equity"])

    return grid.groupBy("run").applyInPandas(go, "run string, ts long, cash double, equity double")


class Strategies:
    """Strategies by name."""

    known = {"threshold": threshold_target, "probability": probability_target}

    @classmethod
    def build(cls, config: dict) -> Callable[[Column], Column]:
        """KeyError without a type, ValueError for an unknown one."""
        kind = config["type"]
        if kind not in cls.known:
            raise ValueError(f"unknown strategy {kind!r}")
        options = {k: v for k, v in config.items() if k in ("threshold", "qty")}
        return lambda score: cls.known[kind](score, **options)
