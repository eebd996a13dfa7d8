"""Point-in-time lookups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof(clock: DataFrame, facts: DataFrame, values: Sequence[str], *, symbol: str = "symbol", ts: str = "ts", seq: str | None = None) -> DataFrame:
    """Each row of `clock` with the values of the last fact of its symbol at or before its time (its row even if a value in it is null).

    One shuffle and one sort of both sides together, n log n; no row meets another. Before the first fact the values are null.
    """
    own = [c for c in clock.columns if c not in (symbol, ts)]
    fact = F.struct(*values)
    left = clock.select(symbol, ts, F.lit(1).alias("__clock"), F.lit(None).cast("long").alias("__seq"), F.struct(*own).alias("__own") if own else F.lit(None).cast("struct<x:int>").alias("__own"))
    own_type = left.schema["__own"].dataType
    left = left.withColumn("__fact", F.lit(None).cast(facts.select(fact.alias("f")).schema["f"].dataType))
    right = facts.select(symbol, ts, F.lit(0).alias("__clock"), (F.col(seq).cast("long") if seq else F.lit(None).cast("long")).alias("__seq"), F.lit(None).cast(own_type).alias("__own"), fact.alias("__fact"))
    w = Window.partitionBy(symbol).orderBy(ts, "__clock", "__seq").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = left.unionByName(right).withColumn("__last", F.last("__fact", ignorenulls=True).over(w)).where("__clock = 1")
    return seen.select(symbol, ts, *[F.col(f"__own.{c}").alias(c) for c in own], *[F.col(f"__last.{c}").alias(c) for c in values])


def replay_clock(bounds: DataFrame, step: int, *, start: str = "start_us", end: str = "end_us") -> DataFrame:
    """Ticks from start to end, both included where the step meets it."""
    return bounds.select(F.explode(F.sequence(start, end, F.lit(step))).alias("ts"))


def time_bounds(df: DataFrame, ts: str = "ts") -> DataFrame:
    return df.agg(F.min(ts).alias("start_us"), F.max(ts).alias("end_us"))


def replay_grid(df: DataFrame, step: int, *, symbol: str = "symbol", ts: str = "ts") -> DataFrame:
    """Every tick for every symbol: each symbol makes its own ticks from the common bounds, so no side is joined by a product of rows."""
    low, high = df.agg(F.min(ts), F.max(ts)).first()
    symbols = df.select(symbol).distinct()
    if low is None:
        return symbols.select(symbol, F.lit(None).cast("long").alias(ts)).limit(0)
    return symbols.select(symbol, F.explode(F.sequence(F.lit(low), F.lit(high), F.lit(step))).alias(ts))
