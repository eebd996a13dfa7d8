"""Small column functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def clip(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.least(x, F.lit(high)), F.lit(low))


def shift_1(value: str, symbol: str = "symbol", *order: str) -> Column:
    """The value of a symbol's row before; null for its first."""
    from tidemill.operators.bars import per_symbol

    return F.lag(value, 1).over(per_symbol(symbol, *(order or ("ts",))))


def padded_symbol(symbol: Column) -> Column:
    """Six digits."""
    return F.lpad(symbol.cast("string"), 6, "0")


def sum_before(df: DataFrame, order: str, value: str, name: str, *, parts: int = 256) -> DataFrame:
    """Adds the sum of `value` over the rows whose number `order` is smaller; rows of equal `order` share it. No task gets all rows.

    Rows are split at approximate quantiles; a part's own running sum is added to those of the parts before, of which there are at most `parts`.
    """
    edges = sorted(set(df.where(F.col(order).isNotNull()).approxQuantile(order, [k / parts for k in range(1, parts)], 0.25 / parts))) if parts > 1 else []
    part = F.when(F.col(order).isNull(), F.lit(-1)).otherwise(F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e < F.col(order))) if edges else F.lit(0))
    rows = df.withColumn("__part", part)
    totals = rows.groupBy("__part").agg(F.sum(value).alias("__sum"))
    done = totals.select("__part", F.coalesce(F.sum("__sum").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__done"))
    own = F.sum(value).over(Window.partitionBy("__part").orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)) - F.sum(value).over(Window.partitionBy("__part", order))
    return rows.withColumn(name, own).join(F.broadcast(done), "__part").withColumn(name, F.col(name) + F.col("__done")).drop("__part", "__done")
