"""Seeded samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def exact_sample(df: DataFrame, k: int, *, seed: int = 42, key: list[str] | None = None) -> DataFrame:
    """Exactly k rows (all, if fewer), each set of k as likely; with `key` the same rows on every run, however they are partitioned."""
    order = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(c).cast("string") for c in key])) if key else F.rand(seed)
    return df.withColumn("__r", order).orderBy("__r", *(key or [])).limit(k).drop("__r")


def symbol_sample(features: DataFrame, labels: DataFrame, k: int = 100, *, seed: int = 42, symbol: str = "symbol") -> DataFrame:
    """k of the symbols that both have, chosen by a seeded hash."""
    both = features.select(symbol).intersect(labels.select(symbol))
    return both.orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), symbol)), symbol).limit(k)


def rows_of_sample(df: DataFrame, pool: DataFrame, *, symbol: str = "symbol") -> DataFrame:
    return df.join(pool.select(symbol), symbol, "left_semi")


def symbol_pools(features: DataFrame, labels: DataFrame, k: int = 100, *, seed: int = 42, file: str = "file", symbol: str = "symbol") -> DataFrame:
    """(file, symbol): for each file k of the symbols that its features and its labels have, by a seeded hash; ValueError if a file has fewer."""
    both = features.select(file, symbol).intersect(labels.select(file, symbol))
    if few := both.groupBy(file).count().where(F.col("count") < k).orderBy(file).limit(5).collect():
        raise ValueError(f"not enough symbols: {[(r[0], r['count']) for r in few]}")
    order = Window.partitionBy(file).orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), symbol)), symbol)
    return both.withColumn("__n", F.row_number().over(order)).where(F.col("__n") <= k).drop("__n")


def rows_of_pools(df: DataFrame, pools: DataFrame, *, file: str = "file", symbol: str = "symbol", day: str | None = None, shift: int = 0) -> DataFrame:
    """Rows of each file's own symbols, with the date `day` moved by `shift` days, so that one day's pools serve others."""
    out = df.join(pools.select(file, symbol), [file, symbol], "left_semi")
    return out.withColumn(day, F.date_add(day, shift)) if day else out
