"""Vendor rows to canonical events, and the filters and checks on them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from pathlib import PurePath

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.functions.timeaxis import base_day, tick_offset
from tidemill.schemas import EVENT, require

#: What the vendor writes for nothing.
NULL_TOKENS = ("", " ", "NULL", "N/A", "nan")


@dataclass(frozen=True)
class Feed:
    """Vendor columns of one feed."""

    time: str
    event: str
    events: Mapping[str, str]
    price: str = "Price"
    volume: str = "Volume"
    side: str | None = "Side"
    numbers: bool = False  # whether it names buy and sell orders
    symbol: str = "SecurityID"
    key: str = "SubSeq"


#: Fixed values of the vendor's format.
SIDES = {"1": "B", "2": "S"}
FEEDS = {
    ("sh", "order"): Feed("TickTime", "TickType", {"A": "ADD", "D": "CANCEL"}),
    ("sh", "trade"): Feed("TickTime", "TickType", {"T": "TRADE"}, numbers=True),
    ("sz", "order"): Feed("OrderTime", "OrderType", {"0": "CANCEL", "1": "ADD", "2": "ADD", "3": "ADD"}),
    ("sz", "trade"): Feed("TickTime", "ExecType", {"1": "TRADE", "2": "CANCEL"}, "TradePrice", "TradeVolume", None, True),
}
#: Prefixes of A-share symbols.
A_SHARES = ("60", "688", "00", "300")
#: Raw files by the beginning of their name, and the units in them.
RAW_UNITS = {"sh_stock_ordertrade": ("sh_order", "sh_trade"), "sh_order": ("sh_order",), "sh_trade": ("sh_trade",), "sz_order": ("sz_order",), "sz_trade": ("sz_trade",)}


def enum_map(value: Column, mapping: Mapping[str, str]) -> Column:
    """The mapped value; null for a null or unknown key."""
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])[value.cast("string")]


def clean_tokens(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Vendor null tokens of string columns to null."""
    names = columns or [f.name for f in df.schema if f.dataType.simpleString() == "string"]
    return df.withColumns({c: F.when(~F.col(c).isin(*NULL_TOKENS), F.col(c)) for c in names})


def parse_events(raw: DataFrame, exchange: str, kind: str, *, keep: Sequence[str] = (), tick_format: str = "HHMMSScc", lenient: bool = False) -> DataFrame:
    """Canonical events of one feed, with `keep` columns (an ingest sequence, say) behind them.

    KeyError for an unknown feed. Text that isn't a number is an error, or null if `lenient`. An empty input gives no rows.
    """
    feed = FEEDS[exchange, kind]
    require(raw, ["TradeTime"], "parse_events needs the date")
    cast = (lambda c, t: F.col(c).try_cast(t)) if lenient else (lambda c, t: F.col(c).cast(t))
    number = lambda c: cast(c, "long") if feed.numbers else F.lit(0).cast("long")
    return raw.select(
        F.col(feed.symbol).cast("string").alias("symbol"),
        (base_day(F.col("TradeTime")) + tick_offset(F.col(feed.time), tick_format)).alias("ts"),
        enum_map(F.col(feed.event), feed.events).alias("event"),
        cast(feed.key, "long").alias("order_id"),
        (enum_map(F.col(feed.side), SIDES) if feed.side else F.lit(None).cast("string")).alias("side"),
        cast(feed.price, "double").alias("price"),
        cast(feed.volume, "long").alias("volume"),
        number("BuyNo").alias("buy_no"),
        number("SellNo").alias("sell_no"),
        *keep,
    )


def row_events(df: DataFrame, *, event: str = "fact_dir") -> DataFrame:
    """Rows of a vendor table as events: every column in the event's type, the event's name taken from `event`, and a side that is NaN or null as null."""
    kind = df.schema["side"].dataType.simpleString()
    side = F.when(~F.isnan("side"), F.col("side").cast("string")) if kind in ("double", "float") else F.col("side").cast("string")
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in EVENT.fields if f.name not in ("event", "side")]
    return df.select(F.col(event).cast("string").alias("event"), side.alias("side"), *typed).select(*EVENT.names)


def a_shares(df: DataFrame, symbol: str = "symbol", prefixes: Sequence[str] = A_SHARES) -> DataFrame:
    """Rows whose symbol begins with one of `prefixes`; a filter that reaches the scan."""
    test = F.lit(False)
    for p in prefixes:
        test = test | F.col(symbol).startswith(p)
    return df.where(test)


def only_symbols(df: DataFrame, symbols: Sequence[str], symbol: str = "symbol") -> DataFrame:
    return df.where(F.col(symbol).isin(*symbols))


def normalize(df: DataFrame, *, seq: str | None = None, prefixes: Sequence[str] = A_SHARES) -> DataFrame:
    """A-shares in the order (symbol, ts, seq). TypeError if ts is neither a long nor a timestamp; the order is total only with `seq`."""
    require(df, ["symbol", "ts"], "normalize")
    if df.schema["ts"].dataType.simpleString() not in ("bigint", "timestamp", "timestamp_ntz"):
        raise TypeError("normalize: ts must be a long or a timestamp")
    return a_shares(df, prefixes=prefixes).orderBy("symbol", "ts", *([seq] if seq else []))


def raw_units(file: str) -> dict[str, str]:
    """Unit -> file; ValueError if it isn't a .7z, RuntimeError for an unknown name."""
    path = PurePath(file)
    if path.suffix != ".7z":
        raise ValueError(f"not a raw file: {file}")
    for prefix, units in RAW_UNITS.items():
        if path.stem.lower().startswith(prefix):
            return dict.fromkeys(units, file)
    raise RuntimeError(f"unknown raw file: {path.name}")


def raw_unit_rows(df: DataFrame, name: str) -> DataFrame:
    """A row for each unit of each file name in a column; unknown names give none."""
    low = F.lower(name)
    units = F.when(F.lit(False), F.array().cast("array<string>"))
    for prefix, own in RAW_UNITS.items():
        units = units.when(low.startswith(prefix), F.array(*map(F.lit, own)))
    return df.withColumn("unit", F.explode(units))


def plan_downloads(date: str, files: Sequence[str], root: str = "/level2") -> list[dict[str, str]]:
    """What to fetch of a day's listing; bonds and empty names are left out."""
    from tidemill.functions.timeaxis import resolve_date

    day = resolve_date(date)
    return [{"date": day, "filename": f, "remote_path": f"{root}/{day}/{f}"} for f in files if f and "Bond" not in f]


def symbol_index(df: DataFrame, symbol: str = "symbol") -> DataFrame:
    """(symbol, start, length) of each symbol's run in the canonical order. TypeError if the symbol isn't a string."""
    from pyspark.sql import Window

    require(df, [symbol], "symbol_index")
    if df.schema[symbol].dataType.simpleString() != "string":
        raise TypeError("symbol_index: the symbol must be a string")
    counts = df.groupBy(symbol).agg(F.count("*").alias("length"))
    before = Window.orderBy(symbol).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(symbol, F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long").alias("start"), "length")


def resolve_symbols(sources: Mapping[str, DataFrame], wanted: Sequence[str] | None = None) -> DataFrame:
    """(symbol, source): where each symbol is found. RuntimeError without sources or if a symbol is in several, KeyError if one wanted is in none."""
    if not sources:
        raise RuntimeError("no source")
    parts = [df.select("symbol").distinct().withColumn("source", F.lit(name)) for name, df in sorted(sources.items())]
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    if wanted is not None:
        every = every.where(F.col("symbol").isin(*wanted))
    found = every.groupBy("symbol").agg(F.min("source").alias("source"), F.count("*").alias("n"))
    if twice := found.where("n > 1").limit(5).collect():
        raise RuntimeError(f"in several sources: {sorted(r.symbol for r in twice)}")
    if wanted is not None:
        have = {r.symbol for r in found.select("symbol").collect()}
        if lost := sorted(set(wanted) - have):
            raise KeyError(f"in no source: {lost}")
    return found.select("symbol", "source")


def empty_events(spark) -> DataFrame:
    return spark.createDataFrame([], EVENT)
