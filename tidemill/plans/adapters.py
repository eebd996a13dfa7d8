"""The star-schema tables in the roles of market data, for the queries; and the same as SQL common table expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.timeaxis import DAY, HOUR, micros
from tidemill.operators.bars import enrich, ohlcv
from tidemill.operators.parse import enum_map

EVENT_MAP = {"signup": "ADD", "view": "ADD", "click": "TRADE", "error": "CANCEL"}
WINDOW = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as trade ticks."""
    return table(spark, sf_dir, "events").select(F.col("user_id").cast("string").alias("symbol"), micros("ts").alias("ts"), F.col("event_id").alias("seq"), F.col("value").alias("price"), (F.col("event_id") % 100 + 1).alias("volume"), enum_map(F.col("event_type"), EVENT_MAP).alias("event"))


def day_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ohlcv(enrich(ticks(spark, sf_dir)), step=DAY)


def hour_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ohlcv(enrich(ticks(spark, sf_dir)), step=HOUR)


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as vendor rows: every column a string, as archives have them."""
    e = table(spark, sf_dir, "events").withColumn("us", micros("ts"))
    of_day = F.pmod("us", F.lit(DAY))
    div = lambda c, n: F.call_function("div", c, F.lit(n))
    tick = div(of_day, HOUR) * 1_000_000 + div(of_day % HOUR, 60_000_000) * 10_000 + div(of_day % 60_000_000, 1_000_000) * 100 + F.col("event_id") % 100
    kind = lambda **m: F.coalesce(enum_map(F.col("event_type"), m), F.lit("X"))
    side = F.when(F.col("event_id") % 3 == 0, "1").when(F.col("event_id") % 3 == 1, "2").otherwise("N")
    return e.select(
        F.lpad(F.concat(F.when(F.col("user_id") % 4 == 0, "60").when(F.col("user_id") % 4 == 1, "00").when(F.col("user_id") % 4 == 2, "300").otherwise("9"), F.lpad(F.col("user_id").cast("string"), 3, "0")), 6, "0").alias("SecurityID"),
        F.date_format(F.date_from_unix_date(div(F.col("us"), DAY).cast("int")), "yyyy-MM-dd").alias("TradeTime"),
        tick.cast("string").alias("TickTime"),
        tick.cast("string").alias("OrderTime"),
        kind(view="A", signup="A", error="D", click="T").alias("TickType"),
        kind(view="1", signup="2", error="0", click="3").alias("OrderType"),
        kind(click="1", error="2").alias("ExecType"),
        F.col("value").cast("string").alias("Price"),
        F.col("value").cast("string").alias("TradePrice"),
        (F.col("event_id") % 100 + 1).cast("string").alias("Volume"),
        (F.col("event_id") % 100 + 1).cast("string").alias("TradeVolume"),
        side.alias("Side"),
        F.col("event_id").cast("string").alias("SubSeq"),
        (F.col("event_id") * 2).cast("string").alias("BuyNo"),
        (F.col("event_id") * 2 + 1).cast("string").alias("SellNo"),
    )


def book_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as ADD events of 500 and their lines as TRADE or, returned ones, CANCEL events; ADD comes before others of its time."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"), (F.col("o_custkey") % 20).cast("string").alias("symbol"), micros("o_orderdate").alias("ts"), F.when(F.substring("o_orderpriority", 1, 1).isin("1", "2"), "B").otherwise("S").alias("side"), (F.floor(F.col("o_totalprice") / 1000) * 10).cast("double").alias("price"))
    add = orders.select("symbol", "ts", F.lit("ADD").alias("event"), "order_id", "side", "price", F.lit(500).cast("long").alias("volume"), F.lit(0).cast("long").alias("seq"))
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("order_id"), micros("l_shipdate").alias("ts"), F.when(F.col("l_returnflag") == "R", "CANCEL").otherwise("TRADE").alias("event"), F.col("l_quantity").cast("long").alias("volume"), F.lit(1).cast("long").alias("seq"))
    other = lines.join(orders.select("order_id", "symbol"), "order_id").select("symbol", "ts", "event", "order_id", F.lit(None).cast("string").alias("side"), F.lit(None).cast("double").alias("price"), "volume", "seq")
    return add.unionByName(other)


def rounded(df: DataFrame, digits: int = 6, only: list[str] | None = None) -> DataFrame:
    """Doubles rounded, for comparison with another engine's sums."""
    names = only or [f.name for f in df.schema if f.dataType.simpleString() == "double"]
    return df.withColumns({c: _round(F.col(c), digits) for c in names})


def _round(c: Column, digits: int) -> Column:
    r = F.round(c, digits)
    return F.when(r == 0, 0.0).otherwise(r)  # no negative zero


# --- SQL -------------------------------------------------------------------

TICKS = """t AS (SELECT CAST(user_id AS VARCHAR) AS symbol, epoch_us(ts) AS ts, event_id AS seq, value AS price, event_id % 100 + 1 AS volume,
    CASE event_type WHEN 'signup' THEN 'ADD' WHEN 'view' THEN 'ADD' WHEN 'click' THEN 'TRADE' WHEN 'error' THEN 'CANCEL' END AS event FROM events)"""
ENRICHED = TICKS + """, e AS (SELECT *, price * volume AS notional,
    CAST(coalesce(sign(price - lag(price) OVER (PARTITION BY symbol ORDER BY ts, seq)), 0) AS TINYINT) AS trade_side FROM t)"""


def bars_sql(step: int) -> str:
    return ENRICHED + f""", g AS (SELECT symbol, ts + 28800000000 - (ts + 28800000000) % {step} AS bar, * EXCLUDE (symbol) FROM e),
    b AS (SELECT bar AS ts, CAST(strftime(make_timestamp(bar), '%Y%m%d') AS INTEGER) AS trade_date,
        CAST((bar // 60000000 % 1440) // 60 * 100 + (bar // 60000000 % 1440) % 60 AS SMALLINT) AS minute, strftime(make_timestamp(bar), '%H:%M') AS minute_str,
        arg_min(price, ts) AS open, max(price) AS high, min(price) AS low, arg_max(price, ts) AS close, CAST(sum(volume) AS BIGINT) AS volume,
        sum(notional) AS notional, count(price) AS trade_count, symbol FROM g GROUP BY symbol, bar)"""


DAY_BARS, HOUR_BARS = bars_sql(DAY), bars_sql(HOUR)
BOOK = """o AS (SELECT o_orderkey AS order_id, CAST(o_custkey % 20 AS VARCHAR) AS symbol, epoch_us(o_orderdate) AS ts,
        CASE WHEN o_orderpriority[1] IN ('1', '2') THEN 'B' ELSE 'S' END AS side, CAST(floor(o_totalprice / 1000) * 10 AS DOUBLE) AS price FROM orders),
    l AS (SELECT o.symbol, epoch_us(l_shipdate) AS ts, CASE WHEN l_returnflag = 'R' THEN 'CANCEL' ELSE 'TRADE' END AS event, o.order_id, CAST(l_quantity AS BIGINT) AS volume, o.ts AS born, o.side, o.price
        FROM lineitem JOIN o ON o.order_id = l_orderkey),
    d AS (SELECT order_id, sum(CASE WHEN event = 'TRADE' THEN volume ELSE 0 END) AS traded, max(CASE WHEN event = 'CANCEL' THEN 1 ELSE 0 END) AS cancelled FROM l WHERE ts >= born GROUP BY order_id),
    r AS (SELECT o.*, CAST(coalesce(traded, 0) AS BIGINT) AS traded, coalesce(cancelled, 0) AS cancelled, CAST(CASE WHEN coalesce(cancelled, 0) = 1 OR coalesce(traded, 0) >= 500 THEN 0 ELSE 500 - coalesce(traded, 0) END AS BIGINT) AS remaining FROM o LEFT JOIN d USING (order_id))"""


def sql_round(expr: str, name: str, digits: int = 6) -> str:
    return f"CASE WHEN round({expr}, {digits}) = 0 THEN 0.0 ELSE round({expr}, {digits}) END AS {name}"
