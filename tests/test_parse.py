from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemill.functions import timeaxis as ta
from tidemill.operators import parse as ps
from tidemill.schemas import EVENT


def raw(spark, **over):
    row = {"SecurityID": "600000", "TradeTime": "2025-12-01 09:30:00", "TickTime": "9300012", "TickType": "T", "Price": "10.5", "Volume": "100", "Side": "1", "SubSeq": "7", "BuyNo": "10", "SellNo": "20"} | over
    return spark.createDataFrame([row])


def test_schema_and_values(spark):
    out = ps.parse_events(raw(spark), "sh", "trade")
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in EVENT]
    r = out.first()
    day = (date(2025, 12, 1) - date(1970, 1, 1)).days * ta.DAY - 8 * ta.HOUR
    assert (r.event, r.side, r.buy_no, r.sell_no, r.order_id) == ("TRADE", "B", 10, 20, 7)
    assert r.ts - day == (9 * 3600 + 30 * 60) * 1_000_000 + 12_000


def test_unmapped_is_null(spark):
    r = ps.parse_events(raw(spark, TickType="Z", Side="9"), "sh", "trade").first()
    assert r.event is None and r.side is None


def test_sz_trade_has_no_side(spark):
    r = ps.parse_events(raw(spark, ExecType="2", TradePrice="1", TradeVolume="2"), "sz", "trade").first()
    assert (r.event, r.side, r.price, r.volume) == ("CANCEL", None, 1.0, 2)


def test_orders_have_no_counterparties(spark):
    r = ps.parse_events(raw(spark, TickType="A"), "sh", "order").first()
    assert (r.event, r.buy_no, r.sell_no) == ("ADD", 0, 0)


def test_errors(spark):
    with pytest.raises(KeyError):
        ps.parse_events(raw(spark), "bj", "trade")
    with pytest.raises(ValueError):
        ps.parse_events(raw(spark).drop("TradeTime"), "sh", "trade")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        ps.parse_events(raw(spark, Price="ten"), "sh", "trade").collect()
    assert ps.parse_events(raw(spark, Price="ten"), "sh", "trade", lenient=True).first().price is None


def test_empty(spark):
    assert ps.parse_events(raw(spark).limit(0), "sh", "trade").collect() == []


def test_a_shares_and_order(spark):
    df = spark.createDataFrame([("600001", 3), ("300001", 2), ("300001", 1), ("600001", 1), ("900001", 1), ("AAPL", 1), ("301001", 1), ("688001", 1), ("000001", 1)], "symbol string, ts long")
    got = [(r.symbol, r.ts) for r in ps.normalize(df).collect()]
    assert got == [("000001", 1), ("300001", 1), ("300001", 2), ("600001", 1), ("600001", 3), ("688001", 1)]
    with pytest.raises(TypeError):
        ps.normalize(df.withColumn("ts", F.col("ts").cast("string")))
    with pytest.raises(ValueError):
        ps.normalize(df.drop("ts"))


def test_index(spark):
    df = spark.createDataFrame([("B", 3), ("A", 2), ("A", 1), ("B", 1)], "symbol string, ts long")
    assert {r.symbol: (r.start, r.length) for r in ps.symbol_index(df).collect()} == {"A": (0, 2), "B": (2, 2)}
    with pytest.raises(TypeError):
        ps.symbol_index(df.select(F.col("ts").alias("symbol")))


def test_resolver(spark):
    a, b = (spark.createDataFrame([(s,) for s in x], "symbol string") for x in (["1", "2"], ["3"]))
    assert {tuple(r) for r in ps.resolve_symbols({"sh": a, "sz": b}).collect()} == {("1", "sh"), ("2", "sh"), ("3", "sz")}
    with pytest.raises(RuntimeError):
        ps.resolve_symbols({})
    with pytest.raises(RuntimeError):
        ps.resolve_symbols({"sh": a, "sz": a})
    with pytest.raises(KeyError):
        ps.resolve_symbols({"sh": a}, ["9"])


def test_raw_units_and_downloads():
    assert ps.raw_units("/x/SH_Stock_OrderTrade_1.7z") == {"sh_order": "/x/SH_Stock_OrderTrade_1.7z", "sh_trade": "/x/SH_Stock_OrderTrade_1.7z"}
    assert list(ps.raw_units("sz_trade.7z")) == ["sz_trade"]
    with pytest.raises(ValueError):
        ps.raw_units("sz_trade.csv")
    with pytest.raises(RuntimeError):
        ps.raw_units("other.7z")
    assert [p["remote_path"] for p in ps.plan_downloads("2025-01-02", ["a.7z", "xBond.7z", ""])] == ["/level2/2025-01-02/a.7z"]
    with pytest.raises(ValueError):
        ps.plan_downloads("20250102", [])


def test_ticks(spark):
    df = spark.createDataFrame([("10060049",), ("131500040",), ("93000123",), ("12",), (None,)], "t string")
    got = [None if r.p is None else tuple(r.p) for r in df.select(ta.tick_parts(F.col("t")).alias("p")).collect()]
    assert got == [(10, 6, 0, 490), (13, 15, 0, 40), (9, 30, 0, 123), None, None]
    one = df.limit(1).select(ta.tick_offset(F.lit("93000123"), "HHMMSSmmm").alias("o")).first().o
    assert one == (9 * 3600 + 30 * 60) * 1_000_000 + 123_000
    with pytest.raises(ValueError):
        ta.tick_offset(F.lit(1), "x")


def test_sessions(spark):
    minute = lambda h, m: (h * 60 + m) * ta.MINUTE - 8 * ta.HOUR + 20_000 * ta.DAY
    times = [(9, 29), (9, 30), (11, 29), (11, 30), (13, 0), (14, 59), (15, 0)]
    df = spark.createDataFrame([(minute(*t),) for t in times], "ts long")
    assert [r.d is not None for r in df.select(ta.trading_day(F.col("ts")).alias("d")).collect()] == [False, True, True, False, True, True, False]
    with pytest.raises(Exception, match="not a trading minute"):
        df.select(ta.trading_day(F.col("ts"), strict=True)).collect()
    cal = ta.Calendar([date(2025, 1, 2), date(2025, 1, 6)])
    assert cal.next(date(2025, 1, 2)) == date(2025, 1, 6) and cal.previous(date(2025, 1, 6)) == date(2025, 1, 2) and date(2025, 1, 2) in cal
    with pytest.raises(ValueError):
        cal.next(date(2025, 1, 6))
    with pytest.raises(ValueError):
        ta.offset_us("NYSE")
