import math

import pytest
from pyspark.sql import functions as F

from tidemill.functions.timeaxis import DAY, HOUR, MINUTE
from tidemill.operators import bars as br
from tidemill.operators import features as ft
from tidemill.operators import labels as lb
from tidemill.operators.asof import asof, replay_grid

NOON = 20_000 * DAY


def ticks(spark, rows):
    return spark.createDataFrame(rows, "symbol string, ts long, seq long, price double, volume long")


def test_tick_rule(spark):
    df = br.enrich(ticks(spark, [("a", 1, 1, 10.0, 100), ("a", 2, 2, 10.5, 50), ("a", 3, 3, 10.5, 20), ("a", 4, 4, 10.2, 10), ("b", 5, 5, 1.0, 1), ("a", 6, 6, None, 1), ("a", 7, 7, 10.0, 1)]))
    got = {(r.symbol, r.ts): (r.trade_side, r.notional) for r in df.collect()}
    assert [got["a", t][0] for t in (1, 2, 3, 4, 6, 7)] == [0, 1, 0, -1, 0, 0] and got["b", 5][0] == 0
    assert got["a", 1][1] == 1000.0 and got["a", 6][1] is None


def test_equal_times_go_by_seq(spark):
    df = br.enrich(ticks(spark, [("a", NOON, 2, 11.0, 1), ("a", NOON, 1, 10.0, 1), ("a", NOON, 3, 12.0, 1)]))
    r = br.ohlcv(df).first()
    assert (r.open, r.close, r.high, r.low, r.trade_count, r.volume) == (10.0, 12.0, 12.0, 10.0, 3, 3)


def test_bar_clock(spark):
    at = NOON + HOUR + 25 * MINUTE + 1_000_000  # 01:25:01 UTC
    r = br.ohlcv(br.enrich(ticks(spark, [("a", at, 1, 1.0, 1)]))).first()
    assert (r.minute, r.minute_str) == (925, "09:25") and r.ts % MINUTE == 0
    late = ticks(spark, [("a", NOON + 16 * HOUR - 1, 1, 1.0, 1), ("a", NOON + 16 * HOUR, 2, 1.0, 1)])
    days = sorted((x.minute, x.trade_date) for x in br.ohlcv(br.enrich(late)).collect())
    assert days[0][0] == 0 and days[1][0] == 2359 and days[0][1] == days[1][1] + 1
    with pytest.raises(ValueError):
        br.ohlcv(br.enrich(late), exchange="NYSE")


def test_input_partitions_do_not_matter(spark):
    rows = [("a", NOON + k * 1000, k, float(k * 7 % 11), k) for k in range(200)]
    one = br.ohlcv(br.enrich(ticks(spark, rows).coalesce(1))).collect()
    many = br.ohlcv(br.enrich(ticks(spark, rows).repartition(7))).collect()
    assert sorted(one) == sorted(many)


def test_unsorted_is_found(spark):
    df = ticks(spark, [("a", 2, 1, 1.0, 1), ("a", 1, 2, 1.0, 1)])
    with pytest.raises(Exception, match="sorted by time"):
        br.check_sorted(df).collect()
    assert br.check_sorted(df.where("seq = 1")).count() == 1


def test_order_flow(spark):
    rows = [("a", 1, "ADD", 100, 1000.0), ("a", 2, "CANCEL", 40, 400.0), ("a", 3, "TRADE", 5, 50.0), ("b", 1, None, 5, 5.0)]
    df = spark.createDataFrame(rows, "symbol string, ts long, event string, volume long, notional double")
    got = {r.symbol: r for r in br.order_flow(df).collect()}
    a = got["a"]
    assert (a.add_volume, a.cancel_volume, a.net_volume, a.add_notional, a.cancel_notional, a.event_count) == (100, 40, 60, 1000.0, 400.0, 3)
    assert got["b"].add_volume is None and got["b"].event_count == 0
    assert "event_count" not in br.order_flow(df, event_count=False).columns
    assert br.order_flow(df.limit(0)).count() == 0


def bars(spark, n=6, **over):
    rows = [{"symbol": "a", "ts": k, "open": 10.0, "high": 12.0, "low": 9.0, "close": 10.0 + k, "volume": 10 * k, "trade_count": k} | {c: f(k) for c, f in over.items()} for k in range(n)]
    return spark.createDataFrame(rows, "symbol string, ts long, open double, high double, low double, close double, volume long, trade_count long" + "".join(f", {c} double" for c in over))


def test_l0(spark):
    r = ft.l0(bars(spark)).where("ts = 0").first()
    assert (r.l0_avg_trade_size, r.l0_log_volume, r.l0_range, r.l0_abs_move) == (0.0, 0.0, 3.0, 0.0)
    assert "l0_imbalance" not in ft.l0(bars(spark)).columns
    both = ft.l0(bars(spark, buy_volume=lambda k: 30.0, sell_volume=lambda k: 10.0)).first()
    assert (both.l0_buy_ratio, both.l0_imbalance) == (0.75, 0.5)
    again = ft.l0(ft.l0(bars(spark)))
    assert again.columns == ft.l0(bars(spark)).columns
    with pytest.raises(ValueError):
        ft.l0(bars(spark).drop("open"))


def test_l1(spark):
    x = bars(spark, l0_volume=lambda k: [10.0, 20.0, 30.0, 40.0, 50.0, 60.0][k], l0_trade_count=lambda k: [1.0, 2.0, 3.0, 4.0, 5.0, 6.0][k], l0_abs_move=lambda k: float(k + 1))
    got = {r.ts: r for r in ft.l1_statistics(x.withColumn("close", F.element_at(F.array(*map(F.lit, [10.0, 20.0, 40.0, 0.0, 5.0, 5.0])), F.col("ts").cast("int") + 1)), 2).collect()}
    assert [got[k].l1_mean_w2_volume for k in (0, 1, 2)] == [0.0, 0.0, 15.0]
    assert got[2].l1_sum_w2_trade_count == 3.0 and got[2].l1_std_w2_abs_move == pytest.approx(math.sqrt(0.5))
    assert [got[k].l1_ret_w2_1 for k in (0, 1, 2, 3)] == pytest.approx([0.0, math.log(2), math.log(2), 0.0]) and got[4].l1_ret_w2_1 == math.inf
    assert got[2].l1_ratio_w2_volume == 2.0
    one = ft.l1_statistics(x, 1).where("ts = 3").first()
    assert one.l1_std_w1_abs_move == 0.0
    with pytest.raises(ValueError):
        ft.l1_statistics(x, 0)


def test_zscore(spark):
    z = {r.ts: r.l1_z_w3_l0_amount for r in ft.l1_zscores(bars(spark, l0_amount=lambda k: [0.0, 0.0, 0.0, 100.0, float("nan"), 3.0][k]), 3, columns=["l0_amount"]).collect()}
    assert z[3] == 0.0 and z[4] == 0.0 and z[5] == 0.0
    assert len(ft.feature_chain(bars(spark).withColumns({"trade_date": F.lit(1), "minute": F.lit(1).cast("short"), "minute_str": F.lit(""), "notional": F.lit(1.0)}), 3).columns) == 40


def test_later_rows_never_change_earlier_features(spark):
    a, b = (ft.feature_chain(bars(spark, n), 2) for n in (4, 6))
    assert sorted(a.collect()) == sorted(b.where("ts < 4").collect())


def test_one_exchange(spark):
    plan = ft.feature_chain(bars(spark), 3)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_labels(spark):
    got = [r.label_fwd_ret_s2 for r in lb.forward_return(bars(spark, 4), 2).orderBy("ts").collect()]
    assert got == pytest.approx([0.2, 2 / 11, None, None]) if None not in got else got[:2] == pytest.approx([0.2, 2 / 11]) and got[2:] == [None, None]
    assert {r.l for r in lb.forward_return(bars(spark, 3), 5, name="l").collect()} == {None}
    logs = [r.x for r in lb.forward_return(bars(spark, 3), 1, log=True, name="x").orderBy("ts").collect()]
    assert logs[0] == pytest.approx(math.log(1.1)) and logs[2] is None
    with pytest.raises(ValueError):
        lb.forward_return(bars(spark), 0)


def test_asof(spark):
    facts = spark.createDataFrame([("a", 10, 1.0), ("a", 20, None), ("a", 30, 3.0), ("b", 5, 9.0)], "symbol string, ts long, price double")
    clock = spark.createDataFrame([("a", t, t * 2) for t in (5, 10, 15, 20, 25, 30, 99)] + [("c", 1, 1)], "symbol string, ts long, mine long")
    got = {(r.symbol, r.ts): (r.price, r.mine) for r in asof(clock, facts, ["price"]).collect()}
    assert [got["a", t][0] for t in (5, 10, 15, 20, 25, 30, 99)] == [None, 1.0, 1.0, None, None, 3.0, 3.0]
    assert got["a", 99][1] == 198 and got["c", 1] == (None, 1)
    assert replay_grid(facts, 10).count() == 2 * 3
