import random

import pytest
from pyspark.sql import functions as F

from tidemill.functions.timeaxis import MINUTE
from tidemill.operators import backtest as bt
from tidemill.operators import dataset as ds
from tidemill.operators import orderbook as ob
from tidemill.operators import sgd

SCHEMA = "symbol string, ts long, event string, order_id long, side string, price double, volume long, seq long"


def feed(spark, rows, symbol="a"):
    return spark.createDataFrame([(symbol, k, *r, k) for k, r in enumerate(rows, 1)], SCHEMA)


def snap(df):
    return sorted((r.symbol, r.ts, r.side, r.level, r.price, r.volume) for r in df.collect())


BASIC = [("ADD", 1, "B", 10.0, 100), ("ADD", 2, "S", 10.5, 200), ("CANCEL", 1, None, None, None), ("ADD", 3, "B", 9.8, 50), ("TRADE", 2, None, None, 200)]


@pytest.mark.parametrize("how", [ob.snapshot, ob.fold, ob.exact_snapshot])
def test_basic(spark, how):
    assert snap(how(feed(spark, BASIC))) == [("a", 5, "B", 1, 9.8, 50)]


def test_overfill_goes_to_the_fold(spark):
    over = feed(spark, [("ADD", 1, "B", 10.0, 50), ("ADD", 2, "B", 10.0, 50), ("TRADE", 1, None, None, 80)])
    assert [r.symbol for r in ob.irregular(over).collect()] == ["a"]
    assert snap(ob.exact_snapshot(over)) == [("a", 3, "B", 1, 10.0, 20)] == snap(ob.fold(over))
    again = feed(spark, [("ADD", 1, "B", 10.0, 50), ("CANCEL", 1, None, None, None), ("ADD", 1, "B", 11.0, 5)])
    assert snap(ob.exact_snapshot(again)) == [("a", 3, "B", 1, 11.0, 5)]


def test_incomplete_add_is_ignored_whole(spark):
    rows = feed(spark, [("ADD", 1, "B", 10.0, 5), ("ADD", 2, "X", 10.0, 5), ("ADD", 3, "B", None, 5)])
    assert snap(ob.snapshot(rows)) == snap(ob.fold(rows)) == [("a", 1, "B", 1, 10.0, 5)]


def test_depth_and_order(spark):
    rows = feed(spark, [("ADD", k, "B" if k % 2 else "S", 10.0 + k, 1) for k in range(1, 31)])
    got = snap(ob.snapshot(rows))
    assert len(got) == 20 and got == snap(ob.fold(rows))
    assert [r[4] for r in got if r[2] == "B"][:2] == [39.0, 37.0] and [r[4] for r in got if r[2] == "S"][:2] == [12.0, 14.0]


def test_events(spark):
    got = ob.book_events(feed(spark, BASIC)).orderBy("ts").collect()
    assert len(got) == 5 and got[0].notional == 1000.0 and got[2].notional == 0.0 and got[2].volume == 0
    with pytest.raises(Exception, match="unknown event"):
        ob.book_events(feed(spark, [("X", 1, "B", 1.0, 1)])).collect()
    with pytest.raises(ValueError):
        ob.Book().apply(1, None, 1, "B", 1.0, 1)


def test_relational_form_is_the_machine(spark):
    rnd, rows = random.Random(3), []
    for s in range(40):
        left = {}
        for k in range(30):
            kind = rnd.choice(["ADD", "CANCEL", "TRADE"])
            oid = rnd.randrange(8)
            if kind == "ADD" and oid not in left:
                left[oid] = 100
                rows.append((f"s{s}", k // 2, "ADD", oid, rnd.choice("BS"), float(rnd.randrange(5)), 100, k))
            elif kind == "TRADE":
                take = rnd.randrange(0, 40)
                if oid in left and (left[oid] < take or left[oid] == 0):
                    continue
                left[oid] = left.get(oid, 0) - take if oid in left else left.get(oid)
                if left.get(oid) is None:
                    left.pop(oid, None)
                rows.append((f"s{s}", k // 2, "TRADE", oid, None, None, take, k))
            elif kind == "CANCEL":
                if oid in left:
                    left[oid] = 0
                rows.append((f"s{s}", k // 2, "CANCEL", oid, None, None, None, k))
    df = spark.createDataFrame(rows, SCHEMA)
    assert snap(ob.exact_snapshot(df)) == snap(ob.fold(df))


def test_live_book_keeps_state(spark):
    from tidemill.streaming.book import step

    class State:
        exists, value = False, None

        @property
        def get(self):
            return self.value

        def update(self, value):
            self.exists, self.value = True, value

    state, rows = State(), feed(spark, BASIC).toPandas()
    next(step(("a",), [rows[:2]], state))
    out = next(step(("a",), [rows[2:]], state))
    assert out[["ts", "side", "level", "price", "volume"]].values.tolist() == [[5, "B", 1, 9.8, 50]]


def grid(spark, seed):
    rnd = random.Random(seed)
    price = lambda: rnd.choice([None, float("nan"), 0.0, -1.0, 10.0, 11.5, 12.25, 9.75])
    return [("r", s, t * MINUTE // 2, price(), rnd.choice([-1.0, 0.0, 0.5, 2.0])) for s in ("a", "b", "c") for t in range(40)]


@pytest.mark.parametrize("seed", range(3))
def test_closed_form_is_the_replay(spark, seed):
    df = spark.createDataFrame(grid(spark, seed), "run string, symbol string, ts long, price double, score double")
    held = bt.positions(df.withColumn("target", bt.threshold_target(F.col("score"), 0.0, 3)))
    fast = [(r.ts, round(r.cash, 6), round(r.equity, 6)) for r in bt.equity_curve(held).orderBy("ts").collect()]
    slow = bt.replay(df, lambda ts, seen, pos, cash: {s: 3 if x["score"] > 0 else 0 for s, x in seen.items()}, features=["score"])
    assert fast == [(r.ts, round(r.cash, 6), round(r.equity, 6)) for r in slow.orderBy("ts").collect()]
    money = sum((-1 if f.side == "BUY" else 1) * f.qty * f.price for f in bt.fills(held).collect())
    assert bt.report(held).first().final_cash == pytest.approx(1e6 + money)


def test_strategies():
    with pytest.raises(KeyError):
        bt.Strategies.build({})
    with pytest.raises(ValueError):
        bt.Strategies.build({"type": "magic"})


def test_rank_ic(spark):
    rows = [("d1", float(p), float(y)) for p, y in [(1, 2), (2, 1), (2, 3), (4, 4), (5, 5)]] + [("d2", 1.0, 1.0), ("d2", 1.0, 2.0)]
    got = {r.eval_day: r.rank_ic for r in ds.rank_ic(spark.createDataFrame(rows, "eval_day string, pred double, y double")).collect()}
    import pandas as pd

    x = pd.DataFrame(rows[:5])
    assert got["d1"] == pytest.approx(x[1].rank().corr(x[2].rank())) and got["d2"] != got["d2"]
    r = ds.rolling_mean(spark.createDataFrame([("1", 1.0), ("2", 3.0)], "eval_day string, rank_ic double"), 2, name="m").orderBy("eval_day").collect()
    assert [x.m for x in r] == [None, 2.0]


def test_training_set(spark):
    f = spark.createDataFrame([("a", 1, 1.0), ("a", 2, float("inf")), ("a", 3, 3.0)], "symbol string, ts long, x double")
    y = spark.createDataFrame([("a", 1, 0.1), ("a", 2, 0.2), ("a", 3, None)], "symbol string, ts long, label double")
    assert [r.ts for r in ds.training_set(f, y, ["x"], "label").collect()] == [1]
    assert ds.training_set(f, y, ["x"], "label", drop_na=False).count() == 3
    assert ds.serving_values(f, ["x", "z"]).where("ts = 2").first()[2:] == (0.0, 0.0)


def test_sgd_learns_and_is_carried(spark, tmp_path):
    rnd = random.Random(0)
    rows = [("a", k, x := rnd.uniform(-1, 1), 2 * x + 1) for k in range(800)]
    df = spark.createDataFrame(rows, "symbol string, ts long, x double, label double")
    state = sgd.train_day(df, "label", sgd.State(["x"]), eta0=0.1)
    assert state.steps == 800 and state.weights[0] == pytest.approx(2, abs=0.2) and state.intercept == pytest.approx(1, abs=0.2)
    assert sgd.train_day(df.repartition(5), "label", sgd.State(["x"]), eta0=0.1) == state
    more = sgd.train_day(df, "label", state, eta0=0.1)
    assert more.steps == 1600
    more.save(tmp_path)
    assert sgd.State.load(tmp_path) == more
    assert sgd.train_day(df.limit(0), "label", state) == state
    assert df.select(state.score().alias("s")).first().s == pytest.approx(state.weights[0] * rows[0][2] + state.intercept)


def test_classification(spark):
    df = spark.createDataFrame([(1, 1, 0.9), (1, 0, 0.4), (0, 0, 0.3), (0, 1, 0.6)], "label int, predicted int, score double")
    r = ds.classification(df).first()
    assert (r.accuracy, r.f1, r.auc) == (0.5, 0.5, 0.75)
