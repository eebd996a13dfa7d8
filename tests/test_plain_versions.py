"""Queries that SQL doesn't express against plain versions, and operators beside the queries."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemill.operators import dataset as ds
from tidemill.operators import orderbook as ob
from tidemill.operators import sampling as sp
from tidemill.operators import sgd
from tidemill.plans import queries
from tidemill.plans.adapters import book_feed

SF = "/root/testdata/sf0.001"
SCHEMA = "symbol string, ts long, event string, order_id long, side string, price double, volume long, seq long"


def plain_book(events, depth=10):
    """Levels of one symbol's events, by the rules written out: (side, level, price, volume), and the time of the last event noted."""
    live, quantity, last = {}, {"B": {}, "S": {}}, None
    for ts, event, order, side, price, volume in events:
        if event == "ADD":
            if side not in ("B", "S") or price is None or volume is None:
                continue
            last = ts
            if order in live:
                continue
            live[order] = [side, price, volume]
            quantity[side][price] = quantity[side].get(price, 0) + volume
        elif event == "CANCEL":
            last = ts
            if order in live:
                side, price, rest = live.pop(order)
                quantity[side][price] = quantity[side].get(price, 0) - rest
                if quantity[side][price] <= 0:
                    del quantity[side][price]
        else:
            last = ts
            if order not in live or volume is None or volume <= 0:
                continue
            side, price, rest = live[order]
            left = quantity[side].get(price, 0) - volume
            if rest - volume <= 0:
                del live[order]
                if left > 0:
                    quantity[side][price] = left
                else:
                    quantity[side].pop(price, None)
            else:
                live[order][2] = rest - volume
                quantity[side][price] = max(0, left)
    out = []
    for side, sign in (("B", -1), ("S", 1)):
        out += [(last, side, k, p, quantity[side][p]) for k, p in enumerate(sorted(quantity[side], key=lambda p: sign * p)[:depth], 1)]
    return out


def by_symbol(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.ts, r.seq)):
        out.setdefault(r.symbol, []).append((r.ts, r.event, r.order_id, r.side, r.price, r.volume))
    return out


def snap(df):
    return sorted((r.symbol, r.ts, r.side, r.level, r.price, r.volume) for r in df.collect())


def test_book_fold_is_the_plain_book(spark):
    order, events = ("ts", "seq", "order_id", "event", "volume"), {}
    feed = book_feed(spark, SF).withColumn("volume", F.when(F.col("event") == "ADD", 60).otherwise(F.col("volume")))
    for r in sorted(feed.collect(), key=lambda r: [r[c] for c in order]):
        events.setdefault(r.symbol, []).append((r.ts, r.event, r.order_id, r.side, r.price, r.volume))
    want = sorted((s, *r) for s, own in events.items() for r in plain_book(own))
    assert len(want) > 50 and snap(entry.queries()["book_fold"](spark, SF)) == want == snap(ob.exact_snapshot(feed, seq=order))


def test_books_of_all_kinds_of_events(spark):
    rnd, rows = random.Random(11), []
    for s in range(60):
        for k in range(40):
            kind = rnd.choice(["ADD", "ADD", "CANCEL", "TRADE", "TRADE"])
            rows.append((f"s{s}", k, kind, rnd.randrange(6), rnd.choice(["B", "S", None, "X"]) if rnd.random() < 0.3 else "B", rnd.choice([None, 9.0, 10.0, 11.0]), rnd.choice([None, 0, -5, 10, 20, 30]), k))
    df = spark.createDataFrame(rows, SCHEMA)
    want = sorted((s, *r) for s, events in by_symbol(df).items() for r in plain_book(events))
    assert snap(ob.fold(df)) == want and snap(ob.exact_snapshot(df)) == want


def test_levels_of_no_volume(spark):
    zero = spark.createDataFrame([("a", 1, "ADD", 1, "B", 10.0, 0, 1), ("a", 2, "ADD", 2, "B", 9.0, 5, 2)], SCHEMA)
    assert snap(ob.exact_snapshot(zero)) == [("a", 2, "B", 1, 10.0, 0), ("a", 2, "B", 2, 9.0, 5)]
    over = [("a", 1, "ADD", 1, "B", 10.0, 50, 1), ("a", 2, "ADD", 2, "B", 10.0, 50, 2), ("a", 3, "TRADE", 1, None, None, 120, 3), ("a", 4, "TRADE", 2, None, None, 10, 4)]
    assert snap(ob.exact_snapshot(spark.createDataFrame(over, SCHEMA))) == [("a", 4, "B", 1, 10.0, 0)]  # the second order lives


def test_unknown_event_is_an_error(spark):
    df = spark.createDataFrame([("a", 1, "ADD", 1, "B", 10.0, 5, 1), ("a", 2, "BUST", 1, None, None, None, 2)], SCHEMA)
    for make in (ob.snapshot, ob.exact_snapshot, ob.fold):
        with pytest.raises(Exception, match="unknown event"):
            make(df).collect()


def ranks(x):
    return [sum(b < a for b in x) + (sum(b == a for b in x) + 1) / 2 for a in x]


def plain_sgd(rows, weights, bias, steps, task, eta0, alpha=5e-4, power=0.25):
    for *x, y in rows:
        steps += 1
        eta = eta0 / steps**power
        z = bias + sum(w * v for w, v in zip(weights, x, strict=True))
        error = z - y if task == "regression" else 1 / (1 + math.exp(-z)) - y
        error = max(-1e12, min(1e12, error))
        weights = [w * max(0.0, 1 - eta * alpha) - eta * error * v for w, v in zip(weights, x, strict=True)]
        bias -= eta * error
    return weights, bias, steps


def test_sgd_walk_forward_is_the_plain_one(spark):
    data = queries._train(spark, SF, ("symbol", "ts", "trade_date")).collect()
    days = sorted({r.trade_date for r in data})
    weights, bias, steps, want = [0.0] * 3, 0.0, 0, {}
    for day, after in zip(days, days[1:], strict=False):
        rows = sorted((r.ts, r.symbol, r.close / 100, r.l0_range, r.ret, r.label) for r in data if r.trade_date == day)
        weights, bias, steps = plain_sgd([r[2:] for r in rows], weights, bias, steps, "regression", 1e-5)
        test = [r for r in data if r.trade_date == after]
        pred = [bias + weights[0] * r.close / 100 + weights[1] * r.l0_range + weights[2] * r.ret for r in test]
        a, b = ranks(pred), ranks([r.label for r in test])
        want[str(day), str(after)] = (float(np.corrcoef(a, b)[0, 1]) if len(set(a)) > 1 and len(set(b)) > 1 else math.nan, len(test))
    got = {(r.update_day, r.eval_day): (r.rank_ic, r.n) for r in entry.queries()["sgd_walk_forward"](spark, SF).collect()}
    assert set(got) == set(want) and len(want) > 5
    assert all(got[k][1] == want[k][1] and (got[k][0] == pytest.approx(want[k][0], abs=1e-9) or math.isnan(got[k][0]) and math.isnan(want[k][0])) for k in want)


def test_classifier_learns_as_written(spark):
    rnd = random.Random(2)
    rows = [(k, "a", rnd.gauss(0, 1), rnd.gauss(0, 1), float(rnd.random() < 0.5)) for k in range(80)]
    df = spark.createDataFrame(rows, "ts long, symbol string, x double, z double, y double")
    got = sgd.train_day(df, "y", sgd.State(["x", "z"], "classification"), eta0=0.1)
    weights, bias, steps = plain_sgd([r[2:] for r in rows], [0.0, 0.0], 0.0, 0, "classification", 0.1)
    assert got.weights == pytest.approx(weights) and got.intercept == pytest.approx(bias) and got.steps == steps
    p = df.select("x", "z", got.score().alias("p")).collect()
    assert all(r.p == pytest.approx(1 / (1 + math.exp(-(bias + weights[0] * r.x + weights[1] * r.z)))) for r in p)


def test_stream_learner(spark, tmp_path):
    """A model that learns from a stream's batches, each once, is the model of the same passes over tables."""
    from tidemill.streaming.model import learner, map_events

    schema = "ts long, symbol string, x double, y double"
    batches = [spark.createDataFrame([(10 * b + k, "a", float(k - 3), 2.0 * k + b) for k in range(8)], schema) for b in range(2)]
    want, step = sgd.State(["x"]), learner(str(tmp_path / "model"), ["x"], "y", eta0=0.01)
    for df in batches:
        df.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        stream.writeStream.foreachBatch(step).option("checkpointLocation", str(tmp_path / "mark")).trigger(availableNow=True).start().awaitTermination()
        want = sgd.train_day(df, "y", want, eta0=0.01)
    assert sgd.State.load(tmp_path / "model") == want
    step(batches[0], 0)  # a batch that comes again
    assert sgd.State.load(tmp_path / "model") == want
    assert list(map_events(iter([1, 2]), lambda x: x + 1)) == [2, 3]


def test_steps_are_skipped(spark, tmp_path):
    from tests.test_workflows import raw
    from tidemill.plans import workflows as w

    source = str(tmp_path / "raw")
    raw(spark).write.parquet(source)
    settings = w.Settings(window=3, steps=2)
    run = lambda: w.run_data({("sh", "trade"): spark.read.parquet(source)}, str(tmp_path / "out"), settings, str(tmp_path / "manifests"))
    times = lambda: {n: (tmp_path / "out" / n / "_SUCCESS").stat().st_mtime_ns for n in ("min", "feature", "label")}
    run()
    first = times()
    run()
    assert times() == first
    raw(spark).limit(5).write.mode("append").parquet(source)
    run()
    assert all(times()[n] > first[n] for n in first)
    again = times()
    import shutil

    shutil.rmtree(tmp_path / "out" / "label")
    run()
    assert times()["min"] == again["min"] and times()["feature"] == again["feature"] and times()["label"] > again["label"]


def test_ranks_and_sums_in_parts(spark):
    from tidemill.functions.numeric import sum_before

    rnd = random.Random(7)
    x = [rnd.choice([rnd.gauss(0, 1), 0.5, 1.0]) for _ in range(500)]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(x)], "k long, x double").repartition(5)
    assert {r.k: r.r for r in ds.global_rank(df, "x", "r").collect()} == dict(enumerate(ranks(x)))
    for parts in (1, 4, 256):
        got = {r.k: r.s for r in sum_before(df, "x", "k", "s", parts=parts).collect()}
        assert got == {k: sum(j for j, u in enumerate(x) if u < v) for k, v in enumerate(x)}


def test_pools_need_enough_symbols(spark):
    df = spark.createDataFrame([("f", s) for s in "abc"], "file string, symbol string")
    assert sp.symbol_pools(df, df, 3).count() == 3
    with pytest.raises(ValueError, match="not enough"):
        sp.symbol_pools(df, df, 4)


def test_no_files_match():
    with pytest.raises(RuntimeError):
        ds.match_files(["feature.a"], ["label.b"])
