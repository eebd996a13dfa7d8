import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemill import cli
from tidemill.functions.numeric import clip, padded_symbol, shift_1
from tidemill.operators.models import inference, model_score, resolve_artifact, trainer
from tidemill.operators.orderbook import snapshot
from tidemill.operators.sgd import State
from tidemill.plans import workflows as w


def raw(spark):
    rows = []
    for d in ("2025-12-01", "2025-12-02", "2025-12-03"):
        for k in range(120):
            for s in ("600000", "600001"):
                rows.append((s, f"{d} 09:30:00", str((9 + k // 60) * 1_000_000 + k % 60 * 10_000 + 101), "T", str(10 + (k * 7 + int(s[-1])) % 13 / 10), str(100 + k), "1", str(len(rows)), "1", "2"))
    return spark.createDataFrame(rows, "SecurityID string, TradeTime string, TickTime string, TickType string, Price string, Volume string, Side string, SubSeq string, BuyNo string, SellNo string")


def test_experiment(spark, tmp_path):
    settings = w.Settings(window=3, steps=2, features=("l0_range", "l1_ret_w3_1"), rates={"eta0": 0.01})
    out = w.run_experiment(spark, {("sh", "trade"): raw(spark)}, str(tmp_path), "m", "v1", settings)
    equity = out["equity"].orderBy("ts").collect()
    assert equity[0].equity == 1_000_000.0 and len(equity) > 240
    assert (tmp_path / "models/m/latest/artifact.json").exists()
    feature = spark.read.parquet(str(tmp_path / "data/feature"))
    assert len(feature.columns) == 40 and feature.count() == 720
    first = feature.groupBy("trade_date", "symbol").agg(F.min_by("l1_z_w3_close", "ts").alias("z")).collect()
    assert {r.z for r in first} == {0.0}  # windows don't reach into the day before
    with pytest.raises(ValueError):
        w.events_of({("sh", "order"): raw(spark)})


def test_models(spark, tmp_path):
    with pytest.raises(ValueError):
        trainer("forest", "regression")
    with pytest.raises(KeyError):
        inference({})
    with pytest.raises(TypeError):
        inference({"artifact": "x"})
    with pytest.raises(FileNotFoundError):
        resolve_artifact(tmp_path)
    State(["x"], weights=[2.0]).save(tmp_path)
    assert inference({"artifact": resolve_artifact(tmp_path)}).weights == [2.0]

    class Model:
        def predict_proba(self, x):
            return np.column_stack([1 - x[:, 0], x[:, 0]])

    df = spark.createDataFrame([(0.25,), (None,), (float("nan"),)], "x double")
    assert [r.p for r in df.select(model_score(Model(), ["x"]).alias("p")).collect()] == [0.25, 0.0, 0.0]


def test_small_functions(spark):
    df = spark.createDataFrame([("a", 1, 20.0), ("a", 2, -20.0)], "symbol string, ts long, x double")
    got = df.select(clip(F.col("x"), -10, 10).alias("c"), shift_1("x").alias("s"), padded_symbol(F.col("ts")).alias("p")).collect()
    assert sorted(map(tuple, got), key=str) == [(-10.0, 20.0, "000002"), (10.0, None, "000001")]


def test_streams(spark, tmp_path):
    from tidemill.streaming.bars import stream_bars
    from tidemill.streaming.book import stream_book
    from tidemill.streaming.model import learner, map_events

    rows = [("a", 1, "ADD", 1, "B", 10.0, 100, 1), ("a", 2, "ADD", 2, "S", 10.5, 20, 2), ("a", 3, "TRADE", 1, None, None, 40, 3), ("b", 1, "ADD", 9, "S", 3.0, 7, 4)]
    schema = "symbol string, ts long, event string, order_id long, side string, price double, volume long, seq long"
    df = spark.createDataFrame(rows, schema)
    for k, r in enumerate(rows):
        spark.createDataFrame([r], schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    q = stream_book(source).writeStream.format("memory").queryName("book").outputMode("update").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    q.awaitTermination()
    got = {(r.symbol, r.side): (r.price, r.volume) for r in spark.sql("select symbol, side, max_by(price, ts) price, min_by(volume, (-ts, volume)) volume from book group by 1, 2").collect()}
    want = {(r.symbol, r.side): (r.price, r.volume) for r in snapshot(df).collect()}
    assert got == want
    ticks = source.select("symbol", F.timestamp_micros(F.col("ts")).alias("time"), "seq", "price", "volume")
    q = stream_bars(ticks, width="1 second").writeStream.format("memory").queryName("bars").outputMode("complete").option("checkpointLocation", str(tmp_path / "d")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert {r.symbol: (r.open, r.close, r.trade_count) for r in spark.table("bars").collect()} == {"a": (10.0, 10.5, 2), "b": (3.0, 3.0, 1)}
    day = spark.createDataFrame([("a", k, float(k % 3), 1.0) for k in range(30)], "symbol string, ts long, x double, label double")
    learn = learner(tmp_path / "model", ["x"], "label")
    learn(day, 0)
    learn(day, 0)
    assert State.load(tmp_path / "model").steps == 30
    learn(day, 1)
    assert State.load(tmp_path / "model").steps == 60
    assert list(map_events([1, 2], lambda x: x + 1)) == [2, 3]


def test_cli(capsys):
    assert cli.main(["queries"]) == 0 and "feature_chain" in capsys.readouterr().out
    assert cli.main(["query", "nothing", "x"]) == 2
