"""Whole runs: raw feeds to labels, training day by day, the replay of a published model."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.functions.timeaxis import MINUTE
from tidemill.operators.asof import asof, replay_grid
from tidemill.operators.backtest import Strategies, equity_curve, fills, positions, report
from tidemill.operators.bars import enrich, ohlcv
from tidemill.operators.dataset import rank_ic, training_set
from tidemill.operators.features import feature_chain
from tidemill.operators.labels import forward_return
from tidemill.operators.models import Artifact, inference, resolve_artifact, trainer
from tidemill.operators.parse import a_shares, clean_tokens, parse_events
from tidemill.operators.sgd import State, walk_forward
from tidemill.sources import files
from tidemill.sources.manifest import Manifest, promote


@dataclass(frozen=True)
class Settings:
    window: int = 20
    steps: int = 5
    trades_only: bool = False
    features: Sequence[str] = ("close", "volume", "l0_amount", "l0_range", "l0_abs_move")
    trainer: tuple[str, str, str] = ("sgd", "regression", "v1")
    rates: Mapping[str, float] = field(default_factory=dict)
    strategy: Mapping[str, Any] = field(default_factory=lambda: {"type": "threshold", "threshold": 0.0, "qty": 1})

    @property
    def label(self) -> str:
        return f"label_fwd_ret_s{self.steps}"


def events_of(feeds: Mapping[tuple[str, str], DataFrame], seq: str = "SubSeq") -> DataFrame:
    """Canonical A-share trades of all trade feeds, with the exchange and an ingest sequence. Without feeds' rows the result is empty, not an error."""
    parts = [a_shares(parse_events(clean_tokens(raw), exchange, kind, keep=[F.col(seq).cast("long").alias("seq"), F.lit(exchange).alias("exchange")])) for (exchange, kind), raw in sorted(feeds.items()) if kind == "trade"]
    if not parts:
        raise ValueError("no trade feed")
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def bars_of(events: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Minute bars. Ticks are dealt out by symbol once, which serves the tick rule and the bars."""
    return ohlcv(enrich(events, trades_only=settings.trades_only))


def features_and_labels(bars: DataFrame, settings: Settings = Settings()) -> tuple[DataFrame, DataFrame]:
    """Windows end with the day, as runs of one day do."""
    day = ("trade_date",)
    return feature_chain(bars, settings.window, by=day), forward_return(bars, settings.steps, by=day)


def local_files(df: DataFrame) -> list[str]:
    """Files that a table is read from, as paths of this machine; none if it has none or some are elsewhere."""
    found = [unquote(x.removeprefix("file://")) for x in df.inputFiles()]
    return found if all(x.startswith("/") for x in found) else []


def run_data(feeds: Mapping[tuple[str, str], DataFrame], out: str, settings: Settings = Settings(), manifests: str | None = None) -> dict[str, str]:
    """Writes bars, features and labels in folders of trade_date; returns their paths.

    With a folder of `manifests` a step whose input is as it was, and whose output is still there, isn't run again; features and labels
    go by the bars, bars by the feeds' files. What has no files runs each time.
    """
    paths = {n: f"{out}/{n}" for n in ("min", "feature", "label")}
    spark = next(iter(feeds.values())).sparkSession if feeds else None

    def made(name: str, sources: list[str], make: Callable[[], DataFrame]) -> None:
        mark = Manifest(manifests, "data", f"{name}.w{settings.window}.s{settings.steps}.{'t' if settings.trades_only else 'a'}", strict=True) if manifests and sources else None
        if mark and not mark.changed(sources):
            return
        files.write(make(), paths[name], by=["trade_date"], order=["symbol", "ts"])
        if mark:
            mark.commit(sources, paths[name], files.read(spark, paths[name]).count())

    raw = sorted({f for (_, kind), df in feeds.items() if kind == "trade" for f in local_files(df)})
    made("min", raw, lambda: bars_of(events_of(feeds), settings))
    bars = files.read(spark, paths["min"])
    features, labels = features_and_labels(bars, settings)
    for name, df in (("feature", features), ("label", labels)):
        made(name, local_files(bars), lambda df=df: df)
    return paths


def run_training(spark: SparkSession, out: str, folder: str | Path, settings: Settings = Settings()) -> tuple[State, DataFrame]:
    """Day by day: learn from a day, judge on the next. The state after the last update is saved; every evaluated day has its rank IC."""
    rows = training_set(files.read(spark, f"{out}/feature"), files.read(spark, f"{out}/label"), list(settings.features), settings.label, keys=["symbol", "ts", "trade_date"])
    scored, state = walk_forward(rows, "trade_date", settings.features, settings.label, train=trainer(*settings.trainer), **settings.rates)
    if state is None:
        raise RuntimeError("training takes two days at least")
    state.save(folder)
    return state, rank_ic(scored, by=["update_day", "eval_day"])


def run_backtest(spark: SparkSession, out: str, artifact: Artifact, settings: Settings = Settings(), step: int = MINUTE) -> dict[str, DataFrame]:
    """fills, equity and report of the published model on the features there are."""
    features = files.read(spark, f"{out}/feature")
    state = inference({"artifact": artifact})
    columns = list(dict.fromkeys(["close", *state.features]))
    seen = asof(replay_grid(features, step), features, columns)
    grid = seen.withColumn("price", F.col("close")).withColumn("target", Strategies.build(dict(settings.strategy))(state.score()))
    held = positions(grid.select("symbol", "ts", "price", "target"))
    return {"fills": fills(held), "equity": equity_curve(held), "report": report(held)}


def run_experiment(spark: SparkSession, feeds: Mapping[tuple[str, str], DataFrame], root: str, name: str, version: str, settings: Settings = Settings()) -> dict[str, DataFrame]:
    """Data, training, publishing and replay; replays read published models only."""
    run_data(feeds, f"{root}/data", settings)
    run_training(spark, f"{root}/data", f"{root}/run", settings)
    return run_backtest(spark, f"{root}/data", resolve_artifact(promote(f"{root}/run", f"{root}/models", name, version)), settings)
