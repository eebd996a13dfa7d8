"""Online linear models: one pass of stochastic gradient descent a day, the state carried from day to day."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.sources.scratch import send


@dataclass
class State:
    """Weights of a linear model, and how many steps made them."""

    features: list[str]
    task: str = "regression"
    weights: list[float] = field(default_factory=list)
    intercept: float = 0.0
    steps: int = 0

    def __post_init__(self):
        self.weights = self.weights or [0.0] * len(self.features)

    def score(self) -> Column:
        """The model as a column: no Python on the way. Missing features are 0."""
        total = F.lit(float(self.intercept))
        for name, w in zip(self.features, self.weights, strict=True):
            total = total + F.coalesce(F.col(name).cast("double"), F.lit(0.0)) * F.lit(float(w))
        return total if self.task == "regression" else 1 / (1 + F.exp(-total))

    def save(self, folder: str | Path) -> None:
        path = Path(folder)
        path.mkdir(parents=True, exist_ok=True)
        (path / "artifact.json").write_text(json.dumps(asdict(self), indent=1))

    @classmethod
    def load(cls, folder: str | Path) -> State:
        return cls(**json.loads((Path(folder) / "artifact.json").read_text()))


def pass_over(x: np.ndarray, y: np.ndarray, state: State, *, alpha: float = 5e-4, eta0: float = 0.01, power: float = 0.25) -> State:
    """One pass in the order of the rows: squared loss for regression, logistic for classification; rate eta0 / t ** power, L2 penalty alpha."""
    w, b, t = np.array(state.weights, float), state.intercept, state.steps
    for row, target in zip(x, y, strict=True):
        t += 1
        eta = eta0 / t**power
        z = float(row @ w) + b
        error = z - target if state.task == "regression" else 1 / (1 + np.exp(-np.clip(z, -700, 700))) - target
        error = float(np.clip(error, -1e12, 1e12))
        w *= max(0.0, 1 - eta * alpha)
        w -= eta * error * row
        b -= eta * error
    return State(state.features, state.task, w.tolist(), float(b), t)


def train_day(df: DataFrame, label: str, state: State, *, order: Sequence[str] = ("ts", "symbol"), **rates: float) -> State:
    """`state` after one pass over a day's rows, in a fixed order, in one task: the fold is sequential by definition. Only the weights return."""
    columns = [*state.features, label]
    send(df.sparkSession)

    def run(batches):
        rows = pd.concat(list(batches), ignore_index=True).sort_values(list(order), kind="stable")
        new = pass_over(rows[state.features].to_numpy(float), rows[label].to_numpy(float), state, **rates)
        yield pd.DataFrame({"state": [json.dumps(asdict(new))]})

    day = df.select(*dict.fromkeys([*order, *columns])).dropna("any", subset=columns)
    got = day.coalesce(1).mapInPandas(lambda b: run(b) if (b := _some(b)) is not None else iter(()), "state string").first()
    return State(**json.loads(got.state)) if got else state


def _some(batches):
    import itertools

    first = next(batches, None)
    return None if first is None else itertools.chain([first], batches)


def walk_forward(rows: DataFrame, day: str, features: Sequence[str], label: str, *, train: Callable[..., State] | None = None, **rates: float) -> tuple[DataFrame, State | None]:
    """(update_day, eval_day, pred, y): each row scored by the model that all days before its own made, learned day by day; and the last model.

    Learning is a fold over days; of each day's model only the weights come to the driver. All rows are then scored in one plan, joined with
    one row of weights a day. A table in folders of `day` is read a day at a time. With fewer than two days there are no rows and no model.
    """
    train = train or (lambda df, features, label, state, **o: train_day(df, label, state or State(list(features)), **o))
    days = [r[0] for r in rows.select(day).distinct().orderBy(day).collect()]
    state, models = None, []
    for before, after in zip(days, days[1:]):  # noqa: B905
        state = train(rows.where(F.col(day) == before), features, label, state, **rates)
        models.append((before, after, state.weights, float(state.intercept)))
    kind = rows.schema[day].dataType.simpleString()
    weights = rows.sparkSession.createDataFrame(models, f"__before {kind}, {day} {kind}, __w array<double>, __b double")
    total = F.col("__b")
    for k, name in enumerate(features):
        total = total + F.coalesce(F.col(name).cast("double"), F.lit(0.0)) * F.col("__w")[k]
    pred = 1 / (1 + F.exp(-total)) if state and state.task != "regression" else total
    return rows.join(weights, day).select(F.col("__before").cast("string").alias("update_day"), F.col(day).cast("string").alias("eval_day"), pred.alias("pred"), F.col(label).alias("y")), state
