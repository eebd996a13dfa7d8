"""Models to train and to serve, by name."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from pathlib import Path
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.features import finite
from tidemill.operators.sgd import State, train_day

TRAINERS: dict[tuple[str, str, str], Callable[..., State]] = {}


def trainer(family: str, task: str, version: str = "v1") -> Callable[..., State]:
    """ValueError for what isn't known."""
    try:
        return TRAINERS[family, task, version]
    except KeyError:
        raise ValueError(f"no trainer for {family}/{task}/{version}") from None


def _sgd(task: str) -> Callable[..., State]:
    def train(df: DataFrame, features: Sequence[str], label: str, state: State | None = None, **options: Any) -> State:
        return train_day(df, label, state or State(list(features), task), **options)

    return train


TRAINERS["sgd", "regression", "v1"] = _sgd("regression")
TRAINERS["sgd", "classification", "v1"] = _sgd("classification")


@dataclass(frozen=True)
class Artifact:
    """A published model's folder."""

    folder: Path

    def load(self) -> State:
        return State.load(self.folder)


def resolve_artifact(folder: str | Path) -> Artifact:
    path = Path(folder)
    if not (path / "artifact.json").exists():
        raise FileNotFoundError(f"no artifact in {path}")
    return Artifact(path)


def inference(config: dict[str, Any]) -> State:
    """The model that a strategy's configuration names. KeyError without one, TypeError for something else than an artifact."""
    artifact = config["artifact"]
    if not isinstance(artifact, Artifact):
        raise TypeError("artifact: an Artifact")
    return artifact.load()


def model_score(model: Any, columns: Sequence[str], *, probability: int | None = 1) -> Column:
    """Any picklable model with predict_proba or predict, in Arrow batches; missing, NaN and infinite features are 0."""

    @F.pandas_udf("double")
    def score(parts: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for part in parts:
            x = np.column_stack([p.to_numpy(float) for p in ((part,) if isinstance(part, pd.Series) else part)])
            if probability is not None and hasattr(model, "predict_proba"):
                yield pd.Series(np.asarray(model.predict_proba(x), float)[:, probability])
            else:
                yield pd.Series(np.asarray(model.predict(x), float))

    return score(*[F.coalesce(finite(F.col(c).cast("double")), F.lit(0.0)) for c in columns])
