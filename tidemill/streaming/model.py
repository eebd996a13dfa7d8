"""A model that learns from a stream, batch by batch."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame

from tidemill.operators.sgd import State, train_day


def map_events(events: Iterable[Any], step: Callable[[Any], Any]) -> Iterator[Any]:
    """step over events, one at a time, as they come."""
    for e in events:
        yield step(e)


def learner(folder: str | Path, features: list[str], label: str, **options: Any) -> Callable[[DataFrame, int], None]:
    """For writeStream.foreachBatch: one pass over each batch, the state kept in `folder`. A batch that comes again after a failure is not learned twice."""
    root = Path(folder)

    def step(batch: DataFrame, batch_id: int) -> None:
        done = root / "batch"
        if done.exists() and int(done.read_text()) >= batch_id:
            return
        state = State.load(root) if (root / "artifact.json").exists() else State(features)
        train_day(batch, label, state, **options).save(root)
        done.write_text(str(batch_id))

    return step
