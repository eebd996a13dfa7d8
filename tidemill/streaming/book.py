"""A live order book: one state a symbol, a snapshot after each batch of its events."""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators.orderbook import COLUMNS, Book
from tidemill.schemas import SNAPSHOT
from tidemill.sources.scratch import send

STATE = "book string"


def _load(text: str | None) -> Book:
    book = Book()
    if text:
        doc = json.loads(text)
        book.last_ts = doc["ts"]
        book.orders = {int(k): v for k, v in doc["orders"].items()}
        book.sides = {s: {float(p): q for p, q in rows} for s, rows in doc["sides"].items()}
    return book


def _dump(book: Book) -> str:
    return json.dumps({"ts": book.last_ts, "orders": book.orders, "sides": {s: list(x.items()) for s, x in book.sides.items()}})


def step(key: tuple, frames: Iterable[pd.DataFrame], state: Any, depth: int = 10) -> Iterator[pd.DataFrame]:
    """All of one symbol's events of a batch, in the order (ts, seq); then its best levels."""
    book = _load(state.get[0] if state.exists else None)
    rows = pd.concat(list(frames), ignore_index=True).sort_values(["ts", "seq"], kind="stable")
    some = lambda x: None if x is None or x != x else x
    for ts, event, order_id, side, price, volume in rows[list(COLUMNS[1:])].itertuples(index=False, name=None):
        volume = some(volume)
        book.apply(int(ts), event, int(order_id), some(side), some(price), None if volume is None else int(volume))
    state.update((_dump(book),))
    levels = [(key[0], *r) for r in book.rows(depth)] or [(key[0], book.last_ts, None, None, None, None)]
    yield pd.DataFrame(levels, columns=SNAPSHOT.names).astype({"level": "Int16", "volume": "Int64", "ts": "Int64"})


def stream_book(events: DataFrame, *, depth: int = 10) -> DataFrame:
    """Snapshots of a stream of book events with a sequence number; write them in update mode. A book without a level is one row without one."""
    from pyspark.sql.streaming.state import GroupStateTimeout

    send(events.sparkSession)
    return events.select(*COLUMNS, "seq").groupBy("symbol").applyInPandasWithState(lambda k, f, s: step(k, f, s, depth), SNAPSHOT, STATE, "update", GroupStateTimeout.NoTimeout)


def latest(snapshots: DataFrame, *, batch: str = "batch") -> DataFrame:
    """Of snapshots with the number of their batch, each symbol's last."""
    last = snapshots.groupBy("symbol").agg(F.max(batch).alias(batch))
    return snapshots.join(last, ["symbol", batch]).where("level is not null").drop(batch)
