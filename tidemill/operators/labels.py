"""Labels that look ahead."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.operators.bars import per_symbol
from tidemill.schemas import require


def forward_return(df: DataFrame, steps: int, *, price: str = "close", log: bool = False, name: str | None = None, symbol: str = "symbol", ts: str = "ts", by: Sequence[str] = ()) -> DataFrame:
    """Adds price[t + steps] / price[t] - 1, or the difference of logs; null for the last `steps` rows of a symbol. ValueError unless steps > 0."""
    if steps <= 0:
        raise ValueError("steps: 1 at least")
    require(df, [price], "forward_return")
    now = F.col(price).cast("double")
    then = F.lead(now, steps).over(per_symbol(symbol, ts, by=tuple(by)))
    # a price of 0 gives what floating point gives: no row raises
    simple = F.when(now == 0, F.when(then > 0, float("inf")).when(then < 0, float("-inf")).when(then == 0, float("nan"))).otherwise(F.try_divide(then, now) - 1)
    ln = lambda x: F.when(x > 0, F.log(x)).when(x == 0, float("-inf")).when(x < 0, float("nan"))
    return df.withColumn(name or f"label_fwd_{'logret' if log else 'ret'}_s{steps}", ln(then) - ln(now) if log else simple)


def triple_barrier(df: DataFrame, *, max_holding: int = 20, take: float = 0.01, stop: float = 0.005, price: str = "close", symbol: str = "symbol", ts: str = "ts", name: str = "label_tb") -> DataFrame:
    """+1 if the price first reaches (1 + take) times the current one within max_holding rows, -1 if (1 - stop) times, 0 if neither; null without a row ahead."""
    ahead = F.collect_list(price).over(per_symbol(symbol, ts).rowsBetween(1, max_holding))
    up, down = F.col(price) * (1 + take), F.col(price) * (1 - stop)
    first = lambda test: F.array_position(F.transform(ahead, test), True)
    high, low = first(lambda p: p >= up), first(lambda p: p <= down)
    label = F.when(F.size(ahead) == 0, None).when((high > 0) & ((low == 0) | (high < low)), 1).when(low > 0, -1).otherwise(0)
    return df.withColumn(name, label.cast("byte"))
