"""Training sets, rank information coefficients and classification measures."""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import PurePath

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.numeric import sum_before
from tidemill.operators.features import finite


def training_set(features: DataFrame, labels: DataFrame, columns: Sequence[str], label: str, *, keys: Sequence[str] = ("symbol", "ts"), drop_na: bool = True) -> DataFrame:
    """Keys, feature columns and label of rows that both sides have; infinities and NaN are null, and rows with a null go if `drop_na`."""
    x = features.select(*keys, *[finite(F.col(c).cast("double")).alias(c) for c in columns])
    y = labels.select(*keys, finite(F.col(label).cast("double")).alias(label))
    both = x.join(y, list(keys))
    return both.dropna("any", subset=[*columns, label]) if drop_na else both


def training_rows(df: DataFrame, columns: Sequence[str], label: str, *, keys: Sequence[str] = ("symbol", "ts"), drop_na: bool = True) -> DataFrame:
    """The same of a table that has features and label beside each other: no join."""
    rows = df.select(*keys, *[finite(F.col(c).cast("double")).alias(c) for c in [*columns, label]])
    return rows.dropna("any", subset=[*columns, label]) if drop_na else rows


def match_files(features: Sequence[str], labels: Sequence[str]) -> list[tuple[str, str]]:
    """(feature file, label file) of equal names after `feature.` and `label.`; files without the other are left out, and nothing to match is a RuntimeError."""
    rest = {PurePath(x).name.removeprefix("label."): x for x in labels if PurePath(x).name.startswith("label.")}
    pairs = [(x, rest[n]) for x in sorted(features) if PurePath(x).name.startswith("feature.") and (n := PurePath(x).name.removeprefix("feature.")) in rest]
    if not pairs:
        raise RuntimeError("no feature file has a label file")
    return pairs


def serving_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Feature columns for scoring: what is missing, NaN or infinite is 0; columns that aren't there are 0 throughout."""
    return df.withColumns({c: F.coalesce(finite(F.col(c).cast("double")), F.lit(0.0)) if c in df.columns else F.lit(0.0) for c in columns})


def walk_forward(days: DataFrame, day: str = "day") -> DataFrame:
    """(update_day, eval_day): each existing day with the next one; the last is only evaluated on."""
    w = Window.orderBy(day)
    return days.select(F.col(day).alias("update_day"), F.lead(day).over(w).alias("eval_day")).where("eval_day is not null")


def average_rank(value: str, by: Sequence[str]) -> Column:
    """Rank among the group's rows; equal values share the mean of their ranks."""
    return F.rank().over(Window.partitionBy(*by).orderBy(value)) + (F.count("*").over(Window.partitionBy(*by, value)) - 1) / 2


def rank_ic(df: DataFrame, *, prediction: str = "pred", target: str = "y", by: Sequence[str] = ("eval_day",)) -> DataFrame:
    """Spearman's correlation in each group; NaN where one side doesn't vary. Pairs with a null or NaN are left out."""
    rows = df.select(*by, finite(F.col(prediction).cast("double")).alias("p"), finite(F.col(target).cast("double")).alias("t")).dropna("any", subset=["p", "t"])
    ranked = rows.select(*by, average_rank("p", by).alias("rp"), average_rank("t", by).alias("rt"))
    # ranks have the mean (n + 1) / 2, so sums of products are all that a group needs
    sums = ranked.groupBy(*by).agg(F.count("*").alias("n"), F.sum(F.col("rp") * F.col("rt")).alias("pt"), F.sum(F.col("rp") * F.col("rp")).alias("pp"), F.sum(F.col("rt") * F.col("rt")).alias("tt"))
    centre = F.col("n") * (F.col("n") + 1) * (F.col("n") + 1) / 4
    vp, vt = F.col("pp") - centre, F.col("tt") - centre
    return sums.select(*by, F.when((vp > 0) & (vt > 0), (F.col("pt") - centre) / F.sqrt(vp * vt)).otherwise(float("nan")).alias("rank_ic"), "n")


def rolling_mean(df: DataFrame, window: int, *, value: str = "rank_ic", order: str = "eval_day", name: str | None = None) -> DataFrame:
    """Mean of the current and the window - 1 rows before, null before there are so many. A series of days is short: one partition."""
    w = Window.orderBy(order).rowsBetween(1 - window, 0)
    return df.withColumn(name or f"{value}_mean_{window}", F.when(F.count(value).over(w) == window, F.avg(value).over(w)))


def classification(df: DataFrame, *, label: str = "label", predicted: str = "predicted", score: str | None = "score", by: Sequence[str] = ()) -> DataFrame:
    """accuracy, f1 of class 1 and, from scores, auc by the sum of ranks; null where a measure has nothing to go by."""
    y, p = F.col(label) == 1, F.col(predicted) == 1
    rows = df
    if score:
        rows = rows.withColumn("__rank", average_rank(score, [*by])) if by else global_rank(rows, score, "__rank")
    count = lambda c: F.sum(F.when(c, 1).otherwise(0))
    out = rows.groupBy(*by).agg(F.count("*").alias("n"), count(F.col(label) == F.col(predicted)).alias("ok"), count(y & p).alias("tp"), count(~y & p).alias("fp"), count(y & ~p).alias("fn"), count(y).alias("pos"), *([F.sum(F.when(y, F.col("__rank"))).alias("ranks")] if score else []))
    neg = F.col("n") - F.col("pos")
    measures = [F.try_divide(F.col("ok"), F.col("n")).alias("accuracy"), F.coalesce(F.try_divide(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0)).alias("f1")]
    if score:
        measures.append(F.try_divide(F.col("ranks") - F.col("pos") * (F.col("pos") + 1) / 2, F.col("pos") * neg).alias("auc"))
    return out.select(*by, "n", *measures)


def global_rank(df: DataFrame, score: str, name: str) -> DataFrame:
    """Adds the rank among all rows; equal scores share the mean of their ranks. Scores are counted first and summed part by part."""
    counts = sum_before(df.groupBy(score).agg(F.count("*").alias("__n")), score, "__n", "__less")
    return df.join(counts.select(score, (F.col("__less") + (F.col("__n") + 1) / 2).alias(name)), score, "left")


def daily_reports(scored: DataFrame, *, by: Sequence[str] = ("update_day", "eval_day"), asof: str = "update_day", **names: str) -> DataFrame:
    """A record a pair of days: both days, the model's day, and its measures as a struct. Days without rows to evaluate have none."""
    measures = classification(scored, by=by, **names)
    inner = [c for c in measures.columns if c not in by]
    return measures.select(*by, F.col(asof).alias("model_asof_day"), F.struct(*inner).alias("metrics"))
