"""Quality classifier: regularised quadratic discriminant analysis over transformed document statistics.

Each class has a mean and a covariance, shrunk towards the pooled covariance and towards a multiple of the identity. A score is the
logistic of the difference of the two log densities (Mahalanobis distances by cached Cholesky factors) and log priors.
Moments are exact sums over all labelled rows, added up on the executors; the driver sees only sums of a fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import NON_SPACE, crc_fold, map_texts, running, spans, word_hashes

STATISTICS = ("log_words", "log_word_bytes", "upper", "symbols", "bars", "marks", "stops", "digits", "lines", "repeats", "near_repeats", "long_words", "beyond_ascii", "distinct")


def _table(chars: bytes) -> np.ndarray:
    t = np.zeros(256, np.int32)
    t[list(chars)] = 1
    return t


_UPPER, _BAR, _MARK, _STOP = _table(bytes(range(65, 91))), _table(b"|"), _table(b"!?"), _table(b".,;:")
_SYMBOL, _DIGIT, _LINE = _table(b"#$%&*+/<=>@\\^_`{}~[]"), _table(b"0123456789"), _table(b"\n")
_HIGH = (np.arange(256) >= 128).astype(np.int32)


def statistics(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row of STATISTICS for each text. Shares are square-rooted, counts are logged; a text without words has the values that all shares tend to."""
    start, end, first = spans(data, offsets, NON_SPACE)
    words = word_hashes(data, start, end)
    n = np.diff(first).astype(float)
    size = np.diff(offsets).astype(float)
    sums = lambda per_byte: np.diff(running(per_byte)[offsets]).astype(float)
    by_word = lambda per_word: np.diff(running(per_word)[first]).astype(float)
    row = np.repeat(np.arange(len(n)), np.diff(first))

    def same(d: int) -> np.ndarray:
        out = np.zeros(len(words), bool)
        out[d:] = (words[d:] == words[:-d]) & (row[d:] == row[:-d])
        return out

    repeat = same(1)
    near = repeat | same(2) | same(3) | same(4)
    bits = max(1, int(len(n)).bit_length())
    tagged = np.sort((row.astype(np.uint64) << np.uint64(64 - bits)) | (words >> np.uint64(bits)))  # by text, then by most of the hash
    fresh = np.ones(len(words), bool)
    fresh[1:] = tagged[1:] != tagged[:-1]
    length = end - start
    some, many = size + 48, n + 8  # so that one sign in a text of a few words is no large share
    share = lambda x, of: np.sqrt(np.minimum(x / of, 4))
    return np.stack(
        [
            np.log1p(n),
            np.log1p((by_word(length) + 48) / many),
            share(sums(_UPPER[data]), some),
            share(sums(_SYMBOL[data]), some),
            share(sums(_BAR[data]), many),
            share(sums(_MARK[data]), many),
            share(sums(_STOP[data]), many),
            share(sums(_DIGIT[data]), some),
            share(sums(_LINE[data]), many),
            share(by_word(repeat), many),
            share(by_word(near), many),
            share(by_word(length > 24), many),
            share(sums(_HIGH[data]), some),
            np.where(n > 0, np.log1p(by_word(fresh)) / np.maximum(np.log1p(n), 1e-9), 1.0),
        ],
        axis=1,
    )


def features(docs: DataFrame, *, text: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Each row of `docs` (its `carry` columns) with `features`, an array of the STATISTICS of its whole text."""

    def make():
        def work(data: np.ndarray, offsets: np.ndarray, rows: pa.RecordBatch) -> list[pa.Array]:
            x = statistics(data, offsets)
            return [pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))]

        return work

    return map_texts(docs, text, carry, T.StructType().add("features", T.ArrayType(T.DoubleType()), False), make)


@dataclass
class Model:
    """For each class: log prior, mean and the inverse of the covariance's Cholesky factor with its log determinant."""

    prior: tuple[float, float]
    mean: np.ndarray
    factor: np.ndarray
    log_det: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        density = []
        for c in (0, 1):
            z = (x - self.mean[c]) @ self.factor[c].T
            density.append(self.prior[c] - 0.5 * (np.einsum("ij,ij->i", z, z) + self.log_det[c]))
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def model_of(count: np.ndarray, total: np.ndarray, square: np.ndarray, shrink: float, ridge: float) -> Model:
    """From each class's number of rows, sum of rows and sum of outer products."""
    d = total.shape[1]
    mean = total / np.maximum(count, 1)[:, None]
    scatter = square - count[:, None, None] * mean[:, :, None] * mean[:, None, :]
    pooled = scatter.sum(axis=0) / max(count.sum() - 2, 1)
    scale = np.maximum(np.diag(pooled), 1e-6)  # shrinking happens in units of the pooled deviations
    factor, log_det = [], []
    for c in (0, 1):
        own = scatter[c] / max(count[c] - 1, 1)
        weight = count[c] / (count[c] + d)  # a class of few rows leans on the pooled covariance
        cov = (1 - shrink) * (weight * own + (1 - weight) * pooled) + shrink * pooled
        cov = cov + ridge * np.diag(scale)
        low = np.linalg.cholesky((cov + cov.T) / 2)
        factor.append(np.linalg.inv(low))
        log_det.append(2 * np.log(np.diag(low)).sum())
    prior = np.log((count + 1) / (count.sum() + 2))
    return Model((float(prior[0]), float(prior[1])), mean, np.stack(factor), np.array(log_det))


def fit(docs: DataFrame, labels: DataFrame, *, text: str = "text", key: str = "doc_id", label: str = "quality", use: Column | None = None, shrink: float = 0.05, ridge: float = 0.02) -> Model:
    """A model of all labelled rows whose crc32(key as text) mod 5 is not 0 (or `use`, a condition on `__key`).

    Edge cases: null or other labels, and null keys, are left out; of several labels of one key the largest holds; a class without rows
    takes the mean 0 and the pooled covariance. No column but the text goes into the statistics.
    """
    use = crc_fold(F.col("__key"), 5) != 0 if use is None else use
    marks = labels.select(F.col(f"`{key}`").alias("__key"), F.col(f"`{label}`").cast("int").alias("__label")).where("__key is not null and __label in (0, 1)").where(use).groupBy("__key").agg(F.max("__label").alias("__label"))
    rows = features(docs, text=text, carry=(key,)).select(F.col(f"`{key}`").alias("__key"), "features").join(marks, "__key").select("__label", "features")
    d = len(STATISTICS)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total, square = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
        for b in batches:
            y = b.column(0).to_numpy()
            x = b.column(1).flatten().to_numpy().reshape(-1, d)
            for c in (0, 1):
                own = x[y == c]
                count[c] += len(own)
                total[c] += own.sum(axis=0)
                square[c] += own.T @ own
        flat = np.concatenate([count, total.ravel(), square.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat)], names=["i", "v"])

    sums = rows.mapInArrow(moments, "i long, v double").groupBy("i").agg(F.sum("v").alias("v"))
    flat = np.zeros(2 + 2 * d + 2 * d * d)
    for r in sums.collect():  # a fixed number of sums
        flat[r.i] = r.v
    return model_of(flat[:2], flat[2 : 2 + 2 * d].reshape(2, d), flat[2 + 2 * d :].reshape(2, d, d), shrink, ridge)


def score(docs: DataFrame, model: Model, *, text: str = "text", carry: Sequence[str] = ("doc_id",), threshold: float = 0.3) -> DataFrame:
    """Each row of `docs` (its `carry` columns) with `score` (0 to 1, higher: label 1 likelier) and `predicted` (1 from `threshold` on).

    Edge cases: a null text is scored as the empty one; texts are scored whole at any length; repeated rows are scored each; an empty table
    gives no rows; columns that are not carried don't matter, and one named as a result gives way to it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = shared.value

        def work(data: np.ndarray, offsets: np.ndarray, rows: pa.RecordBatch) -> list[pa.Array]:
            s = m.scores(statistics(data, offsets))
            return [pa.array(s), pa.array((s >= threshold).astype(np.int32))]

        return work

    fields = T.StructType().add("score", T.DoubleType(), False).add("predicted", T.IntegerType(), False)
    return map_texts(docs, text, carry, fields, make)
