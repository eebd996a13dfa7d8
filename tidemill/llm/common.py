"""Helpers shared by the text operators: shared storage, chunked Arrow scans, vectorised words."""

from __future__ import annotations

import ctypes
import hashlib
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.sources.scratch import remove, scratch, send

#: Bytes of text that one vectorised step looks at; one longer document is a step of its own.
CHUNK_BYTES = 1 << 20

_SPACE = np.ones(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = False
#: Bytes of words [^\x20\x09-\x0D]+ ; every byte of a multi-byte character is one.
NON_SPACE = _SPACE
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[0x30:0x3A] = _ALNUM[0x61:0x7B] = _ALNUM[0x80:] = True
#: Bytes of words [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ (lower-cased text).
LOWER_ALNUM = _ALNUM
#: Lower-cases A-Z only.
FOLD = np.arange(256, dtype=np.uint8)
FOLD[65:91] += 32


# --- storage ---------------------------------------------------------------


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once for each application, and hold Arrow batches of long texts to a few MB."""
    most = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(most, "4m").rstrip("b") == str(64 << 20):  # as it comes, not as somebody has set it
        spark.conf.set(most, "4m")
    send(spark)


@contextmanager
def _released(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs within go when it ends: nothing reads them again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def cut(df: DataFrame, codec: str = "zstd") -> DataFrame:
    """Write `df` as a table in the shared folder and read it again: lineage ends here, and lost executors cost no recompute.

    Shuffle files of the plan that ends here are given back. Tables of a few long columns do without zstd ("snappy"), which takes native
    memory for each file. `drop` deletes what no result needs any more.
    """
    spark = df.sparkSession
    path = scratch(spark)
    with _released(spark):
        df.write.option("compression", codec).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._tidemill_path = path
    return out


def dealt(df: DataFrame, column: str, buckets: int, once: bool = False) -> DataFrame:
    """`df` as a table in the shared folder, in buckets of `column`: groups by it, and cogroups and joins of it with others, move these rows no more.

    once: one row for each value. The table is known to the session's catalogue only until its plan is made; `drop` deletes its files.
    """
    spark = df.sparkSession
    path = scratch(spark)
    name = f"tidemill_{uuid.uuid4().hex}"
    most = int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000"))
    buckets = min(most, max(buckets, spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    rows = df.repartition(buckets, column)
    rows = rows.dropDuplicates([column]) if once else rows
    with _released(spark):
        rows.write.format("parquet").bucketBy(buckets, column).option("path", path).option("compression", "zstd").saveAsTable(name)
    out = spark.table(name)
    out._tidemill_path = path if out.columns else None
    spark.sql(f"DROP TABLE {name}")
    return out


def drop(*tables: DataFrame) -> None:
    """Delete tables that `cut` made and that no lazy result reads."""
    for df in tables:
        if path := df.__dict__.pop("_tidemill_path", None):
            remove(df.sparkSession, path)


def crc_fold(key: Column, folds: int) -> Column:
    """crc32 of the key's decimal text modulo `folds`; a null key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % F.lit(folds)


def stored_bytes(df: DataFrame) -> int | None:
    """The plan's size estimate; None where there is none."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return None if size >= 1 << 60 else size


def shards(df: DataFrame, bytes_each: int = 5 << 20) -> int:
    """How many shards keep a shard near `bytes_each` of stored input; follows the plan's size estimate, and is at least the number of cores."""
    spark = df.sparkSession
    least = max(1, spark.sparkContext.defaultParallelism)
    size = stored_bytes(df)
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")) if size is None else -(-size // bytes_each))


# --- scans -----------------------------------------------------------------


def texts_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null reads as the empty text, bytes that aren't UTF-8 as U+FFFD."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "") if column.null_count else column
    if pa.types.is_large_string(column.type):
        kind = np.int64
    elif pa.types.is_string(column.type):
        kind = np.int32
    else:
        column, kind = column.cast(pa.large_string()), np.int64
    try:
        column.validate(full=True)
    except pa.ArrowInvalid:
        raw = column.cast(pa.large_binary()).to_pylist()
        column, kind = pa.array([x.decode("utf-8", "replace") for x in raw], pa.large_string()), np.int64
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(offsets, kind, len(column) + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    if data is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offs[0] : offs[-1]], offs - offs[0]


def pieces(offsets: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about `limit` bytes each."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def map_texts(df: DataFrame, text: str, carry: Sequence[str], fields: T.StructType, make: Callable[[], Callable[[np.ndarray, np.ndarray, pa.RecordBatch], Sequence[pa.Array]]], limit: int = CHUNK_BYTES) -> DataFrame:
    """`carry` columns of `df` plus `fields`, computed from whole texts in Arrow batches where the rows lie.

    `make()` runs once a task and returns f(bytes, offsets, carried rows) -> arrays of `fields`. Names in `fields` win over carried ones.
    """
    ship(df.sparkSession)
    new = {f.name for f in fields}
    carry = [c for c in carry if c not in new]
    source = df.select(*[F.col(f"`{c}`") for c in carry], F.col(f"`{text}`").alias("__text"))
    schema = T.StructType([*source.schema.fields[:-1], *fields.fields])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            data, offs = texts_of(batch.column(batch.num_columns - 1))
            for i, j in pieces(offs, limit):
                rows = batch.slice(i, j - i)
                out = work(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i], rows)
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], *out], names=names)
        del work
        trim()

    return source.mapInArrow(run, schema)


# --- words -----------------------------------------------------------------

_ODD = np.uint64(0x9E3779B97F4A7C15)
#: What is left of eight bytes when only the first k count.
KEEP = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)
#: Words of more bytes are hashed by BLAKE2 each.
_LONG = 64


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finisher of 64-bit words."""
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


def spans(data: np.ndarray, offsets: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word starts, word ends (bytes) and, for each document and one more, the index of its first word."""
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offsets), np.int64)
    inside = table[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    before[offsets[offsets < n]] = False
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[offsets[offsets > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    return start, end, np.searchsorted(start, offsets)


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, lane: int = 0) -> np.ndarray:
    """A 64-bit hash of each word's bytes, the same in every chunk and process. Lanes are independent: two of them make 128 bits.

    Eight bytes at a time go through a bijection, so words of one length up to 8 bytes never collide; long words are hashed by BLAKE2, since
    no short recurrence over their bytes is safe from texts with a structure of their own.
    """
    length = end - start
    wide = np.ndarray((len(data) + 1,), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), 0, (1,))
    first, step = (np.uint64(x) for x in ((0xD1342543DE82EF95, 0xA0761D6478BD642F), (0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3))[lane])
    h = mix((wide[start] & KEEP[np.minimum(length, 8)]) * first ^ length.astype(np.uint64) * step)
    left = np.flatnonzero((length > 8) & (length <= _LONG))
    at = 8
    while len(left):
        block = wide[start[left] + at] & KEEP[np.minimum(length[left] - at, 8)]
        h[left] = mix((h[left] << np.uint64(23) | h[left] >> np.uint64(41)) * step + block * first)
        at += 8
        left = left[length[left] > at]
    for i in np.flatnonzero(length > _LONG).tolist():
        h[i] = int.from_bytes(hashlib.blake2b(data[start[i] : end[i]], digest_size=16).digest()[8 * lane : 8 * lane + 8], "little")
    return h


def gram_hashes(words: np.ndarray, k: int, lane: int = 0) -> np.ndarray:
    """Hash of each run of `k` word hashes, regardless of documents; len(words) - k + 1 of them. Each place in a run has a random odd factor of its own."""
    n = len(words) - k + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    factors = mix(np.arange(1, k + 1, dtype=np.uint64) * _ODD + np.uint64(lane)) | np.uint64(1)
    total = words[:n] * factors[0]
    for d in range(1, k):
        total += words[d : d + n] * factors[d]
    return mix(total + np.uint64(k))


def whole(first: np.ndarray, n: int, k: int) -> np.ndarray:
    """Which of the n - k + 1 runs of k words lie in one document."""
    ok = np.ones(max(0, n - k + 1), bool)
    for d in range(1, k):  # a run that starts d words before a document's first word crosses into it
        at = first[1:-1] - d
        ok[at[(at >= 0) & (at < len(ok))]] = False
    return ok


def trim() -> None:
    """Give a worker's unused memory back: workers live on from task to task, and what one step took is another's to use."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def tidy(f: Callable) -> Callable:
    """`f`, for groups of Arrow tables, trimming memory after each; its signature, which tells Spark the form, stays."""
    names = f.__code__.co_argcount
    if names == 2:

        def run(keys, table):
            try:
                return f(keys, table)
            finally:
                trim()
    else:

        def run(keys, left, right):
            try:
                return f(keys, left, right)
            finally:
                trim()

    return run


class Lookup:
    """Positions of 64-bit keys in a fixed set, by open addressing; all steps are vectorised."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys = np.ascontiguousarray(keys, np.uint64)
        bits = max(4, int(2 * len(keys) + 1).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.slot = np.full(1 << bits, -1, np.int32)
        left = np.arange(len(keys), dtype=np.int32)
        at = self._at(keys)
        while len(left):
            free = self.slot[at] < 0
            self.slot[at[free]] = left[free]  # of several for one slot the last stays
            lost = self.slot[at] != left
            left, at = left[lost], (at[lost] + 1) & self.mask

    def _at(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Index of each key, -1 where it isn't there."""
        keys = np.ascontiguousarray(keys, np.uint64)
        out = np.full(len(keys), -1, np.int64)
        if not len(self.keys) or not len(keys):
            return out
        at = self._at(keys)
        got = self.slot[at]
        there = got >= 0
        same = there & (self.keys[got] == keys)
        out[same] = got[same]
        left = np.flatnonzero(there & ~same)
        at = at[left]
        while len(left):
            at = (at + 1) & self.mask
            got = self.slot[at]
            there = got >= 0
            same = there & (self.keys[got] == keys[left])
            out[left[same]] = got[same]
            go = there & ~same
            left, at = left[go], at[go]
        return out


def running(counts: np.ndarray) -> np.ndarray:
    """0 and the running sums, as int64."""
    out = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    return out
