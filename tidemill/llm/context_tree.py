"""Language-model scores by context-tree weighting, beside a unigram of words.

A byte is coded as 8 binary decisions. Every decision (a node of the byte's binary decomposition) has a tree of contexts, the 0 to `depth` bytes
before. In each context zeros and ones have a Krichevsky-Trofimov estimate P_e; P_w = (P_e + product of the children's P_w) / 2 mixes all
depths. Given the counts of the training texts, the next bit's probability is w * KT + (1 - w) * (that of the longer context) with
w = P_e / (2 P_w), from the deepest context up. A text begins after, and ends with, a byte that UTF-8 never has.

Counting and mixing are sums and joins over the distinct (depth + 1)-grams, as DataFrames. Texts are dealt once, row by row, to shards of
bounded size in a table in buckets. A shard tells its distinct grams and words, one row each, and gets their scores and counts back as rows, so nothing
that grows with the corpus is broadcast or collected, a task holds one shard and its slice of the model, and rows sent are no more than
what the shards have of distinct grams and words. Words are told apart by 128 bits of hash, grams are themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import FOLD, NON_SPACE, Lookup, crc_fold, cut, dealt, drop, pieces, running, shards, ship, spans, texts_of, tidy, word_hashes

MARK = 0xFF  # before the first byte and after the last
END = np.uint64(0x5DEECE66D1234567)  # stands for the end among word hashes
_HALF = math.log(0.5)


def log_gamma(x: Column) -> Column:
    """ln of the gamma function for x > 0 by Stirling's series, moved up by 8."""
    z = x + 8
    up = x
    for k in range(1, 8):
        up = up * (x + k)
    return (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z * z * z) + 1 / (1260 * z * z * z * z * z) - F.log(up)


def log_kt(zeros: Column, ones: Column) -> Column:
    """ln of the KT estimate of a sequence with so many zeros and ones."""
    a, b = zeros.cast("double"), ones.cast("double")
    return log_gamma(a + 0.5) + log_gamma(b + 0.5) - math.log(math.pi) - log_gamma(a + b + 1)


def _high(gram: Column) -> Column:
    """A gram's context: all but its last byte."""
    return gram - gram.bitwiseAND(F.lit(255))


def context_models(grams: DataFrame, depth: int) -> tuple[DataFrame, list[DataFrame]]:
    """(high, p): for each context of `depth` bytes the probability of a one at each node of the next byte's decomposition that occurs; and the tables that this reads.

    grams: (gram, n), n its count in training, 0 if only scored. Grams are dealt by their context before they are split into eight decisions,
    which then are summed where they are; a context has at most 255 nodes.
    """
    i = F.explode(F.sequence(F.lit(0), F.lit(7))).alias("i")
    split = grams.select(_high(F.col("gram")).alias("high"), "gram", "n").repartition("high").select("high", "gram", "n", i)
    split = split.select("high", "n", F.expr("shiftleft(1L, i) + shiftright(gram & 255, 8 - i)").alias("node"), F.expr("shiftright(gram & 255, 7 - i) & 1").alias("bit"))
    trees = {}
    own = split.groupBy("high", "node").agg(F.sum(F.when(F.col("bit") == 0, F.col("n")).otherwise(0)).alias("n0"), F.sum(F.when(F.col("bit") == 1, F.col("n")).otherwise(0)).alias("n1"))
    trees[depth] = cut(own.select((F.col("high") + F.col("node")).alias("key"), "n0", "n1", log_kt(F.col("n0"), F.col("n1")).alias("lw")))
    one = (F.col("n1") + 0.5) / (F.col("n0") + F.col("n1") + 1)
    for d in range(depth - 1, -1, -1):
        mask = (1 << (8 * d + 8)) - 1
        up = trees[d + 1].groupBy(F.col("key").bitwiseAND(F.lit(mask)).alias("key")).agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"), F.sum("lw").alias("lc"))
        up = up.withColumn("le", log_kt(F.col("n0"), F.col("n1")))
        up = up.withColumn("lw", F.greatest("le", "lc") + F.log(0.5 * (1 + F.exp(-F.abs(F.col("le") - F.col("lc"))))))
        trees[d] = cut(up.select("key", "n0", "n1", "lw", F.least(F.lit(1.0), F.exp(F.col("le") + _HALF - F.col("lw"))).alias("w")))
    # from the root down: p = a + b * (that of the longer context)
    at = trees[0].select("key", (F.col("w") * one).alias("a"), (1 - F.col("w")).alias("b"))
    for d in range(1, depth + 1):
        mask = (1 << (8 * d)) - 1
        here = trees[d].withColumn("up", F.col("key").bitwiseAND(F.lit(mask)))
        w = F.col("w") if d < depth else F.lit(1.0)
        at = here.join(at.withColumnRenamed("key", "up"), "up").select("key", (F.col("a") + F.col("b") * w * one).alias("a"), (F.col("b") * (1 - w)).alias("b"))
    nodes = at.groupBy(_high(F.col("key")).alias("high")).agg(F.map_from_entries(F.collect_list(F.struct(F.col("key").bitwiseAND(F.lit(255)).cast("int").alias("node"), F.col("a").alias("p")))).alias("p"))
    return nodes, [*trees.values()]


def byte_score(gram: Column, p: Column) -> Column:
    """log10 of the probability of a gram's last byte, from its context's nodes."""
    total = F.lit(0.0)
    byte = gram.bitwiseAND(F.lit(255)).cast("int")
    for i in range(8):
        one = F.element_at(p, (F.shiftright(byte, 8 - i) + (1 << i)).cast("int"))
        total = total + F.log10(F.when(F.shiftright(byte, 7 - i).bitwiseAND(F.lit(1)) == 1, one).otherwise(1 - one))
    return total


def _plain(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts as the model reads them, which is what the tokens are: lower-cased words joined by one space."""
    low = FOLD[data]
    _, end, first = spans(low, offsets, NON_SPACE)
    keep = NON_SPACE[low]
    gap = np.ones(len(end), bool)
    gap[first[1:][first[1:] > first[:-1]] - 1] = False  # no space after a text's last word
    low[end[gap]] = 32
    keep[end[gap]] = True
    return low[keep], running(keep)[offsets]


def _grams(data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """The (depth + 1)-gram that ends at each byte and at each text's end, and where each text's begin."""
    data, offsets = _plain(data, offsets)
    n = len(offsets) - 1
    size = np.diff(offsets)
    first = running(size + 1)
    text = np.repeat(np.arange(n), size)
    wide = np.full(first[-1] + depth, MARK, np.uint64)
    wide[depth + np.arange(len(data)) + text] = data
    grams = np.zeros(first[-1], np.uint64)
    for k in range(depth + 1):  # k = 0: the byte itself
        byte = wide[depth - k : depth - k + len(grams)].copy()
        if k:  # nothing is seen of the text before
            for j in range(k):
                at = first[:-1] + j
                byte[at[at < first[1:]]] = MARK
        grams |= byte << np.uint64(8 * k)
    return grams, first


def _tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes of each lower-cased word and of one end of each text, and where each text's begin."""
    low = FOLD[data]
    start, end, first = spans(low, offsets, NON_SPACE)
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    first = first + np.arange(len(first))
    out = []
    for lane in range(2):
        words = np.full(first[-1], END, np.uint64)
        words[np.arange(len(start)) + row] = word_hashes(low, start, end, lane)
        out.append(words)
    return *out, first


def _tally(high: np.ndarray, low: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys of 128 bits, in order, and their sums."""
    order = np.argsort(high)
    a, b = high[order], low[order]
    if ((a[1:] == a[:-1]) & (b[1:] != b[:-1])).any():
        order = np.lexsort((low, high))
        a, b = high[order], low[order]
    at = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.zeros(0, np.int64)
    return a[at], b[at], np.add.reduceat(counts[order], at) if len(at) else counts[:0]


def _tally_grams(grams: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams, in order, and their sums; counts are 0 or 1, so a gram and its count are sorted as one number."""
    both = np.sort(grams << np.uint64(1) | counts.astype(np.uint64))
    keys = both >> np.uint64(1)
    at = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.add.reduceat((both & np.uint64(1)).astype(np.int64), at) if len(at) else np.zeros(0, np.int64)


class Grams:
    """What a shard has of the tree: scores by grams, each of which is there once."""

    def __init__(self, grams: np.ndarray, values: np.ndarray):
        self.at, self.values = Lookup(grams), values

    def find(self, grams: np.ndarray, _: np.ndarray) -> np.ndarray:
        """Scores of grams, all of which are there."""
        k = self.at.find(grams)
        if (k < 0).any():
            raise ValueError("a key that the model doesn't have")
        return self.values[k]


class Slice:
    """What a shard has of the model: values by keys of 128 bits."""

    def __init__(self, high: np.ndarray, low: np.ndarray, values: np.ndarray):
        order = np.lexsort((low, high))
        self.low, self.values = low[order], values[order]
        keys, self.first, self.many = np.unique(high[order], return_index=True, return_counts=True)
        self.at = Lookup(keys)

    def find(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Values of keys, all of which are there."""
        k = self.at.find(high)
        at, past = self.first[k], self.first[k] + self.many[k]
        for _ in range(int(self.many.max(initial=1)) - 1):
            at += (self.low[at] != low) & (at + 1 < past)
        if (k < 0).any() or (self.low[at] != low).any():
            raise ValueError("a key that the model doesn't have")
        return self.values[at]


def score(docs: DataFrame, *, text: str = "text", key: str = "doc_id", carry: Sequence[str] = ("doc_id",), use: Column | None = None, depth: int = 5) -> DataFrame:
    """Each row of `docs` (its `carry` columns) with n_tokens, n_known, train_tokens, base_score, score and bits_per_byte.

    Learns from rows whose crc32(key as text) mod 5 is not 1 (or `use`, a condition on `__key`). Words are lower-cased (A-Z) runs of non-blanks, and
    each text has one end besides. base_score: add-half unigram of these tokens; score: log10 of the tree's probability of the same tokens, as the
    bytes of the words joined by one space, and the end; bits_per_byte: that as a code length over the bytes and the end. Edge cases: a null text is the empty one, which has its end
    only; with nothing to learn from every bit has probability 1/2 and a token log10((0 + 0.5) / (0 + 0.5)) = 0; texts are read whole at any
    length (a shard holds its longest one); repeated rows count and are scored each, whatever ids they repeat; an empty table gives no rows; columns that are not
    carried don't matter, and one named as a result gives way to it.
    """
    if not 1 <= depth <= 6:
        raise ValueError("depth: from 1 to 6")
    ship(docs.sparkSession)
    parts = shards(docs, 8 << 20) | 1  # larger ones share more of their grams and words, and take more memory
    use = crc_fold(F.col("__key"), 5) != 1 if use is None else use
    new = ("n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte")
    carry = [c for c in carry if c not in new]
    read = docs.select(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)).cast("int").alias("__shard"), F.col(f"`{key}`").alias("__key"), F.col(f"`{text}`").alias("__text"), *[F.col(f"`{c}`").alias(f"__c{k}") for k, c in enumerate(carry) if c != text])
    full = dealt(read.withColumn("__learn", F.coalesce(use, F.lit(False))).drop("__key"), "__shard", parts)

    def keys_of(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[bool, np.ndarray, np.ndarray, np.ndarray]]:
        """(of words or not, two halves of each key, where each text's begin)"""
        grams, first = _grams(data, offsets, depth)
        yield False, grams, np.zeros(len(grams), np.uint64), first
        yield True, *_tokens(data, offsets)

    ask_schema = "shard int, word boolean, a long, b long, n long"

    def ask(keys: tuple, table: pa.Table) -> pa.Table:
        learn = table.column("__learn").combine_chunks().to_numpy(zero_copy_only=False).astype(np.int64)
        data, offs = texts_of(table.column("__text"))
        found = {False: [], True: []}
        for i, j in pieces(offs):
            for word, high, low, first in keys_of(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]):
                n = np.repeat(learn[i:j], np.diff(first))
                if word:
                    found[word].append(_tally(high, low, n))
                else:
                    grams, n = _tally_grams(high, n)
                    found[word].append((grams, low[: len(grams)], n))
        out = []
        for word, each in found.items():
            high, low, n = _tally(*(np.concatenate([x[k] for x in each]) for k in range(3)))
            out.append(pa.table([pa.array(np.full(len(n), keys[0].as_py(), np.int32)), pa.array(np.full(len(n), word)), pa.array(high.view(np.int64)), pa.array(low.view(np.int64)), pa.array(n)], names=["shard", "word", "a", "b", "n"]))
        return pa.concat_tables(out)

    asks = cut(full.select("__shard", "__text", "__learn").groupBy("__shard").applyInArrow(tidy(ask), ask_schema))
    of_words, of_grams = asks.where("word"), asks.where("not word")
    alike = Window.partitionBy("a", "b")
    words = cut(of_words.select("shard", "a", "b", "n", F.sum("n").over(alike).alias("total"), F.row_number().over(alike.orderBy("shard")).alias("place")))
    size = words.agg(F.sum("n").alias("n"), F.sum(F.when((F.col("place") == 1) & (F.col("total") > 0), 1)).alias("v")).first()
    n_all, v_all = int(size.n or 0), int(size.v or 0)
    counted = cut(of_grams.groupBy(F.col("a").alias("gram")).agg(F.sum("n").alias("n")))
    nodes, read = context_models(counted, depth)
    asked = of_grams.select("shard", F.col("a").alias("gram"), _high(F.col("a")).alias("high"))
    values = cut(asked.join(nodes.hint("merge"), "high").select("shard", "gram", byte_score(F.col("gram"), F.col("p")).alias("score")))
    drop(asks, counted, *read)
    schema = T.StructType([*[docs.schema[c] for c in carry], *[T.StructField(x, T.LongType() if x.startswith(("n_", "train")) else T.DoubleType()) for x in new]])

    def judge(keys: tuple, table: pa.Table, model: pa.Table) -> pa.Table:
        data, offs = texts_of(table.column("__text"))
        word = model.column("word").combine_chunks().to_numpy(zero_copy_only=False).astype(bool)
        high, low, value = (model.column(c).combine_chunks().to_numpy() for c in ("a", "b", "value"))
        of = {False: Grams(high[~word].view(np.uint64), value[~word]), True: Slice(high[word].view(np.uint64), low[word].view(np.uint64), value[word])}
        out = []
        for i, j in pieces(offs):
            row = []
            for w, a, b, first in keys_of(data[offs[i] : offs[j]], offs[i : j + 1] - offs[i]):
                found = of[w].find(a, b)
                if w:
                    known = running(found > 0)
                    row += [np.diff(first), known[first[1:]] - known[first[:-1]], np.add.reduceat(np.log10((found + 0.5) / (n_all + 0.5 * (v_all + 1))), first[:-1])]
                else:
                    row += [np.add.reduceat(found, first[:-1]), np.diff(first)]
            out.append(row)
        tree, symbols, n_tokens, n_known, plain = (np.concatenate([x[k] for x in out]) for k in range(5)) if out else (np.zeros(0), np.ones(0), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        own = [table.column("__text" if c == text else f"__c{k}") for k, c in enumerate(carry)]
        return pa.table([*own, pa.array(n_tokens), pa.array(n_known), pa.array(np.full(len(tree), n_all)), pa.array(plain), pa.array(tree), pa.array(-tree / math.log10(2) / symbols)], names=schema.names)

    model = words.select("shard", F.lit(True).alias("word"), "a", "b", F.col("total").cast("double").alias("value"))
    model = model.unionByName(values.select("shard", F.lit(False).alias("word"), F.col("gram").alias("a"), F.lit(0).cast("long").alias("b"), F.col("score").alias("value")))
    return full.drop("__learn").groupBy("__shard").cogroup(model.groupBy("shard")).applyInArrow(tidy(judge), schema)
