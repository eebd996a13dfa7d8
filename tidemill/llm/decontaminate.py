"""Benchmark decontamination by winnowing.

A window is `window` consecutive words of a benchmark item; an item of fewer words, but some, is one window. Of every
`window - k + 1` consecutive k-gram hashes the smallest is kept, on both sides. A shared span of `window` words holds such
a group whole, so both sides keep the same k-gram of it; that pair is found by its hash and extended word by word to
both sides. Hence every shared window is found, and a pair that extends to fewer than `window` words is none.

Documents are read once, where they lie, and never shuffled. The benchmark goes to the executors in blocks of at most
`block_words` words, each a broadcast of known size; a larger benchmark takes several passes over the documents. An item of more words
is cut on the executors into pieces that overlap by a window less one word, so no window is lost and no block is larger.
Words are compared by 128 bits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import FOLD, LOWER_ALNUM, Lookup, cut, drop, gram_hashes, map_texts, running, ship, spans, whole, word_hashes

SPAN = T.StructType().add("first", T.LongType()).add("past", T.LongType())
FIELDS = T.StructType().add("n_words", T.LongType(), False).add("hit_spans", T.ArrayType(SPAN), False).add("item_ids", T.ArrayType(T.StringType()), False)


_WORD = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def _words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes of each lower-cased word, and where each text's begin."""
    data = FOLD[data]
    start, end, first = spans(data, offsets, LOWER_ALNUM)
    return word_hashes(data, start, end), word_hashes(data, start, end, 1), first


def overlapping(text: str, words: int, window: int) -> Iterator[str]:
    """Pieces of at most `words` words that hold all windows between them."""
    at = [m.span() for m in _WORD.finditer(text)]
    i = 0
    while i + words < len(at):
        yield text[at[i][0] : at[i + words - 1][1]]
        i += words - window + 1
    if i < len(at):
        yield text[at[i][0] : at[-1][1]]


def kept(grams: np.ndarray, width: int) -> np.ndarray:
    """Which k-grams are the smallest of some `width` consecutive ones (all of them, if several are)."""
    n = len(grams)
    if n < width:
        return np.zeros(n, bool)
    low, have = grams, 1  # low[i]: the smallest of `have` from i
    while have < width:
        step = min(have, width - have)
        low = np.minimum(low[: len(low) - step], low[step:])
        have += step
    high = np.zeros(n + width - 1, np.uint64)  # high[i + width - 1 - j]: the largest of those minima that cover i
    high[width - 1 : width - 1 + len(low)] = low
    have = 1
    while have < width:
        step = min(have, width - have)
        high = np.maximum(high[: len(high) - step], high[step:])
        have += step
    return high == grams


class Index:
    """Fingerprints of one block of benchmark items."""

    def __init__(self, items: Sequence[tuple[str, str]], window: int, k: int):
        self.window, self.k = window, k
        self.ids = sorted({i for i, _ in items})
        number = {x: n for n, x in enumerate(self.ids)}
        texts = [t.encode() for _, t in items]
        data = np.frombuffer(b"".join(texts), np.uint8)
        self.words, self.other, self.first = _words(data, running(np.array([len(t) for t in texts], np.int64)))
        length = np.diff(self.first)
        self.row = np.repeat(np.arange(len(items)), length)
        item = np.array([number[i] for i, _ in items], np.int64)
        grams = gram_hashes(self.words, k)
        use = kept(grams, window - k + 1) & whole(self.first, len(self.words), k) if len(grams) else np.zeros(0, bool)
        at = np.flatnonzero(use)
        at = at[length[self.row[at]] >= window] if len(at) else at
        self.grams, self.begin, self.at = self._grouped(grams[at], at)
        self.item = item
        self.short = {}
        for n in sorted({int(x) for x in length if 0 < x < window}):
            rows = np.flatnonzero(length == n)
            hashes = gram_hashes(self.words, n)[self.first[rows]]
            self.short[n] = self._grouped(hashes, rows)

    @staticmethod
    def _grouped(keys: np.ndarray, values: np.ndarray) -> tuple[Lookup, np.ndarray, np.ndarray]:
        order = np.argsort(keys, kind="stable")
        unique, counts = np.unique(keys, return_counts=True)
        return Lookup(unique), running(counts), values[order]

    def hits(self, words: np.ndarray, other: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(first word, word past the end, number of the item) of matches in a chunk of documents."""
        n, last = len(words), len(self.words) - 1

        def equal(i: np.ndarray, j: np.ndarray) -> np.ndarray:
            i, j = np.clip(i, 0, n - 1), np.clip(j, 0, last)
            return (words[i] == self.words[j]) & (other[i] == self.other[j])

        for size, (lookup, begin, rows) in self.short.items():
            grams = gram_hashes(words, size)
            at = lookup.find(grams)
            at[~whole(first, n, size)] = -1
            p = np.flatnonzero(at >= 0)
            for i, q in _pairs(begin, at[p]):
                row = rows[q]
                same = np.ones(len(i), bool)
                for d in range(size):
                    same &= equal(p[i] + d, self.first[row] + d)
                yield p[i[same]], p[i[same]] + size, self.item[row[same]]
        if not len(self.at) or n < self.window:
            return
        grams = gram_hashes(words, self.k)
        p = np.flatnonzero(kept(grams, self.window - self.k + 1))
        found = self.grams.find(grams[p])
        p, found = p[found >= 0], found[found >= 0]
        doc = np.searchsorted(first, p, "right") - 1
        reach = self.window - self.k
        for i, j in _pairs(self.begin, found):
            at, q = p[i], self.at[j]
            begin, past = first[doc[i]], first[doc[i] + 1]
            row = self.row[q]
            lo, hi = self.first[row], self.first[row + 1]
            ok = (at + self.k <= past) & (q + self.k <= hi)
            for d in range(self.k):
                ok &= equal(at + d, q + d)
            left, right = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
            go = ok.copy()
            for d in range(1, reach + 1):
                go &= (at - d >= begin) & (q - d >= lo)
                go &= equal(at - d, q - d)
                left += go
            go = ok.copy()
            for d in range(self.k, self.window):
                go &= (at + d < past) & (q + d < hi)
                go &= equal(at + d, q + d)
                right += go
            ok &= left + self.k + right >= self.window
            yield (at - left)[ok], (at + self.k + right)[ok], self.item[row[ok]]


def _pairs(begin: np.ndarray, found: np.ndarray, limit: int = 1 << 18) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) for each i of `found` and each j of its group, in blocks of about `limit`."""
    many = begin[found + 1] - begin[found]
    total = running(many)
    i = 0
    while i < len(found):
        j = max(i + 1, int(np.searchsorted(total, total[i] + limit, "right")) - 1)
        left = np.repeat(np.arange(i, j), many[i:j])
        yield left, np.repeat(begin[found[i:j]], many[i:j]) + np.arange(len(left)) - np.repeat(total[i:j] - total[i], many[i:j])
        i = j


def _scan(docs: DataFrame, text: str, carry: Sequence[str], index, more: bool) -> DataFrame:
    """One block's matches, added to those that earlier blocks left in hit_spans and item_ids."""

    def make():
        ix: Index = index.value

        def work(data: np.ndarray, offsets: np.ndarray, rows: pa.RecordBatch) -> list[pa.Array]:
            words, other, first = _words(data, offsets)
            edge = np.zeros(len(words) + 1, np.int64)
            pairs = [np.zeros(0, np.int64)]
            for a, b, item in ix.hits(words, other, first):
                np.add.at(edge, a, 1)
                np.add.at(edge, b, -1)
                doc = np.searchsorted(first, a, "right") - 1
                pairs.append(np.unique(doc * len(ix.ids) + item))
            pairs = np.unique(np.concatenate(pairs))
            doc, item = pairs // max(1, len(ix.ids)), pairs % max(1, len(ix.ids))
            names: list[list[str]] = [[] for _ in range(len(first) - 1)]
            for d, i in zip(doc.tolist(), item.tolist(), strict=True):
                names[d].append(ix.ids[i])
            if more:
                for d, (old, ids) in enumerate(zip(rows.column("__spans").to_pylist(), rows.column("__items").to_pylist(), strict=True)):
                    names[d] = sorted({*names[d], *ids})
                    for x in old:
                        edge[first[d] + x["first"]] += 1
                        edge[first[d] + x["past"]] -= 1
            hit = np.cumsum(edge)[:-1] > 0
            lead = hit.copy()
            lead[1:] &= ~hit[:-1]
            starts = first[:-1][first[:-1] < len(hit)]
            lead[starts] = hit[starts]
            a = np.flatnonzero(lead)
            total = running(hit)
            # a run ends at the next word that isn't hit, or at its document's end
            miss = np.append(np.flatnonzero(~hit), len(hit))
            home = np.searchsorted(first, a, "right") - 1
            b = np.minimum(miss[np.searchsorted(miss, a)], first[home + 1]) if len(a) else a
            del total
            runs = pa.StructArray.from_arrays([pa.array(a - first[home]), pa.array(b - first[home])], ["first", "past"])
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(a, first).astype(np.int32)), runs)
            return [pa.array(np.diff(first)), lists, pa.array(names, pa.list_(pa.string()))]

        return work

    return map_texts(docs, text, carry, FIELDS, make)


def decontaminate(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text", carry: Sequence[str] = ("doc_id",), window: int = 13, k: int = 5, block_words: int = 1_000_000) -> DataFrame:
    """Each row of `docs` (its `carry` columns) with n_words, n_hit, hit_spans (runs of hit words), n_items and item_ids.

    Edge cases: a null or wordless text has no words and no hits; items without an id, or without words, are left out, and items that
    share an id count once; repeated documents are judged each by itself; an empty benchmark hits nothing; an empty `docs` gives no rows;
    other columns of either table are ignored unless carried, and a carried column named as a result gives way to it.
    """
    if not 0 < k <= window:
        raise ValueError("0 < k <= window")
    rows = benchmark.select(F.col(f"`{item_id}`").cast("string").alias("i"), F.col(f"`{item_text}`").alias("t")).where("i is not null and t is not null")
    ship(docs.sparkSession)
    most = max(block_words // 4, 2 * window)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = b.column(1).cast(pa.binary() if pa.types.is_string(b.column(1).type) else pa.large_binary()).to_pylist()
            out = [(i, x) for i, t in zip(b.column(0).to_pylist(), raw, strict=True) for x in overlapping(t.decode("utf-8", "replace"), most, window)]
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.string()) for k in range(2)], names=["i", "t"])

    rows = rows.mapInArrow(split, "i string, t string")

    def blocks() -> Iterator[list[tuple[str, str]]]:
        block, size = [], 0
        for r in rows.toLocalIterator():
            if block and size + len(r.t) > 6 * block_words:
                yield block
                block, size = [], 0
            block.append((r.i, r.t))
            size += len(r.t)
        yield block

    out, more = None, False
    last, todo = None, blocks()
    block = next(todo)
    while block is not None:
        last = next(todo, None)
        index = docs.sparkSession.sparkContext.broadcast(Index(block, window, k))
        if last is None:
            out = _scan(docs, text, carry, index, more)
        else:  # a further pass follows: the matches so far travel with the texts
            out = _scan(docs, text, [*dict.fromkeys([*carry, text, *(["__spans", "__items"] if more else [])])], index, more)
            before, docs = docs, cut(out.drop("n_words", "__spans", "__items").withColumnsRenamed({"hit_spans": "__spans", "item_ids": "__items"}))
            index.destroy()
            if more:
                drop(before)
            more = True
            carry = [*dict.fromkeys([*carry, "__spans", "__items"])]
        block = last
    count = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda s, x: s + x["past"] - x["first"])
    return out.drop("__spans", "__items").withColumns({"n_hit": count, "n_items": F.size("item_ids").cast("long"), "item_ids": F.array_sort("item_ids")})
