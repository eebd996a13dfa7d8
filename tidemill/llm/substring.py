"""Removal of word passages that an earlier document has, by fixed-block anchors.

Every document is a reference: its non-overlapping blocks of `block` words are indexed. Every document is also probed with all its
rolling runs of `block` words. A run of `window` = 2 * block - 1 words holds a whole block wherever it begins, so two documents
that share a window share an anchor, and all windows around anchors, that is the maximal repeats they extend to, are compared whole.

Documents are dealt once, row by row and so whatever their keys, to shards of bounded size, into a table in buckets that all later steps read
without moving a text again. A shard sends its distinct anchors, not its texts, to the parts of the hash space (a few bytes each, once a shard
however often they occur, and only to parts that it has some for), and gets one bit back for each: met elsewhere or not. Then it sends the hash and the
smallest doc_id of each window around a met anchor, and learns which of them begin in a document with a smaller doc_id. What a passage
costs is one entry a shard, so passages that a third of all documents have cost no more than others. Nothing is capped or sampled.
Windows are compared by 96 bits of hash; anchors by 32 bits beside their part, and these only choose what to compare.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import NON_SPACE, cut, dealt, drop, gram_hashes, pieces, running, shards, ship, spans, texts_of, tidy, whole, word_hashes

_LAST = np.iinfo(np.int64).max


class Shard:
    """Word hashes of a shard's documents, in the order of their ids; a null id comes last."""

    def __init__(self, ids: pa.ChunkedArray, text: pa.ChunkedArray, window: int):
        own = ids.combine_chunks().fill_null(_LAST).to_numpy(zero_copy_only=False).astype(np.int64)
        self.order = np.argsort(own, kind="stable")
        text = text.take(pa.array(self.order)).combine_chunks() if len(own) else text
        self.ids = own[self.order]
        self.data, self.offsets = texts_of(text)
        hashes, others, firsts, starts, ends, base = [], [], [np.zeros(1, np.int64)], [], [], 0
        for i, j in pieces(self.offsets):
            at = self.offsets[i]
            part = self.data[at : self.offsets[j]]
            start, end, first = spans(part, self.offsets[i : j + 1] - at, NON_SPACE)
            hashes.append(word_hashes(part, start, end))
            others.append(word_hashes(part, start, end, 1))
            starts.append(start + at)
            ends.append(end + at)
            firsts.append(first[1:] + base)
            base += len(start)
        none = np.zeros(0, np.int64)
        self.words, self.others = (np.concatenate([np.zeros(0, np.uint64), *h]) for h in (hashes, others))
        self.start, self.end = np.concatenate([none, *starts]), np.concatenate([none, *ends])
        self.first = np.concatenate(firsts)
        self.doc = np.repeat(np.arange(len(own)), np.diff(self.first))
        self.window = window
        self.valid = whole(self.first, len(self.words), window) if len(self.words) >= window else np.zeros(0, bool)

    def anchors(self, block: int, parts: int) -> np.ndarray:
        """For each run of `block` words that a window holds: part, 32 bits of its hash and, lowest, if it is a block. All ones for other runs."""
        grams = gram_hashes(self.words, block)
        size = np.diff(self.first)
        place = np.arange(len(grams)) - self.first[self.doc[: len(grams)]]
        ok = whole(self.first, len(self.words), block) & (size[self.doc[: len(grams)]] >= self.window)
        key = ((grams % np.uint64(parts)) << np.uint64(32)) | (grams >> np.uint64(32))
        return np.where(ok, (key << np.uint64(1)) | (place % block == 0).astype(np.uint64), np.uint64((1 << 64) - 1))

    def windows(self, at: np.ndarray) -> Windows:
        """Hashes of the windows that begin at these words."""
        return Windows(gram_hashes(self.words, self.window)[at], gram_hashes(self.others, self.window, 1)[at].astype(np.uint32))


class Windows:
    """Hashes of 64 and 32 bits, grouped: `order` sorts them stably, `head` tells where in that order another one begins."""

    def __init__(self, high: np.ndarray, low: np.ndarray):
        self.high, self.low = high, low
        self.order = np.argsort(high, kind="stable")
        a, b = high[self.order], low[self.order]
        if ((a[1:] == a[:-1]) & (b[1:] != b[:-1])).any():
            self.order = np.lexsort((low, high))
            a, b = high[self.order], low[self.order]
        head = np.ones(len(a), bool)
        head[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        self.head = np.flatnonzero(head)
        self.group = np.cumsum(head) - 1

    def first(self) -> np.ndarray:
        """Where each distinct one occurs first."""
        return self.order[self.head]

    def shared(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        """Which distinct ones are among these others, which are distinct themselves."""
        order = np.lexsort((low, high))
        high, low = high[order], low[order]
        a, b = self.high[self.first()], self.low[self.first()]
        at, past = np.searchsorted(high, a), np.searchsorted(high, a, "right")
        out = np.zeros(len(a), bool)
        for k in range(int((past - at).max(initial=0))):
            there = at + k < past
            out[there] |= low[at[there] + k] == b[there]
        return out


def _entries(tagged: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct anchors in order, which of them are blocks, which occur more than once."""
    tagged = np.sort(tagged[tagged != np.uint64((1 << 64) - 1)])
    key = tagged >> np.uint64(1)
    last = np.ones(len(key), bool)
    last[:-1] = key[1:] != key[:-1]
    at = np.flatnonzero(last)
    return key[at], (tagged[at] & np.uint64(1)) > 0, np.diff(at, prepend=-1) > 1


def _by_part(part: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(part, from, to) of ordered parts."""
    edge = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *edge.tolist()], [*edge.tolist(), len(part)], strict=True):
        if b > a:
            yield int(part[a]), a, b


def dedup(docs: DataFrame, *, text: str = "text", key: str = "doc_id", carry: Sequence[str] = ("doc_id",), window: int = 13) -> DataFrame:
    """Each row of `docs` (its `carry` columns) with n_words, n_removed, `kept`, the words that stay joined by one space, and `spans`.

    A word goes if a window of `window` words that covers it also begins in a document with a smaller doc_id; windows are judged on the
    input. `spans` are the maximal runs (first word, word past the end) of words that go: the repeats to which the hits extend. Edge cases: a null or blank text has no words; a document of fewer words than a window loses none; a null doc_id counts as larger than
    all others, and rows of one doc_id don't judge each other; texts are read whole at any length (a shard holds its longest document); an empty
    table gives no rows; columns that are not carried don't matter, and one named as a result gives way to it.
    """
    if window % 2 == 0 or window < 3:
        raise ValueError("window: an odd number from 3 on")
    block, parts = (window + 1) // 2, shards(docs)
    ship(docs.sparkSession)
    new = {"n_words", "n_removed", "kept", "spans"}
    carry = [c for c in carry if c not in new]
    # the texts move once; what is carried besides comes along
    shard: Column = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)).cast("int")
    own = docs.select(shard.alias("__shard"), F.col(f"`{key}`").cast("long").alias("__id"), F.col(f"`{text}`").alias("__text"), *[F.col(f"`{c}`").alias(f"__c{k}") for k, c in enumerate(carry) if c != text])
    full = dealt(own, "__shard", parts // 4)
    base = full.select("__shard", "__id", "__text")
    message = "shard int, part int, body binary"
    names = ["shard", "part", "body"]

    def rows(shard: int, out: list[tuple[int, bytes]]) -> pa.Table:
        return pa.table([pa.array([shard] * len(out), pa.int32()), pa.array([p for p, _ in out], pa.int32()), pa.array([b for _, b in out], pa.binary())], names=names)

    def ask_anchors(keys: tuple, table: pa.Table) -> pa.Table:
        s = Shard(table.column("__id"), table.column("__text"), window)
        found, is_block, more = _entries(s.anchors(block, parts))
        low = found.astype("<u4").view(np.uint8).reshape(-1, 4)  # in order, so planes of high bytes pack well
        return rows(keys[0].as_py(), [(p, low[a:b].T.tobytes() + np.packbits(np.concatenate([is_block[a:b], more[a:b]])).tobytes()) for p, a, b in _by_part(found >> np.uint64(32))])

    def answer_anchors(keys: tuple, table: pa.Table) -> pa.Table:
        bodies, all_low, all_flags = table.column("body").to_pylist(), [], []
        for body in bodies:
            n = len(body) * 4 // 17  # 34 bits an entry, and up to 7 to fill the last byte
            all_low.append(np.ascontiguousarray(np.frombuffer(body, np.uint8, 4 * n).reshape(4, n).T).view("<u4").ravel())
            all_flags.append(np.unpackbits(np.frombuffer(body, np.uint8, -1, 4 * n))[: 2 * n].reshape(2, n))
        both = np.sort((np.concatenate(all_low).astype(np.uint64) << np.uint64(2)) | np.concatenate([(f[0] << 1) | f[1] for f in all_flags]).astype(np.uint64))
        low = both >> np.uint64(2)
        at = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
        times = np.diff(np.append(at, len(low))) + np.add.reduceat((both & np.uint64(1)).astype(np.int64), at)
        is_block = np.maximum.reduceat(both & np.uint64(2), at) > 0
        met = low[at][(times > 1) & is_block].astype(np.uint32)
        out, ids = [], table.column("shard").to_pylist()
        for i, own in enumerate(all_low):
            bits = np.zeros(len(own), bool)
            if len(met):
                where = np.minimum(np.searchsorted(met, own), len(met) - 1)
                bits = met[where] == own
            if bits.any():
                out.append((ids[i], np.packbits(bits).tobytes()))
        return pa.table([pa.array([i for i, _ in out], pa.int32()), pa.array([keys[0].as_py()] * len(out), pa.int32()), pa.array([b for _, b in out], pa.binary())], names=names)

    def ask_windows(keys: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows or not replies.num_rows:
            return rows(0, [])
        s = Shard(table.column("__id"), table.column("__text"), window)
        tagged = s.anchors(block, parts)
        found, _, _ = _entries(tagged)
        bits = dict(zip(replies.column("part").to_pylist(), replies.column("body").to_pylist(), strict=True))
        met = np.zeros(len(found), bool)
        for p, a, b in _by_part(found >> np.uint64(32)):
            if p in bits:
                met[a:b] = np.unpackbits(np.frombuffer(bits[p], np.uint8))[: b - a] > 0
        found, runs = found[met], tagged >> np.uint64(1)
        hit = np.zeros(len(runs), bool)
        if len(found):
            hit = found[np.minimum(np.searchsorted(found, runs), len(found) - 1)] == runs
        count = running(hit)
        n = len(s.valid)
        near = s.valid & (count[window - block + 1 :][:n] > count[:n])
        at = np.flatnonzero(near)
        w = s.windows(at)
        first = w.first()  # documents are in the order of their ids
        high, low, least = w.high[first], w.low[first], s.ids[s.doc[at[first]]]
        part = high % np.uint64(parts)
        order = np.argsort(part, kind="stable")
        high, low, least, part = high[order], low[order], least[order], part[order]
        least = least.astype(np.uint32) if len(least) and least.min() >= 0 and least.max() < 1 << 32 else least
        return rows(table.column("__shard")[0].as_py(), [(p, bytes([least.itemsize]) + high[a:b].tobytes() + low[a:b].tobytes() + least[a:b].tobytes()) for p, a, b in _by_part(part)])

    def answer_windows(keys: tuple, table: pa.Table) -> pa.Table:
        ids, bodies, each = table.column("shard").to_pylist(), table.column("body").to_pylist(), []
        for body in bodies:  # a byte says how wide the ids are
            n = (len(body) - 1) // (12 + body[0])
            each.append((np.frombuffer(body, np.uint64, n, 1), np.frombuffer(body, np.uint32, n, 1 + 8 * n), np.frombuffer(body, np.uint32 if body[0] == 4 else np.int64, n, 1 + 12 * n).astype(np.int64)))
        w = Windows(np.concatenate([h for h, _, _ in each]), np.concatenate([x for _, x, _ in each]))
        least = np.concatenate([d for _, _, d in each])
        late = np.empty(len(least), bool)
        late[w.order] = np.minimum.reduceat(least[w.order], w.head)[w.group] < least[w.order]
        out, at = [], 0
        for i, (high, low, _) in zip(ids, each, strict=True):
            bad = late[at : at + len(high)]
            at += len(high)
            if bad.any():
                out.append((i, high[bad].tobytes() + low[bad].tobytes()))
        return pa.table([pa.array([i for i, _ in out], pa.int32()), pa.array([keys[0].as_py()] * len(out), pa.int32()), pa.array([b for _, b in out], pa.binary())], names=names)

    by_shard = base.groupBy("__shard")
    met = cut(by_shard.applyInArrow(tidy(ask_anchors), message).groupBy("part").applyInArrow(tidy(answer_anchors), message))
    late = cut(by_shard.cogroup(met.groupBy("shard")).applyInArrow(tidy(ask_windows), message).groupBy("part").applyInArrow(tidy(answer_windows), message))
    drop(met)
    run = T.StructType().add("first", T.LongType()).add("past", T.LongType())
    schema = T.StructType([*[docs.schema[c] for c in carry], T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType()), T.StructField("spans", T.ArrayType(run))])

    def strip(keys: tuple, table: pa.Table, replies: pa.Table) -> pa.Table:
        s = Shard(table.column("__id"), table.column("__text"), window)
        n = len(s.words)
        go = np.zeros(n, bool)
        at = np.flatnonzero(s.valid)
        if len(at):
            w = s.windows(at)
            own = s.ids[s.doc[at]]
            bad = np.empty(len(at), bool)
            late = own[w.first()][w.group] < own[w.order]
            if replies.num_rows:
                away = [(np.frombuffer(b, np.uint64, len(b) // 12), np.frombuffer(b, np.uint32, len(b) // 12, len(b) // 12 * 8)) for b in replies.column("body").to_pylist()]
                late |= w.shared(np.concatenate([h for h, _ in away]), np.concatenate([x for _, x in away]))[w.group]
            bad[w.order] = late
            edge = np.zeros(n + 1, np.int64)
            np.add.at(edge, at[bad], 1)
            np.add.at(edge, at[bad] + window, -1)
            go = np.cumsum(edge)[:-1] > 0
        kept, removed = [], running(go)
        for i, j in pieces(s.offsets):
            a, b = s.first[i], s.first[j]
            stay = np.flatnonzero(~go[a:b]) + a
            length = s.end[stay] - s.start[stay] + 1
            place = running(length)
            take = np.repeat(s.start[stay] - place[:-1], length) + np.arange(place[-1])
            out = s.data[np.minimum(take, len(s.data) - 1)] if len(take) else np.zeros(0, np.uint8)
            out[place[1:] - 1] = 32
            ends = place[np.searchsorted(stay, s.first[i : j + 1])].tolist()
            raw = out.tobytes()
            kept += [raw[x : max(x, y - 1)] for x, y in zip(ends, ends[1:])]  # noqa: B905
        lead, last = go.copy(), go.copy()
        lead[1:] &= ~go[:-1] | (s.doc[1:] != s.doc[:-1])
        last[:-1] &= ~go[1:] | (s.doc[1:] != s.doc[:-1])
        lead, last = np.flatnonzero(lead), np.flatnonzero(last)
        home = s.first[s.doc[lead]]
        runs = pa.StructArray.from_arrays([pa.array(lead - home), pa.array(last + 1 - home)], ["first", "past"])
        spans = pa.ListArray.from_arrays(pa.array(np.searchsorted(lead, s.first).astype(np.int32)), runs)
        back = pa.array(s.order)
        own = [table.column("__text" if c == text else f"__c{k}").take(back) for k, c in enumerate(carry)]
        return pa.table([*own, pa.array(np.diff(s.first)), pa.array(removed[s.first[1:]] - removed[s.first[:-1]]), pa.array(kept, pa.binary()).cast(pa.string()), spans], names=schema.names)

    return full.groupBy("__shard").cogroup(late.groupBy("shard")).applyInArrow(tidy(strip), schema)
