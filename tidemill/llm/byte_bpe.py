"""Byte-level BPE, encoding and decoding, with a two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary resolves every pre-token that is itself a token; all pre-tokens of a chunk
are hashed and compared byte for byte at once. Tier two: the rest is merged with a heap over linked bytes;
a bounded table keeps what was merged.
"""

from __future__ import annotations

import base64
from collections.abc import Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.bpe import SHIFT, merged
from tidemill.llm.common import KEEP, map_texts, mix, running, ship, word_hashes

FIELDS = T.StructType().add("ids", T.ArrayType(T.IntegerType()), False).add("decoded", T.BinaryType(), False)


def read_ranks(path: str) -> dict[bytes, int]:
    """A .tiktoken file: base64 of a token's bytes and its id on each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


class PerfectHash:
    """n 64-bit keys to n slots, without a gap: a key's group has a displacement that sends all its keys to slots of their own."""

    def __init__(self, keys: np.ndarray):
        n = self.n = len(keys)
        if len(np.unique(keys)) != n:
            raise ValueError("two keys are the same")
        self.groups = max(1, n // 3)
        group = (keys % np.uint64(self.groups)).astype(np.int64)
        self.shift = np.zeros(self.groups, np.uint64)
        order = np.argsort(group, kind="stable")
        begin = running(np.bincount(group, minlength=self.groups))
        taken = np.zeros(n, bool)
        tries = np.arange(1, 513, dtype=np.uint64)
        for g in np.argsort(-np.diff(begin), kind="stable"):
            own = keys[order[begin[g] : begin[g + 1]]]
            if not len(own):
                break
            base = 0
            while True:  # 512 displacements at a time
                d = tries + np.uint64(base)
                slots = self._slots(own[:, None], d[None, :])
                free = ~taken[slots].any(axis=0)
                if len(own) > 1:
                    s = np.sort(slots, axis=0)
                    free &= (s[1:] != s[:-1]).all(axis=0)
                if free.any():
                    k = int(np.argmax(free))
                    self.shift[g] = d[k]
                    taken[slots[:, k]] = True
                    break
                base += len(tries)

    def _slots(self, keys: np.ndarray, shift: np.ndarray) -> np.ndarray:
        return (mix(keys + shift * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(self.n)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """A slot for any key; its own for each key of the set."""
        return self._slots(keys, self.shift[(keys % np.uint64(self.groups)).astype(np.int64)])


def _packed(padded: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first 8 and the next 8 bytes of each piece; `padded` has 16 bytes to spare."""
    wide = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))
    return wide[start] & KEEP[np.minimum(length, 8)], wide[np.minimum(start + 8, len(wide) - 1)] & KEEP[np.clip(length - 8, 0, 8)]


class Merged:
    """Ids of pre-tokens of at most 16 bytes that were merged before, by their hash and compared byte for byte. Bounded: it starts anew when full."""

    def __init__(self, most: int = 1 << 20):
        self.most = most
        self.clear(1 << 14)

    def clear(self, slots: int) -> None:
        self.mask = slots - 1
        self.key, self.lo, self.hi = (np.zeros(slots, np.uint64) for _ in range(3))
        self.size, self.begin = np.zeros(slots, np.uint8), np.zeros(slots, np.int64)  # bytes of the piece, 0 for a free slot; where its ids begin
        self.many = np.zeros(slots, np.uint8)
        self.pool, self.used, self.entries = np.zeros(4 * slots, np.int32), 0, 0

    def find(self, key: np.ndarray, lo: np.ndarray, hi: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Slots, -1 for what isn't there."""
        out, left = np.full(len(key), -1, np.int64), np.arange(len(key))
        at = (key & np.uint64(self.mask)).astype(np.int64)
        while len(left):
            held = self.size[at]
            same = (held == size[left]) & (self.key[at] == key[left]) & (self.lo[at] == lo[left]) & (self.hi[at] == hi[left])
            out[left[same]] = at[same]
            go = ~same & (held > 0)
            left, at = left[go], (at[go] + 1) & self.mask
        return out

    def add(self, key: np.ndarray, lo: np.ndarray, hi: np.ndarray, size: np.ndarray, many: np.ndarray, ids: np.ndarray) -> None:
        """Different pieces that aren't there yet; ids: of all of them, one after the other."""
        if self.entries + len(key) > self.most:
            self.clear(self.mask + 1)
        while 2 * (self.entries + len(key)) > self.mask:
            full = np.flatnonzero(self.size)
            old = [x[full] for x in (self.key, self.lo, self.hi, self.size, self.many, self.begin)]
            pool, used, entries = self.pool, self.used, self.entries
            self.clear(2 * (self.mask + 1))
            self.pool[:used] = pool[:used]
            self.used, self.entries = used, entries
            self._put(*old)
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.zeros(self.used + 4 * len(ids), np.int32)])
        self.pool[self.used : self.used + len(ids)] = ids
        self._put(key, lo, hi, size.astype(np.uint8), many.astype(np.uint8), self.used + running(many)[:-1])
        self.used += len(ids)
        self.entries += len(key)

    def _put(self, key, lo, hi, size, many, begin) -> None:
        left, at = np.arange(len(key)), (key & np.uint64(self.mask)).astype(np.int64)
        while len(left):
            free = np.flatnonzero(self.size[at] == 0)
            _, first = np.unique(at[free], return_index=True)  # one for each slot
            won = free[first]
            i, j = left[won], at[won]
            self.key[j], self.lo[j], self.hi[j], self.size[j], self.many[j], self.begin[j] = key[i], lo[i], hi[i], size[i], many[i], begin[i]
            stay = np.ones(len(left), bool)
            stay[won] = False
            left, at = left[stay], (at[stay] + 1) & self.mask


class Codec:
    """Vocabulary, its perfect hash and the tables for decoding. Built once on the driver."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = pattern
        tokens = sorted(ranks, key=ranks.get)
        self.ranks = ranks
        length = np.array([len(t) for t in tokens], np.int64)
        blob = np.frombuffer(b"".join(tokens) + bytes(16), np.uint8)
        start = running(length)[:-1]
        keys = word_hashes(blob, start, start + length)
        self.hash = PerfectHash(keys)
        at = np.empty(len(tokens), np.int64)
        at[self.hash.slots(keys)] = np.arange(len(tokens))
        lo, hi = _packed(blob, start, length)
        self.lo, self.hi, self.length = lo[at], hi[at], length[at]
        self.id = np.array([ranks[t] for t in tokens], np.int64)[at]
        most = max(ranks.values()) + 1
        self.blob = blob
        self.begin, self.size = np.zeros(most, np.int64), np.full(most, -1, np.int64)
        ids = np.array([ranks[t] for t in tokens])
        self.begin[ids], self.size[ids] = start, length
        self.single = [ranks[bytes([b])] for b in range(256)]
        # every way in which a token is made of two
        self.pairs = {ranks[t[:k]] << SHIFT | ranks[t[k:]]: i for t, i in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks}

    def ready(self) -> Codec:
        """With what a task needs besides."""
        import regex

        self.find = regex.compile(self.pattern).findall
        get, single, made = self.pairs.get, self.single, range(len(self.size))
        self.merge = lambda piece: merged([single[b] for b in piece], get, made)
        self.known = Merged()
        return self

    def split(self, raw: bytes) -> np.ndarray:
        """Ends of the pre-tokens of one text, in bytes."""
        text = raw.decode("utf-8", "replace")
        found = self.find(text)
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        if len(text) == len(raw):
            return ends
        starts = np.append(np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80), len(raw))
        return starts[ends]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a chunk and where each text's begin."""
        raw, at = data.tobytes(), offsets.tolist()
        ends = [self.split(raw[a:b]) + a for a, b in zip(at, at[1:])]  # noqa: B905
        texts = running(np.array([len(e) for e in ends], np.int64))
        end = np.concatenate(ends) if ends else np.zeros(0, np.int64)
        start = np.empty_like(end)
        if len(end):  # pre-tokens cover a text without a gap, and texts follow one another
            start[0], start[1:] = 0, end[:-1]
        length = end - start
        padded = np.frombuffer(raw + bytes(16), np.uint8)
        lo, hi = _packed(padded, start, length)
        hashes = word_hashes(data, start, end)
        slot = self.hash.slots(hashes)
        ok = (self.length[slot] == length) & (self.lo[slot] == lo) & (self.hi[slot] == hi)
        for i in np.flatnonzero(ok & (length > 16)).tolist():  # the rest of a long one
            ok[i] = self.ranks.get(raw[start[i] : end[i]]) is not None
        count = np.ones(len(end), np.int64)
        miss = np.flatnonzero(~ok)
        short, long = miss[length[miss] <= 16], miss[length[miss] > 16]
        # short ones: each distinct one is looked up, and merged, once
        key, first, which = np.unique(hashes[short], return_index=True, return_inverse=True)
        one = short[first]
        odd = (lo[short] != lo[one][which]) | (hi[short] != hi[one][which]) | (length[short] != length[one][which])
        if odd.any():  # two pieces with one hash
            long, short, which = np.concatenate([long, short[odd]]), short[~odd], which[~odd]
        known = self.known
        fresh = np.flatnonzero(known.find(key, lo[one], hi[one], length[one]) < 0)
        merge = self.merge
        if len(fresh):
            i = one[fresh]
            lists = [merge(raw[a:b]) for a, b in zip(start[i].tolist(), end[i].tolist(), strict=True)]
            many = np.fromiter(map(len, lists), np.int64, len(lists))
            if known.entries + len(fresh) > known.most:  # it starts anew: what this chunk needs of the old goes in again
                fresh = np.arange(len(key))
                i = one
                lists = [merge(raw[a:b]) for a, b in zip(start[i].tolist(), end[i].tolist(), strict=True)]
                many = np.fromiter(map(len, lists), np.int64, len(lists))
            known.add(key[fresh], lo[i], hi[i], length[i], many, np.fromiter(chain.from_iterable(lists), np.int32, int(many.sum())))
        slots = known.find(key, lo[one], hi[one], length[one])[which]
        count[short] = known.many[slots]
        lists = [merge(raw[a:b]) for a, b in zip(start[long].tolist(), end[long].tolist(), strict=True)]
        count[long] = np.fromiter(map(len, lists), np.int64, len(lists))
        place = running(count)
        ids = np.empty(place[-1], np.int32)
        ids[place[:-1][ok]] = self.id[slot[ok]]
        if len(short):
            many = count[short]
            total = running(many)
            step = np.arange(total[-1])
            ids[np.repeat(place[short] - total[:-1], many) + step] = known.pool[np.repeat(known.begin[slots] - total[:-1], many) + step]
        for i, x in zip(long.tolist(), lists, strict=True):
            ids[place[i] : place[i + 1]] = x
        return ids, place[texts]

    def decode(self, ids: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all texts and where each text's begin. An unknown id is an error."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.size) or (self.size[ids] < 0).any()):
            raise ValueError("an id that the vocabulary doesn't have")
        size = self.size[ids]
        place = running(size)
        out = self.blob[np.repeat(self.begin[ids] - place[:-1], size) + np.arange(place[-1])]
        return out, place[first]


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def encode(docs: DataFrame, vocabulary_path: str, pattern: str, *, text: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Each row of `docs` (its `carry` columns) with `ids` of its whole text, and `decoded`, the bytes that those ids stand for.

    Edge cases: a null or empty text has no ids and decodes to no bytes; a pre-token of any length is merged in n log n steps; repeated rows are
    encoded each; an empty table gives no rows; columns that are not carried don't matter, and one named as a result gives way to it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Codec(read_ranks(vocabulary_path), pattern))

    def make():
        codec = shared.value.ready()

        def work(data: np.ndarray, offsets: np.ndarray, rows: pa.RecordBatch) -> list[pa.Array]:
            ids, first = codec.encode(data, offsets)
            return [pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids)), _binary(*codec.decode(ids, first))]

        return work

    return map_texts(docs, text, carry, FIELDS, make, limit=1 << 19)


def decode(df: DataFrame, vocabulary_path: str, *, ids: str = "ids", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Each row of `df` (its `carry` columns) with `decoded`, the bytes of its `ids`; a null or empty array decodes to none, an unknown id is an error."""
    ship(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(Codec(read_ranks(vocabulary_path), "."))
    source = df.select(*[F.col(f"`{c}`") for c in carry if c != "decoded"], F.coalesce(F.col(f"`{ids}`").cast("array<int>"), F.array().cast("array<int>")).alias("__ids"))
    schema = T.StructType([*source.schema.fields[:-1], T.StructField("decoded", T.BinaryType(), False)])

    def run(batches):
        codec = shared.value
        for b in batches:
            column = b.column(b.num_columns - 1)
            flat = column.flatten()
            if flat.null_count:
                raise ValueError("a null id")
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], _binary(*codec.decode(flat.to_numpy(), running(column.value_lengths().to_numpy())))], names=schema.names)

    return source.mapInArrow(run, schema)


__all__ = ["Codec", "PerfectHash", "decode", "encode", "read_ranks"]
