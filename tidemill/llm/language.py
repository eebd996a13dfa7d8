"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. A letter trigram's vector binds (multiplies) the first
letter's vector permuted twice, the second's permuted once and the third's as it is. A document's vector bundles (adds) its trigrams, a
language's prototype bundles those of its documents, and a document takes the language of the nearest prototype by cosine.
Signs are kept as bits: binding is exclusive or, and a permutation is a rotation.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import crc_fold, map_texts, mix, ship

UNKNOWN = "und"
#: Bytes of a long text, and distinct trigrams, that are looked at together.
PIECE, BLOCK = 1 << 18, 4096


def letter_table() -> np.ndarray:
    """For each code point its lower-case letter, or 0 where it is none."""
    table = np.zeros(0x110000, np.int32)
    for c in (*range(0xD800), *range(0xE000, 0x110000)):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low[0]) if low[0].isalpha() else c
    return table


def vectors(symbols: np.ndarray, turn: int, dim: int) -> np.ndarray:
    """Packed random vectors of symbols, rotated by `turn` places."""
    words = mix(symbols.astype(np.uint64)[:, None] * np.uint64(0xD1B54A32D192ED03) + np.arange(1, dim // 64 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    bits = np.unpackbits(words.view(np.uint8), axis=1)
    return np.packbits(np.roll(bits, turn, axis=1), axis=1)


class Trigrams:
    """Trigram counts of texts, over lower-case letters with one space between words."""

    def __init__(self):
        self.table = letter_table()

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text, trigram, count), by trigram and then by text, of one step after another. A trigram is three symbols of 21 bits each.

        A step is all of a chunk, or PIECE bytes of a longer text; the last two symbols go on to the next.
        """
        if len(offsets) > 2 or len(data) <= PIECE:
            yield self._counts(data, offsets, (32, 32))[:3]
            return
        at, past = 0, (32, 32)
        while at < len(data):
            end = min(len(data), at + PIECE)
            while end < len(data) and data[end] & 0xC0 == 0x80:  # a character stays whole
                end += 1
            *counts, past = self._counts(data[at:end], np.array([0, end - at]), past)
            yield tuple(counts)
            at = end

    def _counts(self, data: np.ndarray, offsets: np.ndarray, past: tuple[int, int]) -> tuple:
        points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.int32)
        heads = np.flatnonzero((data & 0xC0) != 0x80)
        if len(heads) != len(points):
            raise ValueError("a text isn't UTF-8")
        text = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(np.searchsorted(heads, offsets)))
        letter = self.table[points]
        # a gap is kept as one space where a word ends; texts are kept apart by their number
        keep = letter > 0
        after = keep[:-1] & (text[1:] == text[:-1])
        if len(keep):
            keep[0] |= past[1] != 32
        keep[1:] |= after
        symbol, text = np.where(letter[keep] > 0, letter[keep], 32).astype(np.int64), text[keep]
        fresh = np.ones(len(text), bool)
        fresh[1:] = text[1:] != text[:-1]
        one = np.where(fresh, past[1], np.concatenate([[past[1]], symbol[:-1]])[: len(symbol)])  # the symbol before; a text begins after spaces
        two = np.where(fresh, past[0], np.concatenate([[past[0]], one[:-1]])[: len(symbol)])
        past = (int(one[-1]), int(symbol[-1])) if len(symbol) else past
        ok = (symbol != 32) | (one != 32)
        gram, text = (two[ok] << 42) | (one[ok] << 21) | symbol[ok], text[ok]
        order = np.lexsort((text, gram)) if len(offsets) > 2 else np.argsort(gram, kind="stable")
        gram, text = gram[order], text[order]
        new = np.ones(len(gram), bool)
        new[1:] = (gram[1:] != gram[:-1]) | (text[1:] != text[:-1])
        at = np.flatnonzero(new)
        return text[at], gram[at], np.diff(np.append(at, len(gram))), past


def bound(grams: np.ndarray, dim: int) -> np.ndarray:
    """Vectors of +1 and -1 (float32) of trigrams."""
    packed = np.zeros((len(grams), dim // 8), np.uint8)
    for turn in range(3):
        symbols, which = np.unique(grams >> (21 * turn) & 0x1FFFFF, return_inverse=True)
        packed ^= vectors(symbols, turn, dim)[which]
    out = np.unpackbits(packed, axis=1).astype(np.float32)
    out *= -2
    out += 1
    return out


def bundled(steps: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]], own: np.ndarray, n: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the trigrams' vectors for each of `n` owners, and how many trigrams; own: the owner of each text. Vectors are made for BLOCK trigrams at a time."""
    total, many = np.zeros((n, dim)), np.zeros(n)
    for text, gram, count in steps:
        many += np.bincount(own[text], count, n)
        new = np.flatnonzero(np.r_[True, gram[1:] != gram[:-1]][: len(gram)])
        edge = np.append(new, len(gram))
        for i in range(0, len(new), BLOCK):
            a, b = edge[i], edge[min(i + BLOCK, len(new))]
            table = bound(gram[new[i : i + BLOCK]], dim)
            row = np.repeat(np.arange(len(table)), np.diff(edge[i : i + BLOCK + 1]))
            owner = own[text[a:b]]
            order = np.argsort(owner, kind="stable")
            owner, row, weight = owner[order], row[order], count[a:b][order].astype(np.float32)
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            for x, y in zip(first.tolist(), [*first[1:].tolist(), len(owner)], strict=True):
                if y - x > len(table):  # many texts of one owner: each trigram once
                    total[owner[x]] += np.bincount(row[x:y], weight[x:y], len(table)).astype(np.float32) @ table
                else:
                    total[owner[x]] += weight[x:y] @ table[row[x:y]]
    return total, many


@dataclass
class Prototypes:
    languages: list[str]
    vectors: np.ndarray
    dim: int


def fit(docs: DataFrame, *, text: str = "text", key: str = "doc_id", lang: str = "lang", use: Column | None = None, dim: int = 1024) -> Prototypes:
    """Prototypes of all rows with a language whose crc32(key as text) mod 4 is not 2 (or `use`, a condition on `__key`).

    Partial bundles are added on the executors; the driver gets one vector of a fixed length for each language.
    """
    ship(docs.sparkSession)
    use = crc_fold(F.col("__key"), 4) != 2 if use is None else use
    rows = docs.select(F.col(f"`{key}`").alias("__key"), F.col(f"`{lang}`").alias("__lang"), F.col(f"`{text}`").alias("__text")).where("__lang is not null").where(use)

    def make():
        grams = Trigrams()

        def work(data: np.ndarray, offsets: np.ndarray, batch: pa.RecordBatch) -> list[pa.Array]:
            names = batch.column(0).to_pylist()
            known = sorted(set(names))
            total, _ = bundled(grams(data, offsets), np.array([known.index(x) for x in names], np.int64), len(known), dim)
            firsts = {x: names.index(x) for x in known}
            out = [total[known.index(x)] if firsts[x] == i else None for i, x in enumerate(names)]
            return [pa.array(out, pa.list_(pa.float64()))]

        return work

    part = map_texts(rows, "__text", ["__lang"], T.StructType().add("v", T.ArrayType(T.DoubleType())), make).where("v is not null")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in batches:
            for name, v in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                x = v.values.to_numpy()
                total[name] = total[name] + x if name in total else x.copy()
        for name, x in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([name] * dim), pa.array(np.arange(dim)), pa.array(x)], names=["lang", "i", "v"])

    sums = part.mapInArrow(add, "lang string, i long, v double").groupBy("lang", "i").agg(F.sum("v").alias("v")).collect()
    names = sorted({r.lang for r in sums})
    total = np.zeros((len(names), dim))
    for r in sums:
        total[names.index(r.lang), r.i] = r.v
    norm = np.linalg.norm(total, axis=1, keepdims=True)
    return Prototypes(names, total / np.where(norm > 0, norm, 1), dim)


def identify(docs: DataFrame, model: Prototypes, *, text: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Each row of `docs` (its `carry` columns) with `lang_pred` and `score`, the cosine with that language's prototype, held to 0..1.

    Edge cases: a null text, one without a letter, and every text where no language was learned, is `und` with score 0; ties go to the
    language that sorts first; texts are read whole at any length; repeated rows are judged each; an empty table gives no rows; columns that
    are not carried don't matter, and one named as a result gives way to it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        grams, m = Trigrams(), shared.value

        def work(data: np.ndarray, offsets: np.ndarray, rows: pa.RecordBatch) -> list[pa.Array]:
            n = len(offsets) - 1
            own, many = bundled(grams(data, offsets), np.arange(n), n, m.dim)
            names, scores = [UNKNOWN] * n, np.zeros(n)
            if m.languages:
                norm = np.linalg.norm(own, axis=1)
                cosine = (own @ m.vectors.T) / np.where(norm > 0, norm, 1)[:, None]
                best = np.argmax(cosine, axis=1)
                names = [m.languages[k] if x else UNKNOWN for x, k in zip(many.tolist(), best.tolist(), strict=True)]
                scores = np.where(many > 0, np.clip(cosine[np.arange(n), best], 0.0, 1.0), 0.0)
            return [pa.array(names, pa.string()), pa.array(scores)]

        return work

    fields = T.StructType().add("lang_pred", T.StringType(), False).add("score", T.DoubleType(), False)
    return map_texts(docs, text, carry, fields, make, limit=1 << 20)
