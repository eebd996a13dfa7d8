"""Near-duplicates by SimHash and by the Jaccard similarity of word shingles.

Rows of the same words are one node. Pairs of nodes are proposed twice: by the deletion-variant index of SimHash fingerprints, which has those within
two bits, and, since texts that share four fifths of their shingles differ in about ten bits, by MinHash bands: two sets of similarity s share
one of `BANDS` bands of `ROWS` minima with probability 1 - (1 - s^ROWS)^BANDS, so a pair at 0.8 is missed about 7 times in a million. Whole
shingle sets verify all that is proposed.

In each bucket all nodes are first compared with its hub, the node whose buckets are the fullest: of a text and its edited copies it is mostly the
text that all were made from. Buckets whose nodes are then of one component are done, which takes a large group of near copies at a few
comparisons a node. In the others, nodes of different components and of like length are compared where they meet, by a bit of each of 2048
minima, which all but a few in a million of similar pairs pass; only what passes leaves the bucket and is compared whole. Nothing is dropped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import FOLD, NON_SPACE, cut, dealt, drop, gram_hashes, map_texts, mix, running, shards, spans, trim, word_hashes
from tidemill.llm.graph import smallest_reachable
from tidemill.llm.simhash import fingerprint, links

BANDS, ROWS = 30, 5
#: Longs of 16 small digits each, of which the last ten are spare and always equal; of 160 that many are equal at a similarity of 0.8, less 4.6 deviations.
DIGITS, ALIKE = 10, 110
#: Longs of single bits, for nodes that are compared with many; of 2048 that many are equal at 0.8, less 4.6 deviations.
BITS, CLOSE = 32, 1780


def nodes_of(docs: DataFrame, *, text: str = "text", carry: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Each row of `docs` (its `carry` columns) with `node`, a hash of its lower-cased words; 0 for a null or wordless text."""

    def make():
        def work(data: np.ndarray, offsets: np.ndarray, rows: pa.RecordBatch) -> list[pa.Array]:
            raw, at = data.tobytes(), offsets.tolist()
            words = [b" ".join(raw[a:b].lower().split()) for a, b in zip(at, at[1:])]  # noqa: B905
            return [pa.array([int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little", signed=True) if w else 0 for w in words], pa.int64())]

        return work

    return map_texts(docs, text, carry, T.StructType().add("node", T.LongType(), False), make)


def sketches(rows: DataFrame, *, text: str = "text", width: int = 5, remember: int = 1 << 18) -> DataFrame:
    """(node, size, f, bands, digits, grams) of rows with a `node`, of rows that a task sees again once: shingles, SimHash fingerprint, MinHash bands and digits.

    A text of fewer than `width` words is one shingle. `grams` are the distinct shingles' hashes of 32 bits. `remember` bounds what a task
    keeps of the nodes that it has seen, which only saves work.
    """

    def make():
        from xxhash import xxh64_intdigest

        seeds = mix(np.arange(1, 2 * BANDS * ROWS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        times, plus = seeds[: BANDS * ROWS] | np.uint64(1), seeds[BANDS * ROWS :]
        seen: set[int] = set()

        def lists(values: np.ndarray, kind, ends: np.ndarray) -> pa.Array:
            return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(np.ascontiguousarray(values).view(kind)))

        def work(data: np.ndarray, offsets: np.ndarray, batch: pa.RecordBatch) -> list[pa.Array]:
            fresh = []
            for n in batch.column(0).to_pylist():
                fresh.append(n not in seen)
                if len(seen) >= remember:
                    seen.clear()
                seen.add(n)
            raw, at = data.tobytes(), offsets.tolist()
            data = FOLD[data]
            start, end, first = spans(data, offsets, NON_SPACE)
            words = word_hashes(data, start, end)
            grams, ends, sets, prints = gram_hashes(words, width), first.tolist(), [], []
            for d, (a, b) in enumerate(zip(ends, ends[1:])):  # noqa: B905
                if not fresh[d] or a == b:
                    sets.append(grams[:0])
                else:
                    sets.append(np.unique(grams[a : b - width + 1]) if b - a >= width else gram_hashes(words[a:b], b - a))
                prints.append(fingerprint(raw[at[d] : at[d + 1]], width, xxh64_intdigest) if fresh[d] else 0)
            edge = running(np.array([len(s) for s in sets], np.int64))
            flat = np.concatenate([*sets, np.zeros(0, np.uint64)])
            there = np.flatnonzero(np.diff(edge))
            least = np.zeros((len(there), 16 * DIGITS), np.uint64)
            for k in range(BANDS * ROWS if len(there) else 0):
                least[:, k] = mix(np.minimum.reduceat(flat * times[k] + plus[k], edge[there]))
            bands = np.zeros((len(there), BANDS), np.uint64)
            for b in range(BANDS):
                key = np.full(len(there), b + 1, np.uint64)
                for k in range(b * ROWS, (b + 1) * ROWS):
                    key = mix(key ^ least[:, k])
                bands[:, b] = key
            shift = np.arange(0, 64, 4, dtype=np.uint64)
            digits = ((least & np.uint64(15)).reshape(len(there), DIGITS, 16) << shift).sum(axis=2, dtype=np.uint64)
            has = np.diff(edge).astype(bool)
            small = flat.astype(np.uint32).view(np.int32)
            return [
                pa.array(np.array(fresh, bool)),
                pa.array(np.diff(edge).astype(np.int32)),
                pa.array(np.array(prints, np.uint64).view(np.int64)),
                lists(bands.ravel(), np.int64, running(has * BANDS)),
                lists(digits.ravel(), np.int64, running(has * DIGITS)),
                lists(small, np.int32, edge),
            ]

        return work

    longs = T.ArrayType(T.LongType(), False)
    fields = T.StructType().add("fresh", T.BooleanType(), False).add("size", T.IntegerType(), False).add("f", T.LongType(), False).add("bands", longs, False).add("digits", longs, False).add("grams", T.ArrayType(T.IntegerType(), False), False)
    return map_texts(rows, text, ("node",), fields, make).where("fresh").drop("fresh")


def _same_digits(x: str, y: str) -> Column:
    """How many of their digits are the same."""
    each = []
    for i in range(DIGITS):
        d = f"({x}[{i}] ^ {y}[{i}])"
        each.append(f"bit_count(({d} | shiftright({d}, 1) | shiftright({d}, 2) | shiftright({d}, 3)) & 1229782938247303441L)")
    return F.expr(f"{16 * DIGITS} - ({' + '.join(each)})")


def close_bits(sets: DataFrame) -> DataFrame:
    """(node, bits) of (node, grams): one bit of each of 2048 minima."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seeds = mix(np.arange(1, 128 * BITS + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
        times, plus = seeds[: 64 * BITS] | np.uint64(1), seeds[64 * BITS :]
        for b in batches:
            out = []
            for grams in b.column(1):
                own = mix(grams.values.to_numpy().view(np.uint32).astype(np.uint64))
                least = np.empty(64 * BITS, np.uint64)
                step = max(1, (1 << 20) // max(1, len(own)))
                for k in range(0, 64 * BITS, step):
                    least[k : k + step] = (own[:, None] * times[None, k : k + step] + plus[None, k : k + step]).min(axis=0)
                out.append(np.packbits(mix(least) >> np.uint64(63) > 0).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.int64()))], names=["node", "bits"])
        trim()

    return sets.select("node", "grams").mapInArrow(run, "node long, bits array<long>")


def _alike(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose shingle sets have that similarity or more; `nodes` lie in buckets, so only pairs and one set of each move."""
    for n, columns in (("a", ("size", "digits")), ("b", ("size", "digits"))):
        pairs = pairs.hint("merge").join(nodes.select(F.col("node").alias(n), *[F.col(c).alias(f"{n}_{c}") for c in columns]), n)
    near = cut(pairs.where(f"100 * least(a_size, b_size) >= {percent} * greatest(a_size, b_size)").where(_same_digits("a_digits", "b_digits") >= ALIKE).select("a", "b"), codec="snappy")
    both = near.hint("merge")
    for n, name in (("a", "x"), ("b", "y")):
        both = both.join(nodes.select(F.col("node").alias(n), F.col("grams").alias(name)), n)
    shared = F.size(F.array_intersect("x", "y"))
    found = cut(both.where(100 * shared >= percent * (F.size("x") + F.size("y") - shared)).select("a", "b"), codec="snappy")
    drop(near)
    return found


def _by_fingerprint(nodes: DataFrame) -> DataFrame:
    """Pairs of nodes that tie together those within two bits: by the operator's own index of deletion variants."""
    prints = cut(nodes.where("size > 0").groupBy("f").agg(F.min("node").alias("d")), codec="snappy")
    one, other = (prints.select(F.col("f").alias(x), F.col("d").alias(f"{x}_node")) for x in "ab")
    far = links(prints.select("f")).join(one, "a").join(other, "b").select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
    same = nodes.where("size > 0").select("f", "node").join(prints, "f").where("node <> d").select(F.col("d").alias("a"), F.col("node").alias("b"))
    return far.unionByName(same)


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def similar_groups(rows: DataFrame, *, text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """(node, group) of each `node` of `rows` (see nodes_of) that a link of `percent` or more of Jaccard similarity ties to another; `group` is the smallest node of all that links reach.

    Nodes that are left out are groups of their own. Edge cases: texts without a word are one node; texts are read whole at any length; repeated
    rows are one node; an empty table gives no rows; columns besides don't matter.
    """
    nodes = dealt(sketches(rows, text=text, width=width), "node", shards(rows, 16 << 20), once=True)
    every = nodes.select("node", F.explode("bands").alias("k"))
    full = every.groupBy("k").agg(F.count("*").alias("n")).where("n > 1")
    entries = cut(every.join(full.hint("merge"), "k"), codec="snappy")
    weighed = cut(entries.select("k", "node").join(entries.groupBy("node").agg(F.sum("n").alias("w")).hint("merge"), "node"), codec="snappy")
    hubs = weighed.groupBy("k").agg(F.max(F.struct("w", "node")).alias("h")).select("k", F.col("h.node").alias("a"))
    proposed = weighed.join(hubs.hint("merge"), "k").where("a <> node").select("a", F.col("node").alias("b"))
    tested = cut(_ordered(proposed.unionByName(_by_fingerprint(nodes))), codec="snappy")
    drop(entries)
    found = _alike(tested, nodes, percent)
    roots = smallest_reachable(found)
    drop(found)
    # what is left: buckets of several components
    rooted = cut(weighed.select("k", "node").join(roots, "node", "left").select("k", "node", F.coalesce("root", "node").alias("root")), codec="snappy")
    drop(weighed)
    mixed = rooted.groupBy("k").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("k")
    shown = cut(rooted.join(mixed.hint("merge"), "k", "left_semi"), codec="snappy")
    drop(rooted)
    bits = cut(close_bits(nodes.select("node", "grams").join(shown.select("node").distinct().hint("merge"), "node", "left_semi")))
    shown, some = shown.join(bits.hint("merge"), "node").join(nodes.select("node", "size"), "node"), [shown, bits]
    # sets of like length are of one class, or of two that follow each other
    shown = cut(shown.withColumn("c", F.floor(F.log("size") / F.log(F.lit(100 / percent) * (1 + 1e-9))).cast("int")), codec="snappy")
    left = shown.select("k", "c", *[F.col(x).alias(f"a_{x}") for x in ("node", "root", "size", "bits", "c")])
    right = shown.select("k", F.explode(F.array("c", F.col("c") - 1)).alias("c"), *[F.col(x).alias(f"b_{x}") for x in ("node", "root", "size", "bits", "c")])
    once = f"a_root <> b_root and (a_c < b_c or a_node < b_node) and 100 * least(a_size, b_size) >= {percent} * greatest(a_size, b_size)"
    close = " + ".join(f"bit_count(a_bits[{i}] ^ b_bits[{i}])" for i in range(BITS))
    cross = left.join(right.hint("merge"), (left.k == right.k) & (left.c == right.c) & F.expr(f"{once} and {64 * BITS} - ({close}) >= {CLOSE}")).select(F.col("a_node").alias("a"), F.col("b_node").alias("b"))
    cross = cut(_ordered(cross).join(tested, ["a", "b"], "left_anti"), codec="snappy")
    drop(shown, *some, tested)
    if not cross.isEmpty():
        more = _alike(cross, nodes, percent)
        if not more.isEmpty():
            roots = _joined(roots, more)
        drop(more)
    drop(cross, nodes)
    return roots.withColumnRenamed("root", "group")


def _joined(roots: DataFrame, more: DataFrame) -> DataFrame:
    """The components when further links come: these are links of components, of which there are few."""
    fresh = more.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(roots, "node", "left_anti").withColumn("root", F.col("node"))
    every = cut(roots.unionByName(fresh), codec="snappy")
    one, other = (every.select(F.col("node").alias(x), F.col("root").alias(f"{x}_root")) for x in "ab")
    top = smallest_reachable(more.join(one, "a").join(other, "b").select(F.col("a_root").alias("a"), F.col("b_root").alias("b")))
    out = cut(every.join(top.select(F.col("node").alias("root"), F.col("root").alias("least")), "root", "left").select("node", F.coalesce("least", "root").alias("root")), codec="snappy")
    drop(roots, every, top)
    return out
