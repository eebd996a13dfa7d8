"""SimHash near-duplicates by deletion-variant signatures.

A fingerprint of 64 bits is cut into two segments of 32. Of two fingerprints that differ by at most two bits, one segment
differs by at most one. Each segment is indexed by its 32 variants with one bit taken out: equal segments share them all, segments that
differ in one bit share that bit's. Grouping by equal (segment, bit, variant) finds the pairs; the whole fingerprints verify them. Variants
that lack one of the same four bits agree in the 28 others, so a segment is dealt by these, 8 rows instead of 32, and makes its variants
where it then is; at most 16 values share such a row's key, so that is bounded, too.

A variant is shared by two values of a segment at most. So a bucket is large only where a value of a segment belongs to more than `hot`
different fingerprints. These values are counted first. Their fingerprints, and those that meet their buckets, don't enter the buckets:
they are indexed by the 65 values within one bit of the whole fingerprint. Two fingerprints within two bits share one of them, a bucket
holds 65 at most, and all of a bucket are within two bits of each other, so a star of links is enough. No bucket is unbounded, and
nothing is dropped.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemill.llm.common import cut, map_texts
from tidemill.llm.graph import smallest_reachable

LOW = 0xFFFFFFFF


def fingerprint(raw: bytes, width: int, digest) -> int:
    """SimHash of one text's bytes: lower-cased A-Z, words between blanks, `width` words a shingle, XXH64 with seed 42."""
    words = raw.lower().split()
    n = len(words)
    if not n:
        return 0
    joined = b" ".join(words)
    if n <= width:
        hashes = [digest(joined, 42)]
    else:
        ends, at = [], -1
        for w in words:
            at += len(w) + 1
            ends.append(at)
        starts = [0, *[e + 1 for e in ends]]
        hashes = [digest(joined[a:b], 42) for a, b in zip(starts, ends[width - 1 :])]  # noqa: B905
    h = np.array(hashes, np.uint64)
    total = np.zeros(64, np.int64)
    for i in range(0, len(h), 1 << 16):
        total += np.unpackbits(h[i : i + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * total > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame, *, text: str = "text", carry: Sequence[str] = ("doc_id",), width: int = 3) -> DataFrame:
    """Each row of `docs` (its `carry` columns) with `simhash`, the fingerprint as a signed long. A null or wordless text has 0."""

    def make():
        from xxhash import xxh64_intdigest

        def work(data: np.ndarray, offsets: np.ndarray, rows: pa.RecordBatch) -> list[pa.Array]:
            raw, at = data.tobytes(), offsets.tolist()
            out = [fingerprint(raw[a:b], width, xxh64_intdigest) for a, b in zip(at, at[1:])]  # noqa: B905
            return [pa.array(np.array(out, np.uint64).view(np.int64))]

        return work

    return map_texts(docs, text, carry, T.StructType().add("simhash", T.LongType(), False), make)


def links(prints: DataFrame, *, hot: int = 64) -> DataFrame:
    """Pairs (a < b) of different fingerprints (column `f`, distinct) that tie together all those within two bits of each other."""

    def flip(bit):
        return F.expr(f"shiftleft(1L, {bit})")

    # a segment's value and which segment it is, as one number: joins on one long stay small
    halves = prints.select("f", F.explode(F.array(F.expr(f"(f & {LOW}L) * 2"), F.expr(f"(shiftrightunsigned(f, 32) & {LOW}L) * 2 + 1"))).alias("h"))
    crowded = cut(halves.groupBy("h").count().where(F.col("count") > hot).select("h"), codec="snappy")
    # a marker (no f) stands for all fingerprints of a crowded value
    rows = halves.join(crowded, "h", "left_anti").unionByName(crowded.select(F.lit(None).cast("long").alias("f"), "h"))
    # rows are dealt by the 28 bits beside a digit, eight rows a segment, and become variants where they then are
    dealt = rows.withColumn("d", F.explode(F.sequence(F.lit(0), F.lit(7)))).select("h", "f", F.expr("(shiftright(h, 1) & ~shiftleft(15L, 4 * d)) * 16 + (h & 1) * 8 + d").alias("g")).repartition("g")
    variants = dealt.withColumn("j", F.explode(F.expr("sequence(4 * int(g & 7), 4 * int(g & 7) + 3)"))).select("g", "f", F.expr("(shiftright(h, 1) & ~shiftleft(1L, j)) * 64 + (h & 1) * 32 + j").alias("k"))
    buckets = variants.groupBy("g", "k").agg(F.collect_list("f").alias("fs"), F.count("*").alias("n"))  # the list is without nulls
    met = cut(buckets.where("n > 1 and size(fs) > 0").select("k", "fs", (F.col("n") > F.size("fs")).alias("marked")), codec="snappy")
    # equal segments meet in all 32 buckets: only the first counts
    apart = "if((k & 32) = 0, (a ^ b) & 4294967295L, shiftrightunsigned(a ^ b, 32)) <> 0"
    near = met.where("not marked").select("k", "fs", F.explode("fs").alias("a")).select("a", F.explode(F.expr(f"filter(fs, b -> a < b and bit_count(a ^ b) <= 2 and ((k & 31) = 0 or {apart}))")).alias("b"))
    hot_prints = halves.join(crowded, "h", "left_semi").select("f").unionByName(met.where("marked").select(F.explode("fs").alias("f"))).distinct()
    within = F.explode(F.sequence(F.lit(-1), F.lit(63)))
    around = hot_prints.withColumn("j", within).select(F.when(F.col("j") < 0, F.col("f")).otherwise(F.col("f").bitwiseXOR(flip("greatest(j, 0)"))).alias("k"), "f")
    centre = around.groupBy("k").agg(F.min("f").alias("a"), F.count("*").alias("n")).where("n > 1")
    stars = around.join(centre.hint("merge"), "k").where("a < f").select("a", F.col("f").alias("b"))
    return near.unionByName(stars).distinct()


def components(docs: DataFrame, *, text: str = "text", key: str = "doc_id", width: int = 3, hot: int = 64) -> DataFrame:
    """(doc_id, simhash, component_id) of each row of `docs`; component_id is the smallest doc_id that links of two bits or fewer reach.

    Equal fingerprints are one node from the start, so a group of copies costs no pairs. Edge cases: null, empty and blank texts have the
    fingerprint 0 and are linked like any other; a null doc_id keeps its row and is never a component's id unless it has no other;
    repeated rows and repeated doc_ids each keep their row; texts are read whole at any length; an empty table gives no rows; other columns
    don't matter.
    """
    rows = cut(fingerprints(docs, text=text, carry=(key,), width=width).withColumnRenamed(key, "doc_id"), codec="snappy")
    prints = cut(rows.groupBy(F.col("simhash").alias("f")).agg(F.min("doc_id").alias("d")), codec="snappy")
    roots = smallest_reachable(links(prints.select("f"), hot=hot))
    of = prints.join(roots, prints.f == roots.node, "left").select("f", "d", F.coalesce("root", "f").alias("root"))
    named = of.groupBy("root").agg(F.min("d").alias("component_id"))
    ids = of.join(named, "root").select("f", "component_id")
    return rows.join(ids, rows.simhash == ids.f).select("doc_id", "simhash", "component_id")
