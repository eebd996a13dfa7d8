"""Approximate nearest neighbours by a forest of random-projection trees with one priority queue.

Each tree splits by random directions at the median of a bounded sample. All rows of the table are indexed: a row's leaf follows from its
vector alone. A query walks all trees with one queue, ordered by the squared margins that it has crossed, until the leaves it has seen hold
a given share of the sample, each row counted once. Rows in these leaves are its candidates.

A leaf of a tree is a join key: rows and queries are sent to the cells of their leaves, a cell ranks its rows by exact distance for the queries
that reach it and returns the nearest few, and these are merged. No row meets a query that doesn't reach one of its leaves. Equal vectors are one
entry with the few smallest of their keys, which are all that can be among the nearest, and equal queries are searched once, so copies cost
nothing; what else crowds a cell is dealt to several groups of bounded size.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import cut, running, ship, tidy, trim


@dataclass
class Tree:
    """Splits in heap order: node i has children 2i + 1 and 2i + 2. Leaves are numbered from the left; leaf n has the sample's rows[edge[n] : edge[n + 1]]."""

    normal: np.ndarray
    at: np.ndarray
    rows: np.ndarray
    edge: np.ndarray

    @property
    def depth(self) -> int:
        return len(self.at).bit_length()

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf of each row; all levels at once for a block of rows."""
        side = x @ self.normal.T > self.at
        node = np.zeros(len(x), np.int64)
        for _ in range(self.depth):
            node = 2 * node + 1 + side[np.arange(len(x)), node]
        return node - len(self.at)


def _sums(values: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Sums of the rows edge[k] to edge[k + 1]."""
    total = np.zeros((len(values) + 1, values.shape[1]))
    np.cumsum(values, axis=0, out=total[1:])
    return total[edge[1:]] - total[edge[:-1]]


def build(sample: np.ndarray, trees: int, leaf: int, seed: int) -> list[Tree]:
    """Trees whose leaves hold about `leaf` rows of the sample."""
    random = np.random.default_rng(seed)
    n, dim = sample.shape
    depth = max(0, int(np.ceil(np.log2(max(1, n) / leaf))))
    out = []
    for _ in range(trees):
        count = (1 << depth) - 1
        normal, at = np.zeros((count, dim)), np.zeros(count)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            base, many = (1 << level) - 1, 1 << level
            order = np.argsort(node, kind="stable")
            edge = np.searchsorted(node[order], np.arange(base, base + many + 1))
            rows, pull = sample[order], random.standard_normal((n, 1))
            size = np.maximum(np.diff(edge), 1)[:, None]
            # a random combination of the deviations below a node: a random direction, likelier one along which these rows differ
            way = _sums(rows * pull, edge) - _sums(rows, edge) / size * _sums(pull, edge)
            length = np.linalg.norm(way, axis=1, keepdims=True)
            way = np.where(length > 1e-9, way / np.maximum(length, 1e-9), random.standard_normal((many, dim)))
            normal[base : base + many] = way
            projection = np.einsum("ij,ij->i", sample, normal[node])
            order = np.lexsort((projection, node))
            middle = (edge[:-1] + edge[1:] - 1) // 2
            full = np.diff(edge) > 0
            at[base : base + many][full] = projection[order[middle[full]]]
            node = 2 * node + 1 + (projection > at[node])
        place = node - count
        out.append(Tree(normal, at, np.argsort(place, kind="stable"), running(np.bincount(place, minlength=1 << depth))))
    return out


def probe(forest: list[Tree], query: np.ndarray, enough: int) -> list[int]:
    """Cells in the order of one queue over all trees, until `enough` rows of the sample have been seen."""
    heap = [(0.0, t, 0) for t in range(len(forest))]
    margins = [(tree.normal @ query - tree.at).tolist() for tree in forest]
    out, seen = [], set()
    while heap and len(seen) < enough:
        key, t, node = heapq.heappop(heap)
        own = margins[t]
        inner = len(own)
        while node < inner:
            m = own[node]
            right = 2 * node + 2
            near, far = (right, right - 1) if m > 0 else (right - 1, right)
            heapq.heappush(heap, (key + m * m, t, far))
            node = near
        leaf = node - inner
        out.append(t << 32 | leaf)
        tree = forest[t]
        seen.update(tree.rows[tree.edge[leaf] : tree.edge[leaf + 1]].tolist())
    return out


def good(embedding: str) -> Column:
    """A vector that takes part: no null, no component that is null or not finite, and not all zeros."""
    e = F.col(embedding)
    return F.coalesce((F.size(e) > 0) & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0), F.lit(False))


def best(queries: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, id, distance) of the nearest k ids of each query, by distance and then by id; of rows that repeat an id the nearest counts.

    Squares by one matrix product choose what is measured exactly; a margin covers its rounding.
    """
    own, norm = (rows**2).sum(axis=1), (queries**2).sum(axis=1)
    rough = own[:, None] + norm[None, :] - 2 * (rows @ queries.T)
    by_id = np.argsort(ids, kind="stable")
    first = np.flatnonzero(np.r_[True, np.diff(ids[by_id]) != 0])
    limit = np.full(len(queries), np.inf)
    if len(first) > k:  # k different ids within it
        each = rough if len(first) == len(ids) else np.minimum.reduceat(rough[by_id], first, axis=0)
        limit = np.partition(each, k - 1, axis=0)[k - 1] + 1e-9 * (own.max() + norm)
    r, c = np.nonzero(rough <= limit[None, :])
    d = np.sqrt(((rows[r] - queries[c]) ** 2).sum(axis=1))
    return nearest_of(c, ids[r], d, k)


def nearest_of(q: np.ndarray, i: np.ndarray, d: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first k different ids of each query, by distance and then by id."""
    order = np.lexsort((d, i, q))
    q, i, d = q[order], i[order], d[order]
    once = np.r_[True, (np.diff(q) != 0) | (np.diff(i) != 0)][: len(q)]
    q, i, d = q[once], i[once], d[once]
    order = np.lexsort((i, d, q))
    q, i, d = q[order], i[order], d[order]
    keep = np.arange(len(q)) - np.searchsorted(q, q) < k
    return q[keep], i[keep], d[keep]


def nearest(rows: DataFrame, *, key: str = "vec_id", embedding: str = "embedding", every: int = 100, k: int = 10, trees: int = 24, leaf: int = 4, share: float = 0.25, least: int = 1000, sample: int = 8192, group: int = 1 << 16, seed: int = 7) -> DataFrame:
    """(query_id, rank, vec_id, score): the `k` nearest rows found for each row whose key is divisible by `every`, by Euclidean distance.

    `sample` bounds the vectors that the trees are fitted on (those of the smallest hashes); all rows are indexed. A query's leaves hold `share` of
    the sample's rows, and `least` of them where it has so many. `group` bounds the index entries of a group. More rows than the sample
    can tell apart want a larger one: a leaf holds `leaf` / `sample` of the table. Edge cases: null and zero vectors, vectors with a null or
    non-finite component, null keys and vectors of another length than most take no part; ties go to the smaller key; a query's own key is never
    its neighbour, so rows that repeat a key are one query (with the smallest vector), no candidates of it, and one neighbour of others (with the
    nearest vector), however often; a query of fewer candidates than `k` gets them all; an empty table gives no rows; other columns don't matter.
    """
    spark = rows.sparkSession
    ship(spark)
    base = rows.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{embedding}`").alias("v")).where(good("v")).where("id is not null")
    empty = "query_id long, rank int, vec_id long, score double"
    sizes = base.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    if sizes is None:
        return spark.createDataFrame([], empty)
    dim, total = sizes.d, sizes["count"]
    base = base.where(F.size("v") == dim)
    # of equal vectors only the smallest keys can be among the nearest: k of others, k that a nearer vector has as well, and the query's own
    copies = Window.partitionBy("v").orderBy("id")
    entries = cut(base.groupBy("id", "v").count().withColumn("n", F.row_number().over(copies)).where(F.col("n") <= 2 * k + 1).select("id", "v", "n"))
    own = base.where(F.col("id") % every == 0).groupBy("id").agg(F.min("v").alias("v"))
    queries = cut(own.join(own.groupBy("v").agg(F.min("id").alias("q")), "v").select("id", "q", "v"))
    fitted = entries.where("n = 1").select("v", F.xxhash64("v").alias("h")).where(F.pmod("h", F.lit(1 << 32)) <= int((1 << 32) * min(1.0, 2 * sample / total)))
    fitted = np.array([r.v for r in fitted.orderBy("h", "v").limit(sample).collect()], float)  # bounded by `sample`
    enough = max(int(np.ceil(share * len(fitted))), least)
    forest = spark.sparkContext.broadcast(build(fitted, trees, leaf, seed))

    def vectors(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, dim)

    def cells(take) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for at in range(0, whole.num_rows, 1024):
                    b = whole.slice(at, 1024)
                    row, cell = take(vectors(b.column(1)))
                    yield pa.RecordBatch.from_arrays([pa.array(cell), *(c.take(pa.array(row)) for c in b.columns)], names=["cell", "id", "v"])
            trim()

        return run

    def leaves(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.tile(np.arange(len(x)), trees), np.concatenate([t << 32 | tree.leaves(x) for t, tree in enumerate(forest.value)])

    def probes(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        seen = [probe(forest.value, v, enough) for v in x]
        return np.repeat(np.arange(len(x)), [len(s) for s in seen]), np.array([c for s in seen for c in s], np.int64)

    # a cell's rows are dealt to as many groups as keep each within its bound, and small cells share a group
    salts = max(1, -(-total // max(1, len(fitted) // leaf) // group))
    groups = max(spark.sparkContext.defaultParallelism, -(-trees * total // group))
    schema = f"cell long, id long, v {entries.schema['v'].dataType.simpleString()}"
    home = lambda salt: F.pmod(F.xxhash64("cell", salt), F.lit(groups)).cast("int").alias("g")
    index = entries.select("id", "v").mapInArrow(cells(leaves), schema).select("*", F.pmod(F.xxhash64("id"), F.lit(salts)).cast("int").alias("salt"))
    walkers = max(spark.sparkContext.defaultParallelism, total // every // 4096)
    asked = queries.where("id = q").select("id", "v").repartition(walkers, "id").mapInArrow(cells(probes), schema).select("*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))

    def rank(keys: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        if left.num_rows and right.num_rows:
            (rc, ri, rx), (qc, qi, qx) = ((t.column("cell").to_numpy() * salts + t.column("salt").to_numpy(), t.column("id").to_numpy(), vectors(t.column("v").combine_chunks())) for t in (left, right))
            ro, qo = np.argsort(rc, kind="stable"), np.argsort(qc, kind="stable")
            both = np.intersect1d(rc, qc)
            spans = (np.searchsorted(c[o], both, side).tolist() for c, o in ((rc, ro), (qc, qo)) for side in ("left", "right"))
            for a, b, x, y in zip(*spans, strict=True):
                r = ro[a:b]
                for z in range(x, y, 256):  # a block of queries at a time
                    q = qo[z : min(y, z + 256)]
                    near, ids, d = best(qx[q], rx[r], ri[r], k + 1)
                    out.append((qi[q][near], ids, d))
        q, ids, d = nearest_of(*(np.concatenate([x[n] for x in out]) for n in range(3)), k + 1)
        return pa.table([pa.array(q), pa.array(ids), pa.array(d)], names=["q", "vec_id", "score"])

    found = index.select(home("salt"), "*").groupBy("g").cogroup(asked.select(home("salt"), "*").groupBy("g")).applyInArrow(tidy(rank), "q long, vec_id long, score double")
    order = Window.partitionBy("q").orderBy("score", "vec_id")
    merged = found.groupBy("q", "vec_id").agg(F.min("score").alias("score")).withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1).select("q", "vec_id", "score")
    last = Window.partitionBy("query_id").orderBy("score", "vec_id")
    each = queries.select(F.col("id").alias("query_id"), "q").join(merged, "q").where("vec_id <> query_id")
    return each.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
