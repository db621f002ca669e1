"""Exact top-k by inner product over KD-trees, one per shard.

Vectors are dealt to shards of bounded size by a hash of their id; each shard becomes one
row that holds a KD-tree: median splits along the widest side, tight boxes around every
node. Queries come in blocks of bounded size, one job per block. Each task searches its
shards one after the other and keeps the best ``k`` of each query, whose kth score passes
on from shard to shard; the search of the first shard, done before, gives every task a
kth score to start from. Within a tree nodes are taken best first by the largest inner
product that their box allows, and the search stops when that is below the kth score.

Defined results: vectors that are null, empty, or hold a null or non-finite component take
no part; only vectors of equal length are compared; equal scores go to the smaller id, and
rows that repeat an id are candidates each, but not of a query with that id; a query with
fewer candidates than ``k`` returns them all. Scores are integers: products of components
``floor(scale * x)``, exact while they stay below 2^63.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartoweave.llm.common import prepare, staged

SHARD = 8192
BLOCK = 4096
LEAF = 128
SCALE = 256


class Tree:
    """Rows in the order of the leaves; nodes as row ranges with boxes and children."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, leaf: int = LEAF):
        order = np.arange(len(ids))
        self.low, self.high, self.range, self.children = [], [], [], []
        self._split(rows, order, 0, len(ids), leaf)
        self.ids, self.rows = ids[order], rows[order]
        self.low, self.high = np.array(self.low), np.array(self.high)

    def _split(self, rows: np.ndarray, order: np.ndarray, a: int, b: int, leaf: int) -> int:
        own = rows[order[a:b]]
        low, high = own.min(axis=0), own.max(axis=0)
        node = len(self.range)
        self.low.append(low)
        self.high.append(high)
        self.range.append((a, b))
        self.children.append(None)
        widest = int(np.argmax(high - low))
        if b - a > leaf and high[widest] > low[widest]:
            middle = (a + b) // 2
            order[a:b] = order[a:b][np.argpartition(own[:, widest], middle - a)]
            self.children[node] = (self._split(rows, order, a, middle, leaf), self._split(rows, order, middle, b, leaf))
        return node

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The largest inner product each node's box allows each query."""
        return np.maximum(queries, 0) @ self.high.T + np.minimum(queries, 0) @ self.low.T


class Best:
    """The best ``k`` of each query so far, and its kth score."""

    def __init__(self, count: int, k: int, kth: np.ndarray | None = None):
        self.k = k
        self.kth = np.full(count, -np.inf) if kth is None else kth.astype(float)
        self.found: list[list[tuple]] = [[] for _ in range(count)]

    def offer(self, q: int, scores: np.ndarray, ids: np.ndarray) -> None:
        held = self.found[q] + list(zip((-scores).tolist(), ids.tolist()))
        held.sort()
        self.found[q] = held[: self.k]
        if len(held) >= self.k:
            self.kth[q] = max(self.kth[q], -self.found[q][-1][0])


def _number(x: np.ndarray) -> np.ndarray:
    """Floats where their products and sums are exact, else 64-bit integers."""
    most = float(np.abs(x).max()) if x.size else 0.0
    return x.astype(np.float64) if most * most * x.shape[1] < 1 << 53 else x


def search(tree: Tree, query_ids: np.ndarray, queries: np.ndarray, best: Best) -> int:
    """Improves ``best``; returns how many leaves were looked into."""
    q_all, rows = _number(queries), _number(tree.rows)
    bounds = tree.bounds(q_all.astype(float)).astype(float)
    # Bounds may be rounded where numbers are huge; a little slack keeps them bounds.
    bounds += np.abs(bounds) * 1e-9
    seen = 0
    for q in range(len(q_all)):
        heap = [(-bounds[q, 0], 0)]
        while heap:
            bound, node = heapq.heappop(heap)
            if -bound < best.kth[q]:
                break
            if tree.children[node] is not None:
                for child in tree.children[node]:
                    if bounds[q, child] >= best.kth[q]:
                        heapq.heappush(heap, (-bounds[q, child], child))
                continue
            seen += 1
            a, b = tree.range[node]
            scores = rows[a:b] @ q_all[q]
            good = np.flatnonzero((scores >= best.kth[q]) & (tree.ids[a:b] != query_ids[q]))
            if len(good):
                best.offer(q, scores[good].astype(np.int64), tree.ids[a:b][good])
    return seen


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``vec_id, size, part``: whole components as 64-bit little-endian integers."""
    x = F.col("__v")
    sound = x.isNotNull() & (F.size(x) > 0) & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))))
    source = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("__v")).where(sound & F.col("vec_id").isNotNull())
    return source.select(F.col("vec_id").cast("long").alias("vec_id"), F.size("__v").alias("size"), F.transform("__v", lambda c: F.floor(c * scale)).alias("part"))


def _build(leaf: int):
    def run(rows: pa.Table) -> pa.Table:
        ids = rows.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        size = rows.column("size")[0].as_py()
        flat = rows.column("part").combine_chunks().flatten().to_numpy().reshape(-1, size)
        tree = Tree(ids[order], flat[order].astype(np.int64), leaf)
        return pa.table({"size": pa.array([size], pa.int32()), "shard": pa.array([rows.column("shard")[0].as_py()], pa.int32()), "tree": pa.array([pickle.dumps(tree)], pa.binary())})

    return run


def _searcher(sent, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, queries, kth = sent.value
        best: dict[int, Best] = {}
        for batch in batches:
            for size, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
                if size not in queries:
                    continue
                own = best.setdefault(size, Best(len(ids[size]), k, kth.get(size)))
                search(pickle.loads(blob.as_py()), ids[size], queries[size], own)
        for size, own in best.items():
            rows = [(int(q), i, -s) for q, found in zip(ids[size], own.found) for s, i in found]
            if rows:
                columns = [pa.array(c, pa.int64()) for c in zip(*rows)]
                yield pa.RecordBatch.from_arrays(columns, names=["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE, shard: int = SHARD, block: int = BLOCK, leaf: int = LEAF) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row where ``is_query(vec_id)`` holds its
    ``k`` best other rows, against all rows."""
    spark = vectors.sparkSession
    prepare(spark)
    rows = staged(quantised(vectors, id_col, vector_col, scale))
    shards = {r["size"]: -(-r["count"] // shard) for r in rows.groupBy("size").count().collect()}
    count = F.element_at(F.create_map(*[F.lit(x) for pair in shards.items() for x in pair]), F.col("size")) if shards else F.lit(1)
    # A shard's rows are dealt by hash, so many equal vectors spread over all shards.
    trees = staged(
        rows.withColumn("shard", F.pmod(F.xxhash64("vec_id"), count).cast("int")).groupBy("size", "shard").applyInArrow(_build(leaf), "size int, shard int, tree binary")
    )
    # A tree is up to 4 MB: few to a batch.
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "4")
    asked = rows.where(is_query(F.col("vec_id"))).dropDuplicates(["vec_id", "size", "part"])
    blocks = max(1, -(-asked.count() // block))
    asked = staged(asked.withColumn("block", F.pmod(F.xxhash64("vec_id", F.lit(3)), F.lit(blocks)).cast("int")))
    parts = []
    for b in range(blocks):
        taken = asked.where(F.col("block") == b).orderBy("size", "vec_id", "part").collect()
        ids, queries = {}, {}
        for size in {r.size for r in taken}:
            own = [r for r in taken if r.size == size]
            ids[size], queries[size] = np.array([r.vec_id for r in own]), np.array([r.part for r in own], np.int64)
        first = _searcher(spark.sparkContext.broadcast((ids, queries, {})), k)
        start: dict[tuple, list] = {}
        for r in trees.where("shard = 0").select("size", "tree").mapInArrow(first, "query_id long, vec_id long, score long").collect():
            start.setdefault(r.query_id, []).append(r.score)
        kth = {s: np.array([sorted(start[q])[-k] if len(start.get(q, ())) >= k else -np.inf for q in ids[s]]) for s in ids if len(set(ids[s].tolist())) == len(ids[s]) and len(ids) == 1}
        sent = spark.sparkContext.broadcast((ids, queries, kth))
        found = staged(trees.select("size", "tree").mapInArrow(_searcher(sent, k), "query_id long, vec_id long, score long"))
        parts.append(found)
    prepare(spark)
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    # At most k rows of each query from each task come here.
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return whole.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
