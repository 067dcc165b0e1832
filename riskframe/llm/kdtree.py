"""Exact top-k inner-product search with a KD-tree per shard.

Rows are dealt to shards by a top tree fitted on a bounded sample, large leaves
split further by id, so equal vectors don't meet in one task. Each shard builds a
tree of median splits with tight boxes. Queries come in blocks of bounded size; a
block first searches each query's home shard, and the tenth score found there
prunes the boxes of all shards, within a task ever more closely.
"""

from __future__ import annotations

import heapq
import io

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.common import checkpointed
from riskframe.session import scratch_path

K = 10
SCALE = 1024
LEAF_ROWS = 64
#: Vectors of the bounded sample that the top tree is fitted on, and its depth.
SAMPLE_ROWS, TOP_DEPTH = 4096, 8
#: Rows of a shard: a 512th of all, within these bounds, and no more bytes of vectors than this.
SHARD_ROWS = (1024, 262_144)
SHARD_BYTES = 128 << 20
#: Queries of a block, and bytes of them. A block is sent to every task, so this bounds the broadcast.
BLOCK_QUERIES, BLOCK_BYTES = 8192, 64 << 20


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, v): components floor(scale * x) as longs, of rows that take part.

    Null ids, null or empty vectors, and vectors with a null or non-finite component
    take no part.
    """
    x = F.transform(F.col(vec_col), lambda c: c.cast("double"))
    ok = ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.where(F.col(id_col).isNotNull() & F.col(vec_col).isNotNull() & (F.size(vec_col) > 0) & ok).select(
        F.col(id_col).cast("long").alias("vec_id"), F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"))


class Tree:
    """Median splits of the widest side; a tight box and the least id for every node.

    Nodes lie in arrays: node i has children 2i+1 and 2i+2 or is a leaf with rows
    ``lo[i]:hi[i]``; all leaves of a level are split until they have ``leaf`` rows.
    """

    def __init__(self, x: np.ndarray, ids: np.ndarray, leaf: int = LEAF_ROWS):
        order = np.arange(len(x))
        spans = {0: (0, len(x))}
        queue = [0]
        boxes = {}
        for node in queue:
            lo, hi = spans[node]
            rows = order[lo:hi]
            part = x[rows]
            low, high = part.min(axis=0), part.max(axis=0)
            boxes[node] = (low, high, ids[rows].min())
            if hi - lo > leaf:
                side = int((high - low).argmax())
                mid = (hi - lo) // 2
                order[lo:hi] = rows[np.argpartition(part[:, side], mid)]
                spans[2 * node + 1], spans[2 * node + 2] = (lo, lo + mid), (lo + mid, hi)
                queue += [2 * node + 1, 2 * node + 2]
        self.nodes = np.array(queue)
        self.span = np.array([spans[n] for n in queue])
        self.low = np.array([boxes[n][0] for n in queue])
        self.high = np.array([boxes[n][1] for n in queue])
        self.least = np.array([boxes[n][2] for n in queue])
        self.x, self.ids = x[order], ids[order]

    def pack(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self.__dict__)
        return out.getvalue()

    @staticmethod
    def unpack(data: bytes) -> Tree:
        tree = Tree.__new__(Tree)
        with np.load(io.BytesIO(data)) as f:
            tree.__dict__ |= {k: f[k] for k in f.files}
        tree.place = {int(n): i for i, n in enumerate(tree.nodes)}
        return tree

    def search(self, q: np.ndarray, qids: np.ndarray, best: list[list[tuple[int, int]]], floor: np.ndarray, k: int) -> None:
        """Adds to each query's heap ``best`` of (score, -id), whose least is its kth.

        ``floor``: a score that k rows elsewhere are known to reach; nothing below it is kept.
        """
        # exact in doubles while sums stay under 2**53; else in 64-bit integers
        exact = float(np.abs(q).max(initial=0)) * float(max(np.abs(self.low).max(), np.abs(self.high).max())) * q.shape[1] < 2**53
        kind = np.float64 if exact else np.int64
        x, low, high = self.x.astype(kind), self.low.astype(kind), self.high.astype(kind)
        qk = q.astype(kind)
        bound = np.maximum(qk, 0) @ high.T + np.minimum(qk, 0) @ low.T  # no row of a box can score more
        for i in np.flatnonzero(bound[:, 0] >= floor):
            mine, own, row = best[i], int(qids[i]), bound[i]
            todo = [(-row[0], 0)]
            while todo:
                b, node = heapq.heappop(todo)
                least = mine[0] if len(mine) == k else None
                if -b < floor[i] or least and -b < least[0]:
                    break  # all that is left is bounded by less
                at = self.place[node]
                if least and -b == least[0] and -self.least[at] <= least[1]:
                    continue
                kids = [c for c in (2 * node + 1, 2 * node + 2) if c in self.place]
                if kids:
                    for c in kids:
                        heapq.heappush(todo, (-row[self.place[c]], c))
                    continue
                s, e = self.span[at]
                score = x[s:e] @ qk[i]
                ids = self.ids[s:e]
                keep = (score >= max(floor[i], least[0] if least else -np.inf)) & (ids != own)
                for sc, d in zip(score[keep].tolist(), ids[keep].tolist(), strict=True):
                    item = (int(sc), -d)
                    if len(mine) < k:
                        heapq.heappush(mine, item)
                    elif item > mine[0]:
                        heapq.heapreplace(mine, item)


def top_splits(x: np.ndarray, depth: int = TOP_DEPTH) -> list[tuple[int, int]]:
    """(side, median) of each inner node of a balanced top tree over a sample."""
    splits, level = [], [np.arange(len(x))]
    for _ in range(depth):
        if min(map(len, level)) < 16:
            break
        below = []
        for rows in level:
            part = x[rows]
            side = int((part.max(axis=0) - part.min(axis=0)).argmax())
            cut = int(np.partition(part[:, side], len(rows) // 2)[len(rows) // 2])
            splits.append((side, cut))
            below += [rows[part[:, side] < cut], rows[part[:, side] >= cut]]
        level = below
    return splits


def leaf_of(x: np.ndarray, splits: list[tuple[int, int]]) -> np.ndarray:
    """Leaf of each row in the top tree."""
    node = np.zeros(len(x), np.int64)
    if splits:
        side, cut = np.array(splits).T
        while (inner := node < len(splits)).any():
            i = np.flatnonzero(inner)
            node[i] = 2 * node[i] + 1 + (x[i, side[node[i]]] >= cut[node[i]])
    return node


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def shard_trees(own: DataFrame, dim: int) -> tuple[DataFrame, list[tuple[int, int]], dict[int, tuple[int, int]]]:
    """(shard, tree) rows over all vectors of one dimension; the top tree; first shard and number of shards of each leaf."""
    n = own.count()
    sample = own.orderBy(F.xxhash64("vec_id", F.lit(3)), "vec_id").limit(SAMPLE_ROWS).toPandas()
    splits = top_splits(np.array(sample["v"].tolist(), np.int64).reshape(-1, dim))

    def route(batches):
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(leaf_of(matrix(b.column(1), dim), splits))], ["vec_id", "v", "leaf"])

    routed = own.mapInArrow(route, "vec_id long, v array<long>, leaf long")
    rows = max(1, min(max(n // 512, SHARD_ROWS[0]), SHARD_ROWS[1], SHARD_BYTES // (8 * dim)))
    # a row for each leaf of the top tree: 2 ** TOP_DEPTH at most
    counts = {r["leaf"]: r["n"] for r in routed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}
    # small leaves share a shard with their neighbours, large ones are cut by id
    where, shard, room = {}, -1, 0
    for leaf, size in sorted(counts.items()):
        salts = -(-size // rows)
        if size > room:
            shard, room = shard + 1, rows
        where[leaf] = (shard, salts)
        shard, room = shard + salts - 1, room - size if salts == 1 else 0
    pairs = [x for leaf, (b, k) in where.items() for x in (F.lit(leaf), F.struct(F.lit(b).alias("base"), F.lit(k).alias("salts")))]
    at = F.create_map(*pairs)[F.col("leaf")]
    dealt = routed.withColumn("shard", at["base"] + F.pmod(F.xxhash64("vec_id", F.lit(5)), at["salts"]))

    def build(x: pd.DataFrame) -> pd.DataFrame:
        tree = Tree(np.array(x["v"].tolist(), np.int64).reshape(-1, dim), x["vec_id"].to_numpy(np.int64))
        return pd.DataFrame({"shard": x["shard"].iloc[:1], "tree": [tree.pack()]})

    trees = dealt.select("shard", "vec_id", "v").groupBy("shard").applyInPandas(build, "shard long, tree binary")
    return checkpointed(trees), splits, where


def top_k(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: each query row's ``k`` best rows by integer inner
    product, ties to the smaller id, itself (all rows with its id) left out.

    Vectors are only compared with others of their length. Fewer candidates give
    fewer rows; an empty table or no query gives none. Repeated candidates each
    count; a repeated query id is searched once for each different vector. Other
    columns are not read.

    The rows of a block of queries are written before the next block is searched, and
    all blocks are read back as one table: the plan doesn't grow with the queries.
    """
    spark = vectors.sparkSession
    own = checkpointed(integer_vectors(vectors, id_col, vec_col, scale).withColumn("dim", F.size("v")))
    asked = integer_vectors(vectors.where(is_query), id_col, vec_col, scale).distinct().withColumn("dim", F.size("v"))
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max("dim"), F.lit(1)).alias("dim")).first()
    a_block = max(1, min(BLOCK_QUERIES, BLOCK_BYTES // (8 * size["dim"])) // 2)
    asked = checkpointed(asked.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(max(1, -(-size["n"] // a_block))))))
    blocks = asked.groupBy("dim", "block").agg(F.count(F.lit(1)).alias("n")).orderBy("dim", "block").collect()
    schema = "query_no long, query_id long, score long, vec_id long"
    columns = "query_id long, rank int, vec_id long, score long"
    path, trees = scratch_path(spark, "top-k"), {}
    for i, b in enumerate(blocks):
        dim = b["dim"]
        if dim not in trees:
            trees[dim] = shard_trees(own.where(F.col("dim") == dim).select("vec_id", "v"), dim)
        shards, splits, where = trees[dim]
        rows = asked.where((F.col("dim") == dim) & (F.col("block") == b["block"])).select("vec_id", "v").orderBy("vec_id", "v").toPandas()
        q, qids = np.array(rows["v"].tolist(), np.int64).reshape(-1, dim), rows["vec_id"].to_numpy(np.int64)
        leaf = leaf_of(q, splits)
        home = np.array([where[x][0] + i % where[x][1] if x in where else -1 for i, x in enumerate(leaf.tolist())])
        sent = spark.sparkContext.broadcast((q, qids, home))

        def first(batches, sent=sent):
            q, qids, home = sent.value
            for b in batches:
                for shard, data in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                    mine = np.flatnonzero(home == shard)
                    best: list[list] = [[] for _ in mine]
                    if len(mine):
                        Tree.unpack(data.as_py()).search(q[mine], qids[mine], best, np.full(len(mine), -np.inf), k)
                    full = [(int(i), x[0][0]) for i, x in zip(mine, best, strict=True) if len(x) == k]
                    yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in full], pa.int64()), pa.array([s for _, s in full], pa.int64())], ["query_no", "kth"])

        kth = shards.mapInArrow(first, "query_no long, kth long").toPandas()  # a row for each query of the block at most
        floor = np.full(len(q), -np.inf)
        floor[kth["query_no"].to_numpy(np.int64)] = kth["kth"]
        bounds = spark.sparkContext.broadcast(floor)

        def rest(batches, sent=sent, bounds=bounds):
            q, qids, _ = sent.value
            best: list[list] = [[] for _ in range(len(q))]
            for b in batches:
                for data in b.column(1):
                    Tree.unpack(data.as_py()).search(q, qids, best, bounds.value, k)
            out = [(i, int(qids[i]), s, -d) for i, x in enumerate(best) for s, d in x]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["query_no", "query_id", "score", "vec_id"])

        part = shards.mapInArrow(rest, schema)
        best = Window.partitionBy("query_no").orderBy(F.desc("score"), "vec_id")
        part = part.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        part.write.parquet(f"{path}/part={i}")
        sent.destroy()
        bounds.destroy()
    return spark.read.schema(columns).parquet(path).select("query_id", "rank", "vec_id", "score") if blocks else spark.createDataFrame([], columns)
