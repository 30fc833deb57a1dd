"""Approximate nearest neighbours: a forest of random-projection trees.

Every tree parts the space by random directions at medians of a bounded
sample.  Every vector is filed in one leaf of each tree.  A query walks all
trees through one shared priority queue, nearest cut first, until the leaves it
has reached hold the asked share of all rows; what lies in these leaves is
reranked by the exact inner product.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from quillgate.llm import common as c

TREES = 4
LEAF_ROWS = 80
#: rows that the directions and medians are fitted on, about
SAMPLE_ROWS = 32768
SAMPLE_ROWS_PER_LEAF = 8
#: rows, as a share of all, in the leaves that a query reads (a row counts once
#: for each tree whose leaf holds it)
READ_SHARE = 1.0
LEAST_ROWS = 4000
#: index rows and queries that meet in one group; every group gives each of its
#: queries a list, so fewer, larger blocks send less
BLOCK_ROWS, BLOCK_QUERIES = 16384, 4096


@dataclass
class Forest:
    """Nodes in heap order (1 is the root): (trees, 2**depth, dim) directions
    and (trees, 2**depth) cuts; rows in each leaf."""

    direction: np.ndarray
    cut: np.ndarray
    depth: int
    leaf_rows: np.ndarray | None = None

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """Leaf number of each row in each tree: (trees, rows)."""
        out = np.ones((len(self.direction), len(x)), np.int64)
        for t, node in enumerate(out):
            for _ in range(self.depth):
                side = np.einsum("ij,ij->i", x, self.direction[t, node]) > self.cut[t, node]
                node[:] = 2 * node + side
        return out - (1 << self.depth)

    def search(self, q: np.ndarray, rows: float) -> list[tuple[int, int]]:
        """(tree, leaf) pairs in the order of the queue, holding ``rows``."""
        margin = self.direction @ q - self.cut
        queue = [(0.0, t, 1) for t in range(len(self.direction))]
        found, half = [], 1 << self.depth
        while queue and rows > 0:
            far, t, node = heapq.heappop(queue)
            while node < half:
                m = margin[t, node]
                near = int(m > 0)
                heapq.heappush(queue, (far + m * m, t, 2 * node + 1 - near))
                node = 2 * node + near
            if self.leaf_rows[t, node - half]:
                found.append((t, node - half))
                rows -= self.leaf_rows[t, node - half]
        return found


def plant(x: np.ndarray, rows: int, trees: int = TREES, leaf_rows: int = LEAF_ROWS, seed: int = 17) -> Forest:
    """Trees for ``rows`` vectors from the sample ``x``."""
    depth = int(np.ceil(np.log2(max(1.0, rows / leaf_rows))))
    depth = max(0, min(depth, int(np.log2(max(1, len(x) / SAMPLE_ROWS_PER_LEAF)))))
    draw = np.random.default_rng(seed)
    dim = x.shape[1]
    direction = draw.normal(size=(trees, 1 << depth, dim))
    direction /= np.linalg.norm(direction, axis=2, keepdims=True)
    cut = np.zeros((trees, 1 << depth))
    for t in range(trees):
        parts = {1: np.arange(len(x))}
        for node in range(1, 1 << depth):
            at = parts.pop(node)
            p = x[at] @ direction[t, node]
            cut[t, node] = np.median(p) if len(p) else 0.0
            parts[2 * node], parts[2 * node + 1] = at[p <= cut[t, node]], at[p > cut[t, node]]
    return Forest(direction, cut, depth)


def usable(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, vec, key): vectors of the commonest length that are not null,
    not zero and finite throughout; ``key`` tells vectors apart."""
    vec = F.col(vector).cast("array<double>")
    fine = F.exists("vec", lambda x: x != 0) & F.forall("vec", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    rows = rows.select(F.col(vec_id).alias("vec_id"), vec.alias("vec")).filter(F.col("vec_id").isNotNull() & fine)
    sizes = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    rows = rows.filter(F.size("vec") == (sizes["n"] if sizes else 0))
    return rows.withColumn("key", F.md5(F.array_join(F.col("vec").cast("array<string>"), ",")))


def nearest(vectors: DataFrame, is_query: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding",
            read_share: float = READ_SHARE, least_rows: int = LEAST_ROWS) -> DataFrame:
    """The ``k`` nearest found rows by inner product of every row where
    ``is_query`` (over ``vec_id``): query_id, rank, vec_id, score.

    A row is never its own neighbour; equal scores go to the smaller id; a
    query gets all candidates if there are fewer.  Rows with a null id, and
    null, zero or non-finite vectors and those of another length than most,
    take no part.  A repeated id counts as one row for each different vector
    it has.  An empty table gives no rows.

    Copies of a vector are one entry with its ``k`` + 1 smallest ids, more of
    which can never be asked for, so a vector that fills a third of the table
    is one row in one leaf.  Entries and queries meet in blocks of bounded
    size.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, vec_id, vector)
    queries = rows.filter(is_query).select(F.col("vec_id").alias("query_id"), "key").distinct()
    w = W.partitionBy("key").orderBy("vec_id")
    first = rows.dropDuplicates(["key", "vec_id"]).withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= k + 1)
    entries = first.groupBy("key").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("vec").alias("vec"))
    asked = queries.select("key").distinct().withColumn("asked", F.lit(True))
    entries = c.materialise(entries.join(asked, "key", "left").withColumn("asked", F.coalesce("asked", F.lit(False))), "ann-entries")
    n, n_asked = entries.agg(F.count(F.lit(1)), F.sum(F.col("asked").cast("long"))).first()
    schema = "query_id long, rank int, vec_id long, score double"
    if not n or not n_asked:
        return spark.createDataFrame([], schema)
    sample = entries.filter(c.picked(SAMPLE_ROWS / n, "key", seed="forest")).select("vec").toPandas()
    dim = len(entries.select("vec").first()[0])
    x = np.stack(sample["vec"].to_numpy()) if len(sample) else np.zeros((0, dim))
    forest = plant(x, n)
    planted = spark.sparkContext.broadcast(forest)

    def file(batches):
        for batch in batches:
            at = planted.value.leaves(_matrix(batch.column("vec")))
            yield {"key": batch.column("key"), "ids": batch.column("ids"), "vec": batch.column("vec"), "asked": batch.column("asked"),
                   "leaves": list(at.T.astype(np.int32))}

    index = c.materialise(
        c.over_batches(entries, file, "key string, ids array<long>, vec array<double>, asked boolean, leaves array<int>"), "ann-index")
    sizes = index.select(F.posexplode("leaves").alias("tree", "leaf")).groupBy("tree", "leaf").count().toPandas()
    forest.leaf_rows = np.zeros(forest.cut.shape, np.int64)
    forest.leaf_rows[sizes["tree"], sizes["leaf"]] = sizes["count"]
    walked = spark.sparkContext.broadcast(forest)
    shelf_bits = max(0, min(forest.depth, int(np.log2(max(1, n / BLOCK_ROWS)))))
    shift = forest.depth - shelf_bits
    row_blocks = int(np.ceil(n / (1 << shelf_bits) / (2 * BLOCK_ROWS)))
    query_blocks = int(np.ceil(n_asked / BLOCK_QUERIES))
    wanted = max(read_share * n, least_rows * len(forest.direction))

    def walk(batches):
        for batch in batches:
            x = _matrix(batch.column("vec"))
            found = []
            for i, q in enumerate(x):
                shelves: dict[tuple[int, int], list[int]] = {}
                for t, leaf in walked.value.search(q, wanted):
                    shelves.setdefault((t, leaf >> shift), []).append(leaf)
                found += [(i, t, s, leaves) for (t, s), leaves in shelves.items()]
            at = pa.array([f[0] for f in found], pa.int64())
            yield {"key": batch.column("key").take(at), "vec": batch.column("vec").take(at), "tree": [f[1] for f in found],
                   "shelf": [f[2] for f in found], "leaves": [f[3] for f in found]}

    visits = c.over_batches(index.filter("asked").select("key", "vec"), walk,
                            "key string, vec array<double>, tree int, shelf int, leaves array<int>")
    block = F.pmod(F.xxhash64("key"), F.lit(row_blocks)).cast("int")
    q_block = F.pmod(F.xxhash64("key"), F.lit(query_blocks)).cast("int")
    visits = visits.select("*", q_block.alias("q_block"), F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))).alias("block"))
    filed = index.select("key", "ids", "vec", block.alias("block"), F.posexplode("leaves").alias("tree", "leaf"))
    filed = filed.select("ids", "vec", "block", "tree", "leaf", F.shiftright("leaf", shift).alias("shelf"),
                         F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("q_block"))
    keys = ("tree", "shelf", "block", "q_block")
    found = filed.groupBy(*keys).cogroup(visits.groupBy(*keys)).applyInArrow(
        lambda key, left, right: _rerank(left, right, k + 1), "key string, vec_id long, score double")
    ranked = found.groupBy("key", "vec_id").agg(F.max("score").alias("score"))
    w = W.partitionBy("key").orderBy(F.desc("score"), "vec_id")
    ranked = ranked.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= k + 1)
    lists = ranked.groupBy("key").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))).alias("l"))
    lists = c.materialise(lists, "ann-lists")
    best = queries.join(lists, "key").select(
        "query_id", F.posexplode(F.slice(F.filter("l", lambda x: x["vec_id"] != F.col("query_id")), 1, k)).alias("i", "x"))
    return best.select("query_id", (F.col("i") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"),
                       (-F.col("x.s")).alias("score"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _rerank(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    """Of one block: each query's ``k`` best rows in the leaves it reads."""
    keys, ids_out, scores = [], [], []
    if left.num_rows and right.num_rows:
        x, q = _matrix(left.column("vec").combine_chunks()), _matrix(right.column("vec").combine_chunks())
        leaf = left.column("leaf").to_numpy()
        ids, names = left.column("ids").to_pylist(), right.column("key").to_pylist()
        read = right.column("leaves").to_pylist()
        base = int(leaf.min())
        width = int(leaf.max()) - base + 1
        for lo in range(0, len(q), 256):
            dots = q[lo : lo + 256] @ x.T
            for i, row in enumerate(dots, lo):
                mark = np.zeros(width, bool)
                mine = np.asarray(read[i]) - base
                mark[mine[(mine >= 0) & (mine < width)]] = True
                row = np.where(mark[leaf - base], row, -np.inf)
                least = np.partition(row, -k)[-k] if len(row) > k else -np.inf
                at = np.flatnonzero((row >= least) & (row > -np.inf))
                exact = np.einsum("ij,j->i", x[at], q[i])
                best = sorted((-s, v) for a, s in zip(at, exact) for v in ids[a])[:k]
                keys += [names[i]] * len(best)
                ids_out += [v for _, v in best]
                scores += [-s for s, _ in best]
    return pa.table({"key": pa.array(keys, pa.string()), "vec_id": pa.array(ids_out, pa.int64()), "score": pa.array(scores, pa.float64())})
