"""Hard negatives by exact search in cover trees.

Vectors are scaled to integers.  A vector x gets one more component,
sqrt(M^2 - |x|^2) with M the largest norm, and a query a zero: then the inner
product q.x = (|q|^2 + M^2 - d^2) / 2 falls with the distance d, and a ball
around a centre bounds all inner products in it from both sides.

The upper level is a net of centres from a bounded sample; every vector is
filed under its nearest one, and the covering radius of each is taken over all
its vectors.  Below it every cell is a cover tree: the children of a node are
centres at least as far apart as the radius that covers the rest, the node's
own centre among them.  A query goes to the cells that its bounds allow and
descends best first, skipping nodes below what it has found or outside its
score windows; leaves are verified by exact integer products.
"""

from __future__ import annotations

import heapq
import pickle
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from quillgate.llm import common as c

#: vectors of a cell, about; its tree is one row of the index
CELL_ROWS = 16384
#: cells at most (larger cells are cut into parts with the same bounds)
MOST_CELLS = 4096
#: vectors that the centres are picked from, and that give queries a first bound, about
SAMPLE_ROWS = 8192
#: children of a node, vectors of a leaf
FANOUT, LEAF_ROWS = 16, 512
#: queries that share a descent
TOGETHER = 256
#: queries that meet one copy of a tree
BLOCK_QUERIES = 65536
#: groups dealt over at most so many tasks
MOST_TASKS = 20_000
#: integers up to here are exact as doubles, and so are sums of products
EXACT = float(1 << 53)
_LONG = (1 << 63) - 1


# -- trees -------------------------------------------------------------------


def raised(x: np.ndarray, top: float) -> np.ndarray:
    """``x`` with the component that brings every norm to ``sqrt(top)``."""
    rest = np.sqrt(np.maximum(top - np.einsum("ij,ij->i", x, x), 0))
    return np.concatenate([x, rest[:, None]], axis=1)


def distances(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    gap = x - centre
    return np.sqrt(np.einsum("ij,ij->i", gap, gap))


def net(x: np.ndarray, k: int, first: int = 0) -> tuple[list[int], np.ndarray, np.ndarray]:
    """Farthest-first centres (their row numbers), each row's nearest centre
    and its distance.  No two centres are closer than what covers the rest."""
    chosen, nearest = [first], np.zeros(len(x), np.int64)
    gap = distances(x, x[first])
    while len(chosen) < k and gap.max() > 0:
        at = int(gap.argmax())
        new = distances(x, x[at])
        closer = new < gap
        nearest[closer], gap = len(chosen), np.minimum(gap, new)
        chosen.append(at)
    return chosen, nearest, gap


def bit(label: np.ndarray) -> np.ndarray:
    """One of 63 bits for each label."""
    return np.uint64(1) << (c.mix(label.astype(np.int64).view(np.uint64)) % np.uint64(63))


@dataclass
class Tree:
    """Rows in leaf order with their ``labels`` and up to a few ``ids`` each;
    nodes as arrays: row of the ``centre``, covering ``radius``, ``bits`` of the
    labels below, and either children ``first`` to ``last`` or (``leaf``) rows."""

    x: np.ndarray
    labels: np.ndarray
    ids: list[list[int]]
    top: float
    exact: bool
    centre: np.ndarray = field(default=None)
    radius: np.ndarray = field(default=None)
    bits: np.ndarray = field(default=None)
    first: np.ndarray = field(default=None)
    last: np.ndarray = field(default=None)
    leaf: np.ndarray = field(default=None)


def plant(x: np.ndarray, labels: np.ndarray, ids: list[list[int]], top: float, exact: bool = True, leaf_rows: int = LEAF_ROWS,
          fanout: int = FANOUT) -> Tree:
    """A cover tree over the rows of ``x``.  Where integers are too large for
    exact doubles it is a single leaf."""
    n = len(x)
    high = raised(x, top) if exact else np.zeros((n, 1))
    rows = [np.arange(n)]
    centre, radius, first, last, leaf = [0], [distances(high, high[0]).max() if n else 0.0], [0], [0], [True]
    order, done, node = [], 0, 0
    while node < len(rows):
        mine = rows[node]
        if len(mine) <= leaf_rows or radius[node] == 0:
            first[node], last[node] = done, done + len(mine)
            order.append(mine)
            done += len(mine)
        else:
            at = int(np.flatnonzero(mine == centre[node])[0])
            chosen, nearest, gap = net(high[mine], min(fanout, 1 + -(-len(mine) // leaf_rows)), at)
            first[node], last[node], leaf[node] = len(rows), len(rows) + len(chosen), False
            for i, row in enumerate(chosen):
                inside = nearest == i
                rows.append(mine[inside])
                centre.append(int(mine[row]))
                radius.append(float(gap[inside].max()))
                first.append(0), last.append(0), leaf.append(True)
        node += 1
    own = bit(labels)
    bits = np.array([np.bitwise_or.reduce(own[r]) if len(r) else 0 for r in rows], np.uint64)
    order = np.concatenate(order)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    return Tree(x[order], labels[order], [ids[i] for i in order], top, exact, place[np.array(centre, np.int64)] if n else np.zeros(1, np.int64),
                np.array(radius), bits, np.array(first), np.array(last), np.array(leaf))


def ball_bounds(inner: np.ndarray, radius: np.ndarray, square: float, top: float) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product in balls around centres of this inner
    product; ``square``: of the query's norm.  A little wider than exact."""
    gap = np.sqrt(np.maximum(square + top - 2 * inner, 0))
    slack = 0.5 + 1e-9 * (square + top)
    return (square + top - (gap + radius) ** 2) / 2 - slack, (square + top - np.maximum(gap - radius, 0) ** 2) / 2 + slack


def products(x: np.ndarray, q: np.ndarray, exact: bool) -> np.ndarray:
    if exact:
        return x @ q
    whole = [int(v) for v in q]
    return np.array([sum(int(a) * b for a, b in zip(row, whole)) for row in x], dtype=object)


class Best:
    """The ``k`` best (score, id) of a window, and the score that a further
    one must reach."""

    def __init__(self, k: int, low=-np.inf, high=np.inf):
        self.k, self.need, self.high, self.found = k, low, high, []

    def take(self, scores: np.ndarray, rows: np.ndarray, ids: list[list[int]], same: np.ndarray | None = None) -> None:
        fits = (scores >= self.need) & (scores <= self.high)
        at = np.flatnonzero(fits)
        if not len(at):
            return
        if len(at) > self.k:
            least = np.partition(scores[at], -self.k)[-self.k] if scores.dtype != object else sorted(scores[at])[-self.k]
            at = at[scores[at] >= least]
        new = [(-int(scores[a]), i, bool(same[a]) if same is not None else False) for a in at for i in ids[rows[a]][: self.k]]
        self.found = sorted(self.found + new)[: self.k]
        if len(self.found) == self.k:
            self.need = max(self.need, -self.found[-1][0])


def descend(tree: Tree, q: np.ndarray, labels: np.ndarray, windows: list[list[Best]], same_label: bool) -> None:
    """Fill the windows of each query (a row of ``q``) with rows of its label,
    or of others.

    The queries share one queue, so that a node is read once: best first by the
    highest bound of those queries that it is still open for.
    """
    if not len(tree.x) or not len(q):
        return
    if not tree.exact:  # one leaf, in whole numbers
        for one, label, mine in zip(q, labels, windows):
            rows = np.flatnonzero((tree.labels == label) == same_label)
            scores, same = products(tree.x[rows], one, False), (tree.x[rows] == one).all(axis=1)
            for window in mine:
                window.take(scores, rows, tree.ids, same)
        return
    square = np.einsum("ij,ij->i", q, q).astype(float)
    q = q.astype(tree.x.dtype)
    width = max(map(len, windows))
    need = np.array([[w.need for w in mine] + [np.inf] * (width - len(mine)) for mine in windows], float)
    high = np.array([[w.high for w in mine] + [-np.inf] * (width - len(mine)) for mine in windows], float)
    wanted = bit(labels)
    queue: list = []

    def open_nodes(nodes: np.ndarray, active: np.ndarray) -> None:
        inner = (q[active] @ tree.x[tree.centre[nodes]].T).astype(float)
        least, most = ball_bounds(inner, tree.radius[nodes], square[active, None], tree.top)
        keep = ((most[:, :, None] >= need[active, None]) & (least[:, :, None] <= high[active, None])).any(axis=2)
        if same_label:
            keep &= wanted[active, None] & tree.bits[nodes] != 0
        for i, node in enumerate(nodes):
            mine = np.flatnonzero(keep[:, i])
            if len(mine):
                heapq.heappush(queue, (-most[mine, i].max(), int(node), active[mine], most[mine, i]))

    open_nodes(np.array([0]), np.arange(len(q)))
    while queue:
        _, node, active, most = heapq.heappop(queue)
        active = active[most >= need[active].min(axis=1)]  # others have found better since
        if not len(active):
            continue
        lo, hi = tree.first[node], tree.last[node]
        if not tree.leaf[node]:
            open_nodes(np.arange(lo, hi), active)
            continue
        scores = q[active] @ tree.x[lo:hi].T
        fits = (tree.labels[lo:hi] == labels[active, None]) == same_label
        fits &= (scores >= need[active].min(axis=1, keepdims=True)) & (scores <= high[active].max(axis=1, keepdims=True))
        by_query, rows = np.nonzero(fits)
        edges = np.flatnonzero(np.diff(by_query, prepend=-1, append=-1))
        for begin, end in zip(edges, edges[1:]):
            i, mine = active[by_query[begin]], rows[begin:end]
            found = scores[by_query[begin], mine]
            same = (tree.x[mine + lo] == q[i]).all(axis=1) if same_label else None
            for w, window in enumerate(windows[i]):
                window.take(found, mine + lo, tree.ids, same)
                need[i, w] = window.need


# -- mining ------------------------------------------------------------------


def score_window(positive: int, low: int, high: int, whole: int) -> tuple[int, int]:
    """Scores s with low * positive <= whole * s <= high * positive."""
    return -(-low * positive // whole), high * positive // whole


def scaled_rows(vectors: DataFrame, vec_id: str, vector: str, label: str, scale: float) -> DataFrame:
    """(vec_id, label, vec): floor(scale * x) of the rows that take part."""
    fine = F.forall("vec", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"),
                          F.col(vector).cast("array<double>").alias("vec"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("vec").isNotNull() & fine)

    def whole(x):  # beyond 2**52 every double is whole
        y = x * F.lit(float(scale))
        return F.when(F.abs(y) < float(1 << 52), F.floor(y).cast("double")).otherwise(y)

    return rows.withColumn("vec", F.transform("vec", whole)).filter(F.forall("vec", lambda x: F.abs(x) < float("inf")))


def mine(vectors: DataFrame, is_anchor: Column, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", scale: float = 256,
         positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95, whole: int = 100, cell_rows: int = CELL_ROWS) -> DataFrame:
    """For every row where ``is_anchor`` (over ``vec_id``) and each of its
    ``positives`` best other rows of the same label: the first ``negatives`` rows of
    other labels whose score lies between ``low`` and ``high`` ``whole``-ths of
    the positive's.  anchor_id, positive_id, rank, negative_id,
    positive_score, negative_score.

    A score is the integer inner product of the scaled vectors, exact whatever
    their size (one that a long can't hold is given as the largest long).
    Higher ones come first, ties by smaller id.  Rows with a null id, label or
    vector, and with null or non-finite components (before or after scaling) take no part; a shorter
    vector counts as ended in zeros.  Rows that agree in id, label and vector
    count once; else a repeated id is rows of their own.  A pair without a
    negative gives no row, an empty table none.

    Copies of a vector with one label are one entry with its smallest ids (no
    more can be asked for), and one query if they are anchors.
    """
    spark = vectors.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = scaled_rows(vectors, vec_id, vector, label, scale)
    rows = rows.withColumn("key", F.md5(F.array_join(F.col("vec").cast("array<string>"), ",")))
    anchors = rows.filter(is_anchor).select(F.col("vec_id").alias("anchor_id"), "key", "label").distinct()
    kept = max(positives + 1, negatives)
    inside = W.partitionBy("key", "label").orderBy("vec_id")
    first = rows.dropDuplicates(["key", "label", "vec_id"]).withColumn("_n", F.row_number().over(inside)).filter(F.col("_n") <= kept)
    entries = first.groupBy("key", "label").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"), F.first("vec").alias("vec"))
    asked = anchors.select("key", "label").distinct().withColumn("asked", F.lit(True))
    entries = c.materialise(entries.join(asked, ["key", "label"], "left").withColumn("asked", F.coalesce("asked", F.lit(False))), "negatives-entries")
    square = F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x)
    n, n_asked, dim, top = entries.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("asked").cast("long")), F.lit(0)), F.max(F.size("vec")), F.max(square)).first()
    if not n_asked:
        return spark.createDataFrame([], schema)
    exact = top < EXACT
    entries = entries.withColumn("vec", F.concat("vec", F.array_repeat(F.lit(0.0), F.lit(dim) - F.size("vec"))))
    sample = entries.filter(c.picked(SAMPLE_ROWS / n, "key", "label", seed="cover")).select("vec", "label").toPandas()
    x = _matrix(sample["vec"], dim)
    sample_labels = sample["label"].to_numpy(np.int64)
    cells = min(MOST_CELLS, len(x), -(-n // cell_rows)) if exact else 0
    centres = x[net(raised(x, top), cells)[0]] if cells else np.zeros((1, dim))
    pegged = spark.sparkContext.broadcast(raised(centres, top) if cells else None)

    def file(batches):
        high_centres = pegged.value
        for batch in batches:
            mine = _matrix(batch.column("vec"), dim)
            cell, gap = np.zeros(len(mine), np.int64), np.zeros(len(mine))
            if high_centres is not None:
                mine = raised(mine, top)
                for lo in range(0, len(mine), 1024):
                    part = mine[lo : lo + 1024]
                    cell[lo : lo + 1024] = np.argmin((high_centres**2).sum(1) - 2 * part @ high_centres.T, axis=1)
                gap = np.sqrt(((mine - high_centres[cell]) ** 2).sum(1))
            yield {"cell": cell.astype(np.int32), "gap": gap, **{k: batch.column(k) for k in ("key", "label", "ids", "vec", "asked")}}

    index = c.materialise(c.over_batches(entries, file, "cell int, gap double, key string, label long, ids array<long>, vec array<double>, asked boolean"),
                          "negatives-index")
    pegged.destroy()
    about = index.groupBy("cell").agg(F.max("gap").alias("gap"), F.ceil(F.count(F.lit(1)) / F.lit(2 * cell_rows)).alias("parts"))
    about = sorted(about.collect())  # at most MOST_CELLS rows
    numbers = [r["cell"] for r in about]
    guide = spark.sparkContext.broadcast({
        "x": x, "labels": sample_labels, "centres": centres[numbers], "radius": np.array([r["gap"] for r in about]),
        "cells": [(r["cell"], r["parts"]) for r in about]})
    parts = spark.createDataFrame([(r["cell"], r["parts"]) for r in about], "cell int, parts long")
    part = F.pmod(F.xxhash64("key", "label"), F.col("parts")).cast("int")

    def grow(table: pa.Table) -> pa.Table:
        vec = _matrix(table.column("vec").combine_chunks(), dim)
        tree = plant(vec, table.column("label").to_numpy(), table.column("ids").to_pylist(), top, exact)
        tree.x = _small(tree.x)
        return pa.table({"cell": table.column("cell")[:1], "part": table.column("part")[:1], "tree": pa.array([pickle.dumps(tree)], pa.binary())})

    trees = index.join(F.broadcast(parts), "cell").select("cell", part.alias("part"), "label", "ids", "vec").groupBy("cell", "part").applyInArrow(grow, "cell int, part int, tree binary")
    trees = c.materialise(trees, "negatives-trees")
    blocks = -(-n_asked // BLOCK_QUERIES)
    tasks = min(MOST_TASKS, max(spark.sparkContext.defaultParallelism, 2 * sum(r["parts"] for r in about) * blocks))
    block = F.pmod(F.xxhash64("key", "label"), F.lit(blocks)).cast("int").alias("block")
    asked_for = T._parse_datatype_string("key string, label long, vec array<double>, low array<long>, high array<long>, need array<long>")

    def search(queries: DataFrame, k: int, same_label: bool) -> DataFrame:
        """``queries`` (key, label, vec, windows): the ``k`` best rows of each
        cell in each window: key, label, window, vec_id, score, same."""

        def route(batches):
            g = guide.value
            for batch in batches:
                q, label = _matrix(batch.column("vec"), dim), batch.column("label").to_numpy()
                low_, high_ = batch.column("low").to_pylist(), batch.column("high").to_pylist()
                at, cell, number, need = [], [], [], []
                for i in range(len(q)):
                    scores = products(g["x"], q[i], exact)
                    fits = (g["labels"] == label[i]) == same_label
                    windows = [_sampled(scores[fits], k, a, b) for a, b in zip(low_[i], high_[i])]
                    open_ = np.ones(len(g["cells"]), bool)
                    if exact:
                        least, most = ball_bounds(g["centres"] @ q[i], g["radius"], float(q[i] @ q[i]), top)
                        open_ = np.any([(most >= a) & (least <= b) for a, b in zip(windows, high_[i])], axis=0)
                    for v in np.flatnonzero(open_):
                        for p in range(g["cells"][v][1]):
                            at.append(i), cell.append(g["cells"][v][0]), number.append(p), need.append(windows)
                rows = pa.array(at, pa.int64())
                yield {"cell": pa.array(cell, pa.int32()), "part": pa.array(number, pa.int32()), "need": pa.array(need, pa.list_(pa.int64())),
                       **{name: batch.column(name).take(rows) for name in ("key", "label", "vec", "low", "high")}}

        def run(batches):
            tree = None
            for batch in batches:
                rows = [batch.column(name).to_pylist() for name in ("tree", *asked_for.names)]
                out, waiting = [], []

                def answer():
                    windows = [[Best(k, max(a, b), h) for a, b, h in zip(*x[3:])] for x in waiting]
                    descend(tree, np.array([x[2] for x in waiting]), np.array([x[1] for x in waiting], np.int64), windows, same_label)
                    for x, mine in zip(waiting, windows):
                        out.extend((x[0], x[1], w, v, max(-_LONG, min(_LONG, -s)), same)
                                   for w, window in enumerate(mine) for s, v, same in window.found)
                    waiting.clear()

                for raw, key, label_, q, low_, high_, need in zip(*rows):
                    if raw is not None or len(waiting) == TOGETHER:
                        if waiting:
                            answer()
                    if raw is not None:
                        tree = pickle.loads(raw)
                        tree.x = tree.x.astype(np.float32 if tree.top < 1 << 24 else float)  # either holds all sums exactly
                    else:
                        waiting.append((key, label_, q, low_, need, high_))
                if waiting:
                    answer()
                columns = list(zip(*out)) if out else [[]] * 6
                yield dict(zip(("key", "label", "window", "vec_id", "score", "same"), columns))

        visits = c.over_batches(queries, route, "cell int, part int, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in asked_for))
        both = visits.select("cell", "part", block, F.lit(None).cast("binary").alias("tree"), *asked_for.names).unionByName(
            trees.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))), allowMissingColumns=True)
        # a tree, then its queries, as they come
        both = both.repartition(tasks, "cell", "part", "block").sortWithinPartitions("cell", "part", "block", F.col("tree").isNull())
        found = c.over_batches(both, run, "key string, label long, window int, vec_id long, score long, same boolean")
        best = W.partitionBy("key", "label", "window").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("_n", F.row_number().over(best)).filter(F.col("_n") <= k)

    def as_queries(rows: DataFrame, windows: Column) -> DataFrame:
        return rows.withColumn("w", windows).select(
            "key", "label", "vec", F.transform("w", lambda x: x["low"]).alias("low"), F.transform("w", lambda x: x["high"]).alias("high"),
            F.transform("w", lambda x: x["low"]).alias("need"))

    open_window = F.array(F.struct(F.lit(-_LONG - 1).alias("low"), F.lit(_LONG).alias("high")))
    wanted = index.filter("asked").select("key", "label", "vec")
    listed = F.array_sort(F.collect_list(F.struct("_n", "vec_id", "score", "same")))
    near = search(as_queries(wanted, open_window), positives + 1, True).groupBy("key", "label").agg(listed.alias("near"))
    near = c.materialise(near, "negatives-positives")
    # windows of the different scores of a query's positives, by place in the sorted list
    different = F.array_sort(F.array_distinct(F.transform("near", lambda x: x["score"])))
    bounds = near.withColumn("scores", F.filter(different, lambda s: s >= 0))
    limit = F.lit(whole).cast("decimal(38,0)")
    low_of = lambda s: F.ceil(s.cast("decimal(30,0)") * F.lit(low) / limit).cast("long")
    high_of = lambda s: F.floor(s.cast("decimal(30,0)") * F.lit(high) / limit).cast("long")
    windows = F.transform("scores", lambda s: F.struct(low_of(s).alias("low"), high_of(s).alias("high")))
    hard = search(as_queries(wanted.join(bounds, ["key", "label"]).filter(F.size("scores") > 0), windows), negatives, False)
    hard = hard.groupBy("key", "label").agg(F.array_sort(F.collect_list(F.struct("window", "_n", "vec_id", "score"))).alias("hard"))
    lists = c.materialise(bounds.join(hard, ["key", "label"]), "negatives-lists")
    guide.unpersist()

    own = F.filter("near", lambda p: ~(p["same"] & (p["vec_id"] == F.col("anchor_id"))))
    pairs = anchors.join(lists, ["key", "label"]).select("anchor_id", "hard", "scores", F.explode(F.slice(own, 1, positives)).alias("p"))
    place = (F.array_position("scores", F.col("p.score")) - 1).cast("int")
    pairs = pairs.withColumn("place", place).select("anchor_id", "p", F.explode(F.filter("hard", lambda h: h["window"] == F.col("place"))).alias("h"))
    return pairs.select("anchor_id", F.col("p.vec_id").alias("positive_id"), F.col("h._n").cast("int").alias("rank"),
                        F.col("h.vec_id").alias("negative_id"), F.col("p.score").alias("positive_score"), F.col("h.score").alias("negative_score"))


def _sampled(scores: np.ndarray, k: int, low: int, high: int) -> int:
    """A score that the window's ``k``-th best row reaches at least."""
    inside = scores[(scores >= low) & (scores <= high)]
    if len(inside) < k:
        return low
    return max(low, int(sorted(inside)[-k] if scores.dtype == object else np.partition(inside, -k)[-k]))


def _matrix(column, dim: int) -> np.ndarray:
    if not len(column):
        return np.zeros((0, dim))
    if isinstance(column, pa.Array):
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)
    return np.array(column.tolist(), float).reshape(len(column), dim)


def _small(x: np.ndarray) -> np.ndarray:
    """Whole numbers in as few bytes as they need."""
    most = np.abs(x).max(initial=0)
    return x.astype(np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else float)
