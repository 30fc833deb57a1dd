"""Mixing sources to target weights by temperature.

A source's weight is its token share to the power alpha, normalised.  Alpha is
found by bisection: the largest for which the weights' entropy reaches the
target, or the smallest for which no source is repeated more often than
allowed.  Weights become token budgets, and budgets are realised as passes over
permuted blocks of each source: whole passes first, then the first documents
of the permutation, up to the budget.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

SEED = "mix-1"
STEPS = 50
#: hexadecimal digits that name a block; and one inside the block at the cut
BLOCK_DIGITS = 3


def weights(tokens: dict, alpha: float) -> dict:
    total = sum(tokens.values())
    power = {s: (n / total) ** alpha if n else 0.0 for s, n in tokens.items()}
    whole = sum(power.values())
    return {s: p / whole for s, p in power.items()}


def entropy(w: dict) -> float:
    return -sum(p * math.log(p) for p in w.values() if p > 0)


def temperature(tokens: dict, entropy_share: float | None, max_repeats: float | None, budget: int | None = None) -> float:
    """Alpha in [0, 1]: 1 keeps the shares, 0 makes all sources alike.

    ``entropy_share``: wanted entropy as a share of the way from that of the
    natural shares to that of equal ones.  ``max_repeats``: no source's budget
    may be more than this many times its tokens; it wins over the entropy.
    """
    live = {s: n for s, n in tokens.items() if n}
    if len(live) < 2:
        return 1.0
    total = budget if budget is not None else sum(live.values())

    def bisect(good) -> float:
        """Largest alpha in [0, 1] for which ``good``, which holds below it."""
        if good(1.0):
            return 1.0
        low, high = 0.0, 1.0
        for _ in range(STEPS):
            middle = (low + high) / 2
            low, high = (middle, high) if good(middle) else (low, middle)
        return low

    alpha = 1.0
    if entropy_share is not None:
        natural, flat = entropy(weights(live, 1.0)), math.log(len(live))
        goal = natural + entropy_share * (flat - natural)
        alpha = bisect(lambda a: entropy(weights(live, a)) >= goal)
    if max_repeats is not None:
        # repeats fall as alpha rises
        least = 1 - bisect(lambda b: max(total * w / live[s] for s, w in weights(live, 1 - b).items()) <= max_repeats)
        alpha = max(alpha, least)
    return alpha


def token_count(text: Column) -> Column:
    """Words of a text; none in a null one."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^ \t-\r]+")), F.lit(0)).cast("long")


def mix(
    docs: DataFrame,
    entropy_share: float | None = 0.5,
    max_repeats: float | None = 3.0,
    budget: int | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: str = SEED,
) -> DataFrame:
    """``docs`` with ``_pass`` (from 0) and ``_place`` (sorting by both gives the
    permutation of each pass), each document as often as its source's budget
    asks: (pass, place) order within a source, cut at the first document with
    which the budget is reached.

    ``budget`` is the mixture's number of tokens (default: as many as there
    are).  A null source is a source.  A document without words rides along in
    every pass of its source that reaches its place.  A source without any word
    has no weight and no rows.  Rows that are alike in id and text keep their
    copies, which share a place and are cut together.  A text's place comes
    from id and text, so nothing depends on partitions.

    The cut is found in two steps on sums by block (at most 16**BLOCK_DIGITS a
    source), and the documents of one inner block: no task orders a source.
    """
    rows = docs.select(
        F.struct(*docs.columns).alias("_row"), F.col(source).alias("_source"), token_count(F.col(text)).alias("_n"),
        F.md5(F.concat_ws("|", F.lit(seed), F.col(doc_id).cast("string"), F.md5(F.coalesce(F.col(text), F.lit(""))))).alias("_place"),
    ).withColumn("_a", F.substring("_place", 1, BLOCK_DIGITS)).withColumn("_b", F.substring("_place", BLOCK_DIGITS + 1, BLOCK_DIGITS))
    sums = rows.groupBy("_source", "_a", "_b").agg(F.sum("_n").alias("n"))
    blocks = sums.groupBy("_source", "_a").agg(F.sum("n").alias("n")).toPandas()
    tokens = {s: int(n) for s, n in blocks.groupby("_source", dropna=False)["n"].sum().items()}
    tokens = {None if s is None or s != s else s: n for s, n in tokens.items()}
    spark = docs.sparkSession
    total = sum(tokens.values())
    if not total:
        return docs.filter("false").withColumns({"_pass": F.lit(0), "_place": F.lit("")})
    goal = total if budget is None else budget
    share = weights(tokens, temperature(tokens, entropy_share, max_repeats, goal))
    plan = []  # (source, whole passes, block at the cut, tokens wanted of it)
    for s, n in tokens.items():
        if not n:
            continue
        wanted = int(round(goal * share[s]))
        passes, rest = divmod(wanted, n)
        own = blocks[blocks["_source"].isna()] if s is None else blocks[blocks["_source"] == s]
        own = own.sort_values("_a")
        before = own["n"].cumsum() - own["n"]
        cut = own[before < rest]
        plan.append((s, passes, cut["_a"].iloc[-1] if len(cut) else "", int(rest - before[cut.index[-1]]) if len(cut) else 0))
    kind = dict(docs.dtypes)[source]
    cuts = F.broadcast(spark.createDataFrame(plan, f"_source {kind}, _passes int, _cut string, _left long"))  # one row a source
    joined = F.col("r._source").eqNullSafe(F.col("p._source"))
    at_cut = sums.alias("r").join(cuts.alias("p"), joined).filter("r._a = p._cut").select("r._source", "_b", "n", "_left")
    inner = _running(at_cut, "_b").filter(F.col("_before") < F.col("_left")).groupBy("_source").agg(
        F.max(F.struct("_b", (F.col("_left") - F.col("_before")).alias("left"))).alias("x"))
    inner = inner.select("_source", F.col("x._b").alias("_inner"), F.col("x.left").alias("_more"))
    cuts2 = cuts.alias("p").join(inner.alias("i"), F.col("p._source").eqNullSafe(F.col("i._source")), "left").select(
        "p.*", "_inner", "_more")
    near = rows.select("_source", "_a", "_b", "_place", "_n").alias("r").join(F.broadcast(cuts2).alias("p"), joined)
    near = near.filter("r._a = p._cut and r._b = p._inner").groupBy("r._source", "_place", "_more").agg(F.sum("_n").alias("n"))
    last = _running(near, "_place").filter(F.col("_before") < F.col("_more")).groupBy("_source").agg(F.max("_place").alias("_end"))
    ends = cuts2.alias("p").join(last.alias("l"), F.col("p._source").eqNullSafe(F.col("l._source")), "left").select(
        "p._source", "_passes", "_end")
    mixed = rows.alias("r").join(F.broadcast(ends).alias("p"), joined)
    copies = F.col("_passes") + F.when(F.col("_place") <= F.col("_end"), 1).otherwise(0)
    passes = F.explode(F.when(copies > 0, F.sequence(F.lit(0), copies - 1)).otherwise(F.array().cast("array<int>")))
    return mixed.select("_row", "_place", passes.alias("_pass")).select("_row.*", "_pass", "_place")


def _running(rows: DataFrame, order: str) -> DataFrame:
    """Sum of ``n`` before each row of a source; the rows are one block's."""
    w = W.partitionBy("_source").orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    return rows.withColumn("_before", F.coalesce(F.sum("n").over(w), F.lit(0)))
