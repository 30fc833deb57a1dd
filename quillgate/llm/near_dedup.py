"""Near-duplicates by improved consistent weighted sampling.

A text is a bag of five-word shingles.  A shingle weighs its count in the text
times its inverse document frequency, taken as the mean of its words': the
document frequency of a whole shingle would sink with the size of a group of
near copies and drown what they share.  HASHES weighted samples make a sketch;
two sketches agree in one sample with the probability of the weighted Jaccard
similarity.  BANDS of ROWS samples name buckets, and pairs from a bucket are
verified by the exact weighted Jaccard similarity.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from quillgate.llm import common as c
from quillgate.llm.components import components

SHINGLE = 5
BANDS, ROWS = 15, 4  # misses a pair of similarity 0.8 in 1 of 3000 cases, of 0.9 in 1 of 10**7
HASHES = BANDS * ROWS
SIMILARITY = 0.8
#: of HASHES samples, so many must agree before texts are compared; a pair of
#: similarity 0.8 has fewer in 1 of 10**6 cases
AGREE = 33
WORD_BUCKETS = 1 << 16
#: members of a bucket that are compared with as many others at a time
TILE = 128
#: ids of this many bytes at most are broadcast to fetch their texts
BROADCAST_BYTES = 32 << 20
_TABLE_BITS = 16
#: bytes sketched at a time: they fit the processor's cache
SKETCH_BYTES = 1 << 18


def _draws() -> tuple[np.ndarray, ...]:
    """r, 1 / r, beta and ln c - r + r * beta for each of 2**16 places, and a
    multiplier for each hash: a shingle's place depends on shingle and hash."""
    draw = np.random.default_rng(20)
    n = 1 << _TABLE_BITS
    r = draw.gamma(2.0, 1.0, n)
    beta = draw.random(n)
    level = np.log(draw.gamma(2.0, 1.0, n)) - r + r * beta
    return (r.astype(np.float32), (1 / r).astype(np.float32), beta.astype(np.float32), level.astype(np.float32), draw.integers(1, 1 << 62, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1))


_DRAWS = _draws()


def _document_frequency(batches):
    total, texts = np.zeros(WORD_BUCKETS, np.int64), 0
    for batch in batches:
        for part in c.slices(c.as_bytes(batch.column("text"))):
            starts, ends, text = part.words()
            word = (part.hashes(part.lower(), starts, ends) >> np.uint64(48)).astype(np.int64)
            total += np.bincount(np.unique(text * WORD_BUCKETS + word) % WORD_BUCKETS, minlength=WORD_BUCKETS)
            texts += part.n
    at = np.flatnonzero(total)
    yield {"bucket": np.append(at, -1), "n": np.append(total[at], texts)}


def inverse_frequency(docs: DataFrame, text: str = "text") -> np.ndarray:
    """ln(1 + texts / texts with the word) by word bucket, over all texts."""
    got = c.over_batches(c.narrow(docs, text=text), _document_frequency, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    bucket, n = got["bucket"].to_numpy(np.int64), got["n"].to_numpy(np.float64)
    out = np.zeros(WORD_BUCKETS)
    out[bucket[bucket >= 0]] = n[bucket >= 0]
    return np.log1p(max(1.0, n[bucket < 0].sum()) / np.maximum(out, 1)).astype(np.float32)


def bags(part: c.Slice, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle, weight), sorted by text and shingle.

    A text of fewer than five words is one shingle; without words it has none."""
    starts, ends, text = part.words()
    h = part.hashes(part.lower(), starts, ends)
    if not len(h):
        return text, h, np.zeros(0, np.float32)
    value = idf[(h >> np.uint64(48)).astype(np.int64)]
    first = np.flatnonzero(np.diff(text, prepend=-1))
    number = np.arange(len(h)) - np.repeat(first, np.diff(np.append(first, len(h))))
    size = np.repeat(np.diff(np.append(first, len(h))), np.diff(np.append(first, len(h))))
    begins = np.flatnonzero((number + SHINGLE <= size) | ((number == 0) & (size < SHINGLE)))
    length = np.minimum(size[begins], SHINGLE)
    sums = np.concatenate([[0.0], np.cumsum(value, dtype=np.float64)])
    weight = (sums[begins + length] - sums[begins]) / length
    padded = np.concatenate([h, np.zeros(SHINGLE, np.uint64)])
    s = length.astype(np.uint64)
    for j in range(SHINGLE):
        s = s * np.uint64(0x9E3779B97F4A7C15) + np.where(j < length, padded[begins + j], np.uint64(0))
    s = c.mix(s) >> np.uint64(16)
    owner = text[begins]
    order = np.lexsort((s, owner))
    s, owner, weight = s[order], owner[order], weight[order]
    at = np.flatnonzero((np.diff(s, prepend=s[0] + np.uint64(1)) != 0) | (np.diff(owner, prepend=-1) != 0))
    count = np.diff(np.append(at, len(s)))
    return owner[at], s[at], np.round(count * weight[at], 4).astype(np.float32)


def sketches(part: c.Slice, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(texts with words, their samples as 32-bit numbers)."""
    owner, s, weight = bags(part, idf)
    first = np.flatnonzero(np.diff(owner, prepend=-1))
    sizes = np.diff(np.append(first, len(owner)))
    out = np.zeros((len(first), HASHES), np.uint32)
    if not len(first):
        return owner[first], out
    r, inverse, beta, level, multiplier = _DRAWS
    ln_w = np.log(weight)
    group = np.repeat(np.arange(len(first)), sizes)
    for k in range(HASHES):
        place = (s * multiplier[k]) >> np.uint64(64 - _TABLE_BITS)
        place = place.astype(np.int64)
        step = np.floor(ln_w * inverse[place] + beta[place])
        a = level[place] - r[place] * step
        win = np.flatnonzero(a == np.minimum.reduceat(a, first)[group])
        win = win[np.flatnonzero(np.diff(group[win], prepend=-1))]  # of equal ones the least shingle
        mark = c.mix(s[win] ^ (step[win].astype(np.int64).astype(np.uint64) << np.uint64(48)))
        out[:, k] = (mark >> np.uint64(32)).astype(np.uint32)
    return owner[first], out


def similarity(x: tuple[np.ndarray, np.ndarray], y: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two bags (sorted shingles, weights)."""
    _, i, j = np.intersect1d(x[0], y[0], assume_unique=True, return_indices=True)
    a, b = x[1].astype(float), y[1].astype(float)
    common = np.minimum(a[i], b[j]).sum()
    whole = a.sum() + b.sum() - common
    return float(common / whole) if whole else 0.0


def sketched(docs: DataFrame, idf: np.ndarray, doc_id: str, text: str) -> DataFrame:
    """(id, key, sketch, bands) of the rows that have an id and a word.  The
    sketch has the low byte of each sample: equal samples stay equal."""
    shared = docs.sparkSession.sparkContext.broadcast(idf)
    rows = docs.filter(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("id"), F.md5(F.col(text)).alias("key"), F.col(text).alias("text"))

    def run(batches):
        for batch in batches:
            for part in c.slices(c.as_bytes(batch.column("text")), SKETCH_BYTES):
                at, marks = sketches(part, shared.value)
                band = np.zeros((len(at), BANDS), np.uint64)
                for j in range(ROWS):
                    band = band * np.uint64(0x9E3779B97F4A7C15) + marks[:, j::ROWS]
                rows = pa.array(at + part.lo)
                yield {"id": batch.column("id").take(rows), "key": batch.column("key").take(rows),
                       "sketch": [m.tobytes() for m in marks.astype(np.uint8)], "bands": list(c.mix(band).view(np.int64))}

    return c.over_batches(rows, run, f"id {dict(rows.dtypes)['id']}, key string, sketch binary, bands array<long>")


def verified(pairs: DataFrame, texts: DataFrame, idf: np.ndarray, least: float) -> DataFrame:
    """(x, p) of ``pairs`` whose texts are similar enough."""
    shared = pairs.sparkSession.sparkContext.broadcast(idf)
    joined = pairs.join(texts.select(F.col("id").alias("x"), F.col("text").alias("text_x")), "x")
    joined = joined.join(texts.select(F.col("id").alias("p"), F.col("text").alias("text_p")), "p")

    def run(batches):
        for batch in batches:
            left, right = c.as_bytes(batch.column("text_x")), c.as_bytes(batch.column("text_p"))
            held: dict[bytes, tuple] = {}
            good = []
            for x, p in zip(left, right):
                two = []
                for t in (x, p):
                    if t not in held:
                        if len(held) > 200:
                            held.clear()
                        held[t] = bags(c.Slice([t], 0, 1), shared.value)[1:]
                    two.append(held[t])
                good.append(similarity(*two) >= least)
            keep = pa.array(good, pa.bool_())
            yield {"x": batch.column("x").filter(keep), "p": batch.column("p").filter(keep)}

    kind = dict(pairs.dtypes)["x"]
    return c.over_batches(joined.select("x", "p", "text_x", "text_p"), run, f"x {kind}, p {kind}").distinct()


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs`` with an id: doc_id and class_id, the least
    id of all that are linked with it directly or over others.

    Linked are equal texts and texts of weighted Jaccard similarity ``least``
    or more.  Null and empty texts, and those of white space, are linked with
    nothing.  Rows that repeat an id are one document.  Rows without an id
    can't be named and are left out.

    Equal texts are one candidate.  In each bucket all others are compared
    with one pivot, then those outside the bucket's largest class with all
    members of other classes.  So every pair of a bucket has been compared or
    lies in one class, in two steps for any number of classes.
    """
    idf = inverse_frequency(docs, text)
    rows = c.materialise(sketched(docs, idf, doc_id, text), "dedup-sketches")
    heads = rows.groupBy("key").agg(F.min(F.struct("id", "sketch", "bands")).alias("h"))
    heads = c.materialise(heads.select("key", "h.*"), "dedup-heads")
    members = heads.select("id", F.posexplode("bands").alias("band", "hash"))
    buckets = members.groupBy("band", "hash").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("p")).filter("n > 1")
    buckets = c.materialise(buckets.select("band", "hash", "p"), "dedup-buckets")
    active = c.materialise(members.join(buckets, ["band", "hash"]), "dedup-members")
    sketch = c.materialise(heads.select("id", "sketch").join(active.select("id").distinct(), "id", "left_semi"), "dedup-shared")
    texts = fetched(docs, sketch.select("id"), doc_id, text)

    picks = active.filter("id <> p").select(F.col("id").alias("x"), "p").distinct()
    links = c.materialise(verified(like(picks, sketch), texts, idf, least), "dedup-links")
    same = c.materialise(components(links, "x", "p"), "dedup-classes")
    more = c.materialise(across(active, same, sketch, texts, idf, least), "dedup-links")
    if not more.isEmpty():
        stars = same.select(F.col("node").alias("x"), F.col("root").alias("p"))
        same = c.materialise(components(stars.unionByName(more), "x", "p"), "dedup-classes")
    # equal texts and repeated ids on top
    head = heads.select("key", F.col("id").alias("head"))
    several = rows.groupBy("id").agg(F.count_distinct("key").alias("n")).filter("n > 1").limit(1)
    if several.isEmpty():  # each id has one head, so its class is the head's
        root = head.join(same.select(F.col("node").alias("head"), "root"), "head", "left").select(
            "key", F.coalesce("root", "head").alias("root"))
        named = rows.select("id", "key").distinct().join(c.materialise(root, "dedup-roots"), "key").select("id", "root")
    else:
        tied = rows.select("id", "key").join(head, "key").filter("id <> head").select(F.col("id").alias("x"), F.col("head").alias("p"))
        stars = same.select(F.col("node").alias("x"), F.col("root").alias("p"))
        named = components(stars.unionByName(tied), "x", "p").withColumnRenamed("node", "id")
    ids = docs.filter(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("id"))
    return ids.join(named, "id", "left").select(F.col("id").alias("doc_id"), F.coalesce("root", "id").alias("class_id"))


def fetched(docs: DataFrame, ids: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Written table of the texts of ``ids``; the ids are broadcast if few."""
    size = ids.agg(F.coalesce(F.sum(F.octet_length(F.col("id").cast("string")) + 16), F.lit(0))).first()[0]
    ids = F.broadcast(ids) if size <= BROADCAST_BYTES else ids
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(ids, "id", "left_semi")
    return c.materialise(texts, "dedup-texts")


def like(picks: DataFrame, sketch: DataFrame) -> DataFrame:
    """The pairs (x, p) of ``picks`` of which AGREE samples agree."""
    pairs = picks.join(sketch.select(F.col("id").alias("x"), F.col("sketch").alias("a")), "x")
    pairs = pairs.join(sketch.select(F.col("id").alias("p"), F.col("sketch").alias("b")), "p")

    def agree(batches):
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(x).to_pylist()), np.uint8).reshape(-1, HASHES) for x in "ab")
            keep = pa.array((a == b).sum(axis=1) >= AGREE)
            yield {"x": batch.column("x").filter(keep), "p": batch.column("p").filter(keep)}

    kind = dict(picks.dtypes)["x"]
    return c.materialise(c.over_batches(pairs.select("x", "p", "a", "b"), agree, f"x {kind}, p {kind}"), "dedup-pairs")


def across(active: DataFrame, same: DataFrame, sketch: DataFrame, texts: DataFrame, idf: np.ndarray, least: float) -> DataFrame:
    """Links (x, p) that join all classes of a bucket that have a pair which is
    similar enough, by comparing all its pairs from two classes.

    A bucket is dealt by hash into tiles of about TILE members.  Members of its
    largest class need no comparison with each other, so only the other
    members of each tile meet the tiles, each two tiles as one row.
    """
    shared = active.sparkSession.sparkContext.broadcast(idf)
    labelled = active.select("id", "band", "hash").join(same.withColumnRenamed("node", "id"), "id", "left")
    labelled = c.materialise(labelled.select("id", "band", "hash", F.coalesce("root", "id").alias("root")), "dedup-open")
    parts = labelled.groupBy("band", "hash", "root").agg(F.count(F.lit(1)).alias("n"))
    top = parts.groupBy("band", "hash").agg(
        F.count(F.lit(1)).alias("classes"), F.ceil(F.sum("n") / TILE).alias("tiles"), F.max(F.struct("n", "root")).alias("t"))
    top = top.filter("classes > 1").select("band", "hash", "tiles", F.col("t.root").alias("top_root"))
    still = labelled.join(top, ["band", "hash"]).join(sketch, "id").join(texts, "id")
    item = F.struct("id", F.xxhash64("root").alias("root"), "sketch", F.col("text").cast("binary").alias("text"),
                    (F.col("root") != F.col("top_root")).alias("out"))
    still = still.select("band", "hash", "tiles", F.pmod(F.xxhash64("id"), "tiles").alias("tile"), item.alias("m"))
    tiles = c.materialise(still.groupBy("band", "hash", "tiles", "tile").agg(F.collect_list("m").alias("m")), "dedup-tiles")
    left = tiles.select("band", "hash", "tiles", F.filter("m", lambda m: m["out"]).alias("l")).filter(F.size("l") > 0)
    left = left.select("band", "hash", "l", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("tiles") - 1)).alias("tile"))
    both = left.join(tiles.select("band", "hash", "tile", F.col("m").alias("r")), ["band", "hash", "tile"])
    names = ("id", "root", "sketch", "text")
    both = both.select(*[F.col(f"{side}.{x}").alias(f"{side}_{x}") for side in "lr" for x in names])

    def compare(batches):
        for batch in batches:
            for n in range(batch.num_rows):
                left, right = ([batch.column(f"{side}_{x}")[n].values for x in names] for side in "lr")
                i, j = joining(left, right, shared.value, least)
                if len(i):
                    yield {"x": left[0].take(pa.array(i)), "p": right[0].take(pa.array(j))}

    kind = dict(active.dtypes)["id"]
    pairs = c.over_batches(both, compare, f"x {kind}, p {kind}")
    return pairs.select(F.greatest("x", "p").alias("x"), F.least("x", "p").alias("p")).distinct()


def joining(left: list[pa.Array], right: list[pa.Array], idf: np.ndarray, least: float) -> tuple[list[int], list[int]]:
    """Places (left, right) of the links of a forest that joins the classes
    with a similar pair; each side has ids, classes, sketches and texts."""
    ls, rs = (np.frombuffer(b"".join(side[2].to_pylist()), np.uint8).reshape(-1, HASHES) for side in (left, right))
    mine, theirs = (side[1].to_numpy(zero_copy_only=False).copy() for side in (left, right))
    alike = np.count_nonzero(ls[:, None] == rs[None], axis=2) >= AGREE
    alike &= mine[:, None] != theirs[None]
    at, to = np.flatnonzero(alike.any(axis=1)), np.flatnonzero(alike.any(axis=0))
    i: list[int] = []
    j: list[int] = []
    if not len(at):
        return i, j
    sides = []
    for side, chosen in ((left, at), (right, to)):
        owner, t, v = bags(c.Slice(side[3].take(pa.array(chosen)).to_pylist(), 0, len(chosen)), idf)
        owner = chosen[owner]
        sides.append((owner, t, v, np.bincount(owner, v, len(side[0]))))
    (owner, s_all, w_all, weight), (theirs_of, t_all, v_all, whole) = sides
    first, last = np.searchsorted(owner, at, "left"), np.searchsorted(owner, at, "right")
    for x, lo, hi in zip(at, first, last):
        chosen = alike[x] & (theirs != mine[x])
        others = np.flatnonzero(chosen)
        if not len(others):
            continue
        s, w = s_all[lo:hi], w_all[lo:hi]
        use = np.flatnonzero(chosen[theirs_of])
        t = t_all[use]
        place = np.minimum(np.searchsorted(s, t), len(s) - 1)
        hit = np.flatnonzero(s[place] == t)
        common = np.bincount(theirs_of[use[hit]], np.minimum(w[place[hit]], v_all[use[hit]]), len(rs))[others]
        good = others[common >= least * (weight[x] + whole[others] - common)]
        for k in good:
            if theirs[k] != mine[x]:
                i.append(int(x))
                j.append(int(k))
                old, new = theirs[k], mine[x]
                theirs[theirs == old] = new
                mine[mine == old] = new
    return i, j


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: float = SIMILARITY) -> DataFrame:
    """The rows of ``docs`` whose id names their class; a row without an id is
    kept, of rows that repeat an id one stays."""
    kept = classes(docs, doc_id, text, least).filter("doc_id = class_id").select(F.col("doc_id").alias(doc_id)).distinct()
    named = docs.filter(F.col(doc_id).isNotNull()).join(c.materialise(kept, "dedup-kept"), doc_id, "left_semi")
    first = F.row_number().over(W.partitionBy(doc_id).orderBy(doc_id))
    named = named.withColumn("_dedup_n", first).filter("_dedup_n = 1").drop("_dedup_n")
    return named.unionByName(docs.filter(F.col(doc_id).isNull()))
