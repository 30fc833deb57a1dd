"""Benchmark decontamination by latent semantic retrieval.

Documents and benchmark items are cut into overlapping passages of 32 words.
A randomised SVD of their TF-IDF rows gives a latent space; passages near an
item's passage by cosine are candidates, and the longest common subsequence of
words, together with a look for the item's answer, decides.  A passage very near
an item that also holds its answer needs few words in the item's order: that is
how reworded copies are found.

Only words that occur in the benchmark and are not common in the corpus can
tell; all others count in a passage's norm alone.

What the cosine misses is found by words: a copy holds at least so many of an
item's words that one of its rarest is among them, whatever surrounds it and
however common they are.  So an index of these gives all places to count the
item's words at, and where there are enough, the subsequence decides as well.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quillgate.llm import common as c

HALF = 16  # passages are two halves long and begin at every half
BUCKETS = 1 << 18
RANK, OVERSAMPLE = 96, 8
#: rows of the basis that travel as one row of a sum
PACK = 256
#: items that one pass over the documents looks for
BLOCK_ITEMS = 2000
COMMON = 2.5  # least inverse document frequency of a word that can tell
COSINE = 0.5
TELLING = 0.4  # least share of a passage's norm in words that can tell, for the cosine search
COPIED, PARAPHRASED = 0.7, 0.5  # share of the item's words in the common subsequence; the latter with the answer
REWORDED, NEAR = 0.3, 0.6  # or this share and the answer in a passage of at least this cosine
ANSWER = 0.8
RAREST = 3  # of an item's rarest words, at least, around a place that is looked at
SHORT = 5  # items of fewer words must occur whole

MATCH = "array<struct<item_id:{},cosine:double,lcs:double,answer:boolean>>"


@dataclass
class Item:
    """An item's id, its words, those of its answer, and its first passage."""

    id: object
    words: list[int]
    answer: list[int]

    @cached_property
    def known(self) -> set[int]:
        return {*self.words, *self.answer}


@dataclass
class Model:
    items: list[Item]
    idf: np.ndarray  # by bucket; 0: cannot tell
    rare: float  # weight of a word that is not in the benchmark
    row_of: np.ndarray  # row of the basis by bucket
    basis: np.ndarray  # (rows, rank)
    passages: np.ndarray  # (passages, rank), unit length
    owner: np.ndarray  # item number of each passage
    count: np.ndarray  # document frequency by bucket
    cosine: float = COSINE  # least cosine of a candidate

    @cached_property
    def index(self) -> "Index":
        return Index.of(self.items, self.count)


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values; quicker than hashing them."""
    x = np.sort(x)
    return x[np.flatnonzero(np.diff(x, prepend=-1))]


@dataclass
class Index:
    """Where an item can be: each match holds one of its rarest words."""

    word: np.ndarray  # number of a benchmark word by bucket; 0: none
    first: np.ndarray  # first posting of each word, and the end
    item: np.ndarray  # item of each posting
    rarest: np.ndarray  # whether a match must have one of these
    key: np.ndarray  # item and word of every word of an item, sorted
    times: np.ndarray  # how often the item has it
    size: np.ndarray  # words of each item
    need: np.ndarray  # words of each item that a match has at least
    least: np.ndarray  # of its rarest words, that is

    @classmethod
    def of(cls, items: list[Item], count: np.ndarray) -> "Index":
        words = [bucket(np.array(i.words, np.uint64)) for i in items]
        used = np.unique(np.concatenate([np.zeros(0, np.int64), *words]))
        word = np.zeros(BUCKETS, np.int32)
        word[used] = 1 + np.arange(len(used))
        size = np.array([len(w) for w in words], np.int64)
        need = np.where(size < SHORT, size, np.ceil(size * PARAPHRASED - 1e-9).astype(np.int64))
        # a match lacks at most size - need words, so of this many more it has as many
        least = np.minimum(RAREST, need)
        postings, keys, times = [np.zeros((0, 3), np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for n, b in enumerate(words):
            k, c_ = np.unique(word[b], return_counts=True)
            keys.append(n * (len(used) + 1) + k.astype(np.int64))
            times.append(c_)
            rare = word[b[np.argsort(count[b], kind="stable")]]
            mine = np.unique(rare[: size[n] - need[n] + least[n]])
            postings.append(np.stack([mine, np.full(len(mine), n), np.isin(mine, rare[: size[n] - need[n] + 1])], axis=1))
        post = np.concatenate(postings)
        post = post[np.argsort(post[:, 0], kind="stable")]
        return cls(word, np.searchsorted(post[:, 0], np.arange(len(used) + 2)), post[:, 1],
                   post[:, 2] > 0, np.concatenate(keys), np.concatenate(times), size, need, least)

    def places(self, b: np.ndarray, cut: "Halves", begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(halves, items) at which the words around, as ``region`` takes them,
        hold enough of the item's; b: bucket of each word."""
        word = self.word[b]
        hits = np.flatnonzero(self.first[word + 1] > self.first[word])
        some = self.first[word[hits] + 1] - self.first[word[hits]]
        at = np.repeat(self.first[word[hits]] - np.cumsum(some) + some, some) + np.arange(some.sum())
        posted = self.item[at]
        must = self.rarest[at]
        pairs = distinct(np.repeat(cut.of_word[hits], some)[must] * len(self.size) + posted[must])
        # cheap first: how many of the item's rarest words are around
        half, item = np.divmod(pairs, max(1, len(self.size)))
        text = cut.text[half]
        a, z = region(cut.word[half], self.size[item], begin[text], end[text])
        hit = np.sort(posted * len(b) + np.repeat(hits, some))
        near = np.searchsorted(hit, item * len(b) + z) - np.searchsorted(hit, item * len(b) + a)
        pairs = pairs[near >= self.least[item]]
        found, width = [np.zeros(0, np.int64)], len(self.first) - 1
        for lo in range(0, len(pairs), 20_000):
            half, item = np.divmod(pairs[lo : lo + 20_000], len(self.size))
            text = cut.text[half]
            a, z = region(cut.word[half], self.size[item], begin[text], end[text])
            pair = np.repeat(np.arange(len(half)), z - a)
            place = np.repeat(a - np.cumsum(z - a) + (z - a), z - a) + np.arange(len(pair))
            w = word[place]
            known = w > 0  # the benchmark's
            pair, w = np.divmod(distinct(pair[known] * width + w[known]), width)
            key = item[pair] * width + w
            at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
            number = np.bincount(pair, np.where(self.key[at] == key, self.times[at], 0), len(half))
            found.append(pairs[lo : lo + 20_000][number >= self.need[item]])
        return np.divmod(np.concatenate(found), max(1, len(self.size)))


def word_hashes(part: c.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each word: runs of letters and digits, in lower case."""
    low = part.lower(latin=True)
    kind = (c.LETTER | c.DIGIT)[low].astype(np.uint8)
    starts, ends, text = part.words(kind)
    return part.hashes(low, starts, ends), text


def of_text(text: str) -> list[int]:
    return word_hashes(c.Slice([text.encode()], 0, 1))[0].tolist()


def answer_of(text: str) -> str:
    """The last sentence; of a single sentence the last five words."""
    parts = [p for p in re.split(r"(?<=[.?!])\s+|\n", text.strip()) if re.search(r"\w", p)]
    return parts[-1] if len(parts) > 1 else " ".join(text.split()[-5:])


def bucket(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(40)).astype(np.int64) % BUCKETS


def region(word, size, begin, end):
    """First and last (exclusive) of the words that are held against an item of
    ``size`` words for a passage from ``word`` on, within its text."""
    return np.maximum(begin, word - size), np.minimum(end, word + 2 * HALF + size)


def lcs(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence; one bit for each word of b."""
    places: dict[int, int] = {}
    for i, w in enumerate(b):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(b)) - 1
    row = full
    for w in a:
        hit = row & places.get(w, 0)
        if hit:
            row = (row + hit | row - hit) & full
    return len(b) - row.bit_count()


@dataclass
class Halves:
    """The halves of all texts of a slice."""

    text: np.ndarray  # text number of each half
    word: np.ndarray  # first word of each half
    of_word: np.ndarray  # half of each word


def halves(text: np.ndarray) -> Halves:
    first = np.flatnonzero(np.diff(text, prepend=-1))
    number = np.arange(len(text)) - np.repeat(first, np.diff(np.append(first, len(text))))
    begin = np.flatnonzero(number % HALF == 0)
    return Halves(text[begin], begin, np.cumsum(number % HALF == 0) - 1)


def passages(h: Halves) -> np.ndarray:
    """First and last half of every passage."""
    n = len(h.text)
    follow = np.zeros(n, bool)
    follow[:-1] = h.text[1:] == h.text[:-1]
    alone = ~follow
    alone[1:] &= ~follow[:-1]
    at = np.flatnonzero(follow | alone)
    return np.stack([at, at + follow[at]], axis=1)


def _rows(h: np.ndarray, text: np.ndarray, idf: np.ndarray, rare: float, least: float):
    """Passages of a slice (word hashes, and the text of each) in which words that
    can tell have at least the share ``least`` of the norm: (halves, passages,
    norms, latent entries as (passage, bucket, weight))."""
    cut = halves(text)
    b = bucket(h)
    weight = idf[b]
    tells = weight > 0
    energy = np.bincount(cut.of_word, np.where(tells, weight, 0.0) ** 2, len(cut.text))
    whole = np.bincount(cut.of_word, np.where(weight > 0, weight, np.where(weight < 0, 0.5, rare)) ** 2, len(cut.text))
    two = passages(cut)
    both = two[:, 0] != two[:, 1]
    e = energy[two[:, 0]] + np.where(both, energy[two[:, 1]], 0)
    norm = np.sqrt(whole[two[:, 0]] + np.where(both, whole[two[:, 1]], 0))
    keep = e >= (least * norm) ** 2
    keep &= e > 0
    two, norm = two[keep], norm[keep]
    # words of a passage: those of its first half, then of its last
    told = np.flatnonzero(tells)
    edge = np.searchsorted(told, np.append(cut.word, len(h)))
    rows, words = [], []
    for side in (0, 1):
        pick = np.flatnonzero(both[keep]) if side else np.arange(len(two))
        half = two[pick, side]
        size = edge[half + 1] - edge[half]
        offset = np.repeat(edge[half] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) if len(pick) else np.zeros(0, int)
        words.append(told[offset + np.arange(size.sum())])
        rows.append(np.repeat(pick, size))
    row, word = np.concatenate(rows), np.concatenate(words)
    return cut, two, norm, row, b[word], weight[word]


def project(basis: np.ndarray, n: int, row: np.ndarray, b: np.ndarray, w: np.ndarray) -> np.ndarray:
    order = np.argsort(row, kind="stable")
    return c.per_text(basis[b[order]] * w[order][:, None], row[order], n)


def _frequency(telling: np.ndarray):
    def run(batches):
        total, texts = np.zeros(BUCKETS, np.int64), 0
        for batch in batches:
            for part in c.slices(c.as_bytes(batch.column("text"))):
                h, text = word_hashes(part)
                b = bucket(h)
                ok = telling[b]
                total += np.bincount(distinct(text[ok] * BUCKETS + b[ok]) % BUCKETS, minlength=BUCKETS)
                texts += part.n
        at = np.flatnonzero(total)
        yield {"bucket": np.append(at, -1), "n": np.append(total[at], texts)}

    return run


def _latent(idf: np.ndarray, rare: float, row_of: np.ndarray):
    """The passages' rows, by slice: (passage, row of the basis, weight) packed."""

    def run(batches):
        for batch in batches:
            for part in c.slices(c.as_bytes(batch.column("text"))):
                _, two, norm, row, bk, w = _rows(*word_hashes(part), idf, rare, TELLING)
                if len(two):
                    order = np.argsort(row, kind="stable")
                    row, at, w = row[order], row_of[bk[order]], (w / norm[row])[order]
                    yield {"n": [len(two)], "row": [row.astype(np.int32).tobytes()], "at": [at.tobytes()],
                           "w": [w.astype(np.float32).tobytes()]}

    return run


def _blocks(total: np.ndarray):
    """The rows of a sum that are not 0, PACK to a block, as columns."""
    some = [at for at in range(0, len(total), PACK) if total[at : at + PACK].any()]
    return {"at": some, "x": [total[at : at + PACK].astype(np.float32).tobytes() for at in some]}


def _add(batches):
    """Sums of packed blocks, one batch after the other."""
    sums: dict[int, np.ndarray] = {}
    for batch in batches:
        for at, x in zip(batch.column("at").to_pylist(), batch.column("x").to_pylist()):
            x = np.frombuffer(x, np.float32)
            sums[at] = sums[at] + x if at in sums else x.astype(np.float64)
    for at, x in sums.items():
        yield {"at": [at], "x": [x.tobytes()]}


def fit(docs: DataFrame, items: list[tuple[object, str]], text: str = "text") -> Model:
    """Model for one block of items.

    Document frequencies and the latent space come from the passages of all
    texts.  These are written once as sparse rows.  Every product with them is
    summed on executors by blocks of rows, and the driver gets one matrix of a
    row for each word of these items (at most BUCKETS) and RANK columns."""
    spark = docs.sparkSession
    docs = c.narrow(docs, text=F.coalesce(F.col(text), F.lit("")))
    known = [Item(i, of_text(t or ""), of_text(answer_of(t or ""))) for i, t in items]
    known = [i for i in known if i.words]
    telling = np.zeros(BUCKETS, bool)
    for i in known:
        telling[bucket(np.array(i.words, np.uint64))] = True
    got = c.over_batches(docs, _frequency(telling), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    b, n = got["bucket"].to_numpy(np.int64), got["n"].to_numpy(np.float64)
    total = max(2.0, n[b < 0].sum())
    count = np.zeros(BUCKETS)
    count[b[b >= 0]] = n[b >= 0]
    rare = float(np.log1p(total))
    idf = np.where(telling, np.log1p(total / np.maximum(count, 1)), 0.0)
    idf[(idf > 0) & (idf < COMMON)] = -1.0  # known, but cannot tell

    raw = [t.encode() for _, t in items if of_text(t or "")]
    mine = _rows(*word_hashes(c.Slice(raw, 0, len(raw))), idf, rare, 0.0) if raw else None
    rank = RANK + OVERSAMPLE
    used = np.flatnonzero(idf > 0)
    if mine is None or not len(mine[1]):
        none = np.zeros((0, 1), np.float32)
        return Model(known, idf, rare, np.zeros(BUCKETS, np.int32), none, none, np.zeros(0, int), count)
    rank = min(rank, len(used))
    row_of = np.zeros(BUCKETS, np.int32)
    row_of[used] = np.arange(len(used))
    sparse = c.materialise(c.over_batches(docs, _latent(idf, rare, row_of), "n int, row binary, at binary, w binary"), "latent-rows")
    omega = np.random.default_rng(9).normal(size=(len(used), rank)).astype(np.float32)

    def product(m: np.ndarray, n: int, row: np.ndarray, at: np.ndarray, w: np.ndarray, gram: bool) -> np.ndarray:
        z = c.per_text(m[at] * w[:, None], row, n)
        if gram:
            return z.T @ z
        order = np.argsort(at, kind="stable")
        return c.per_text((z[row] * w[:, None])[order], at[order], len(m))

    def power(m: np.ndarray, gram: bool) -> np.ndarray:
        """A'A m over all passages and the items'; with ``gram``, m'A'A m."""
        m = m.astype(np.float32)
        shared = spark.sparkContext.broadcast(m)

        def task(batches):
            total = None
            for batch in batches:
                packed = (batch.column(x).to_pylist() for x in ("n", "row", "at", "w"))
                for n, row, at, w in zip(*packed):
                    x = product(shared.value, n, np.frombuffer(row, np.int32), np.frombuffer(at, np.int32), np.frombuffer(w, np.float32), gram)
                    total = x if total is None else np.add(total, x, out=total)
            if total is not None:
                yield _blocks(total)

        parts = c.over_batches(sparse, task, "at int, x binary")
        got = c.over_batches(parts.repartition("at"), _add, "at int, x binary").collect()
        shared.destroy()
        out = np.zeros((m.shape[1] if gram else len(used), m.shape[1]))
        for at, x in got:
            out[at : at + PACK] += np.frombuffer(x).reshape(-1, m.shape[1])
        # the items weigh as much as the documents do
        _, two, norm, row, bk, w = mine
        order = np.argsort(row, kind="stable")
        own = product(m, len(two), row[order], row_of[bk[order]], (w / norm[row])[order], gram)
        return out + own * max(1.0, np.linalg.norm(out) / max(np.linalg.norm(own), 1e-12))

    q, _ = np.linalg.qr(power(omega, False))
    q, _ = np.linalg.qr(power(q, False))
    values, turn = np.linalg.eigh(power(q, True))
    best = np.argsort(-values)[: min(RANK, rank)]
    basis = (q @ turn[:, best]).astype(np.float32)
    _, two, norm, row, bk, w = mine
    z = project(basis, len(two), row, row_of[bk], w)
    size = np.linalg.norm(z, axis=1)
    keep = size > 1e-9
    owner = mine[0].text[two[:, 0]]
    return Model(known, idf, rare, row_of, basis, (z[keep] / size[keep][:, None]).astype(np.float32), owner[keep], count)


def similar(model: Model, words: np.ndarray, item: int) -> float:
    """Greatest cosine of a passage of these words with the item's; 0 if either
    has no word that can tell."""
    b = bucket(words)
    b = b[model.idf[b] > 0]
    mine = model.passages[model.owner == item]
    if not len(mine) or not len(b):
        return 0.0
    z = model.idf[b] @ model.basis[model.row_of[b]]
    return float((mine @ z).max() / max(np.linalg.norm(z), 1e-9))


def look(model: Model, part: c.Slice) -> dict[int, list]:
    """Matches (item id, cosine, lcs, answer) of each text of a slice."""
    out: dict[int, list] = {}
    if not model.items:
        return out
    h, text = word_hashes(part)
    first = np.searchsorted(text, np.arange(part.n))
    stop = np.searchsorted(text, np.arange(part.n), "right")
    best: dict[tuple[int, int], tuple] = {}

    def decide(t: int, item: int, word: int, cosine: float | None) -> None:
        held = best.get((t, item))
        if held and held[4]:
            return
        wanted = model.items[item]
        size = len(wanted.words)
        a, b = region(word, size, first[t], stop[t])
        # other words change no common subsequence
        words = [w for w in h[a:b].tolist() if w in wanted.known]
        # what nothing leaks without; a subsequence is no longer than the words there are
        least = 1 if size < SHORT else REWORDED if (cosine or 0) >= NEAR else PARAPHRASED
        if len(words) / size < least:
            return
        share = lcs(wanted.words, words) / size
        if share < least:
            return
        answer = bool(wanted.answer) and lcs(wanted.answer, words) >= ANSWER * len(wanted.answer)
        leak = share >= COPIED or answer and (share >= PARAPHRASED or (cosine or 0) >= NEAR)
        if size < SHORT:
            leak = share >= 1
        if not held or (leak, share) > (held[4], held[2]):
            if cosine is None:
                cosine = similar(model, h[word : min(word + 2 * HALF, int(stop[t]))], item) if leak else 0.0
            best[t, item] = (wanted.id, cosine, share, answer, leak)

    if len(model.passages):
        cut, two, _, row, bk, w = _rows(h, text, model.idf, model.rare, TELLING)
        z = project(model.basis, len(two), row, model.row_of[bk], w)
        z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)
        for lo in range(0, len(z), 2048):
            cosine = z[lo : lo + 2048].astype(np.float32) @ model.passages.T
            at, passage = np.nonzero(cosine >= model.cosine)
            for i in np.argsort(-cosine[at, passage], kind="stable"):
                p = two[lo + at[i], 0]
                decide(int(cut.text[p]), int(model.owner[passage[i]]), int(cut.word[p]), float(cosine[at[i], passage[i]]))
    cut = halves(text)
    for half, item in zip(*(x.tolist() for x in model.index.places(bucket(h), cut, first, stop))):
        decide(int(cut.text[half]), item, int(cut.word[half]), None)
    for (t, _), found in sorted(best.items()):
        if found[4]:
            out.setdefault(t, []).append(found[:4])
    return out


def matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
            keep: list[Column] | None = None, block_items: int = BLOCK_ITEMS, cosine: float = COSINE) -> DataFrame:
    """The columns of ``keep`` and ``matches`` (item_id, cosine, lcs, answer)
    for every row of ``docs``; no matches: clean.

    Null and empty texts match nothing, and items without a word are matched
    by nothing.  Repeated rows give repeated results, repeated items one match
    each.  An empty benchmark leaves every document clean.  The benchmark is
    taken in blocks of about ``block_items`` items, each of which is looked for
    in all documents.  ``cosine``: least cosine of a candidate of the latent search.
    """
    kind = dict(benchmark.dtypes)[item_id]
    schema = MATCH.format(kind)
    items = c.narrow(benchmark, id=item_id, text=item_text)
    blocks = max(1, -(-items.count() // block_items))
    rows = docs.select(F.struct(F.lit(0).alias("_0"), *(keep or [])).alias("_keep"), F.col(text).alias("text"),
                       F.array().cast(schema).alias("matches"))
    for n in range(blocks):
        mine = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(blocks)) == n).collect()
        mine = sorted(((r["id"], r["text"]) for r in mine), key=lambda r: (r[0] is None, r[0], r[1] or ""))
        model = replace(fit(docs, mine, text), cosine=cosine)
        rows = _look(rows, model, schema)
    names = [f"_keep.`{f.name}`" for f in rows.schema["_keep"].dataType.fields if f.name != "_0"]
    return rows.select(*names, "matches")


def _look(rows: DataFrame, model: Model, schema: str) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            texts = c.as_bytes(batch.column("text"))
            found: list[list] = batch.column("matches").to_pylist()
            for part in c.slices(texts):
                for t, some in look(shared.value, part).items():
                    found[part.lo + t] = found[part.lo + t] + [
                        {"item_id": i, "cosine": x, "lcs": s, "answer": a} for i, x, s, a in some]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_keep"), batch.column("text"), pa.array(found, batch.schema.field("matches").type)],
                names=["_keep", "text", "matches"])

    return rows.mapInArrow(run, f"_keep {dict(rows.dtypes)['_keep']}, text string, matches {schema}")
