"""Toxicity: embeddings of words and their character n-grams, averaged per
document, into a linear softmax; embeddings and softmax are trained jointly.

An unseen misspelling shares most of its n-grams with the word it stands for,
so it gets nearly the same vector.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, functions as F

from quillgate.llm import common as c

GRAMS = (3, 4, 5)
BUCKETS = 1 << 17
DIM = 8
#: labelled rows of either class that training reads, about
ROWS_PER_CLASS = (1500, 2500)  # toxic, others
#: a mean over thousands of n-grams moves little; the softmax reads it enlarged
GAIN = 300.0
#: zero vectors that every average holds besides, so that a few words of a
#: short text don't decide alone
PADDING = 500
MIN_TEXTS = 8
ROUNDS = 120
RATE = 0.05
DECAY = 1e-4


@dataclass
class Model:
    embedding: np.ndarray
    softmax: np.ndarray
    bias: np.ndarray

    def bucket_logits(self) -> np.ndarray:
        """Share of each bucket in logit 1 minus logit 0: as the average and
        the softmax are linear, scoring needs only this."""
        return (self.embedding @ (self.softmax[:, 1] - self.softmax[:, 0])).astype(np.float64)


def subwords(part: c.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and text number of every word and of every n-gram of a word.

    Words are runs of letters in lower case; a boundary counts as one
    character (a byte, as all here) of the n-gram."""
    low = part.lower(latin=True)
    letter = c.LETTER[low]
    low = np.where(letter, low, 0x20).astype(np.uint8)
    starts, ends, text = part.words(letter.astype(np.uint8))
    found = [((part.hashes(low, starts, ends) >> np.uint64(20)).astype(np.int64) % BUCKETS, text)]
    if len(starts):
        # a word's n-grams begin at its left boundary and end with its right one
        size = ends - starts + 2
        at = np.repeat(starts - 1 - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        left = np.repeat(ends + 1, size) - at
        owner = np.repeat(text, size)
        padded = np.concatenate([low, np.full(max(GRAMS) + 1, 0x20, np.uint8)]).astype(np.uint32)
        for n in GRAMS:
            ok = left >= n
            p = at[ok]
            g = np.full(len(p), n, np.uint32)
            for j in range(n):
                g = g * np.uint32(0x01000193) ^ padded[p + j] * np.uint32(0x85EBCA6B)
            g ^= g >> np.uint32(15)
            found.append((((g * np.uint32(0x9E3779B1)) >> np.uint32(15)).astype(np.int64), owner[ok]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _bags(batches):
    """Distinct buckets and their shares of each text, packed."""
    for batch in batches:
        for part in c.slices(c.as_bytes(batch.column("text"))):
            bucket, text = subwords(part)
            key, n = np.unique(text * BUCKETS + bucket, return_counts=True)
            cut = np.searchsorted(key, np.arange(1, part.n) * BUCKETS)
            yield {
                "label": batch.column("label").slice(part.lo, part.n),
                "buckets": [x.tobytes() for x in np.split((key % BUCKETS).astype(np.int32), cut)],
                "counts": [x.tobytes() for x in np.split(np.minimum(n, 65535).astype(np.uint16), cut)],
            }


def fit(bags: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, share: float, rounds: int = ROUNDS, rate: float = RATE, seed: int = 3) -> Model:
    """Adam over embeddings and softmax; ``share``: of label 1 among all
    labelled rows, to which the bias is set back at the end.

    N-grams of fewer than MIN_TEXTS texts keep a zero vector: they would only
    learn single texts by heart."""
    draw = np.random.default_rng(seed)
    totals = np.array([n.sum() + PADDING for _, n in bags], np.float32)
    texts = np.bincount(np.concatenate([b for b, _ in bags]), minlength=BUCKETS)
    common = [texts[b] >= min(MIN_TEXTS, len(bags) // 50 + 1) for b, _ in bags]
    bags = [(b[k], n[k]) for (b, n), k in zip(bags, common)]
    sizes = np.array([len(b) for b, _ in bags])
    keep = sizes > 0
    bags, y, sizes, totals = [b for b, k in zip(bags, keep) if k], y[keep], sizes[keep], totals[keep]
    index = np.concatenate([b for b, _ in bags])
    used = np.flatnonzero(np.bincount(index, minlength=BUCKETS))
    place = np.zeros(BUCKETS, np.int32)
    place[used] = np.arange(len(used))
    index = place[index]
    weight = np.concatenate([n for _, n in bags]).astype(np.float32) * np.repeat(GAIN / totals, sizes).astype(np.float32)
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    e = draw.normal(0, 0.02, (len(used), DIM))
    u = draw.normal(0, 0.3, (DIM, 2))
    bias = np.zeros(2)
    balance = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (e, u, bias)]
    for step in range(1, rounds + 1):
        # of two logits only the difference counts: softmax over (-z/2, z/2)
        s = (e @ (u[:, 1] - u[:, 0])).astype(np.float32)
        z = np.add.reduceat(weight * s[index], first) + (bias[1] - bias[0])
        d = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - y) * balance
        pull = np.bincount(index, np.repeat(d.astype(np.float32), sizes) * weight, len(used))
        pulls = np.stack([-pull, pull], axis=1)
        slopes = (pulls @ u.T + DECAY * e, e.T @ pulls + 1e-4 * u, np.array([-d.sum(), d.sum()]))
        for value, slope, m in zip((e, u, bias), slopes, state):
            m[0] *= 0.9
            m[0] += 0.1 * slope
            m[1] *= 0.99
            m[1] += 0.01 * slope * slope
            value -= rate * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.99**step)) + 1e-9)
    share = min(max(share, 1e-4), 1 - 1e-4)
    bias = bias + np.array([0.0, np.log(share / (1 - share))])  # the loss weighs both classes alike
    full = np.zeros((BUCKETS, DIM), np.float32)
    full[used] = e
    return Model(full, u, bias)


def train(labelled: DataFrame, rows_per_class: tuple[int, int] = ROWS_PER_CLASS) -> Model | float:
    """Learn from ``labelled`` (text, label).  Rows with a null label are left
    out; with one class only the model is that class's share, without rows 0."""
    labelled = labelled.filter(F.col("label").isNotNull()).select("text", F.col("label").cast("int").alias("label"))
    n1, n = labelled.agg(F.sum((F.col("label") == 1).cast("int")), F.count(F.lit(1))).first()
    n1 = n1 or 0
    if not n or n1 in (0, n):
        return float(n1 / n) if n else 0.0
    sample = labelled.filter(
        ((F.col("label") == 1) & c.picked(rows_per_class[0] / n1, "text", seed="toxic"))
        | ((F.col("label") != 1) & c.picked(rows_per_class[1] / (n - n1), "text", seed="other"))
    )
    got = c.over_batches(sample, _bags, "label int, buckets binary, counts binary").toPandas()
    bags = [(np.frombuffer(b, np.int32), np.frombuffer(k, np.uint16)) for b, k in zip(got["buckets"], got["counts"])]
    y = (got["label"].to_numpy() == 1).astype(int)
    if len({int(v) for v, (b, _) in zip(y, bags) if len(b)}) < 2:
        return float(n1 / n)
    return fit(bags, y, n1 / n)


def score(docs: DataFrame, model: Model | float, doc_id: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """doc_id, score (0 to 1) and predicted of every row of ``docs``.

    A null text, an empty one and one without letters get the score of the
    bias alone; repeated rows give repeated results; a null id is passed on.
    """
    plain = model if isinstance(model, float) else (model.bucket_logits(), float(model.bias[1] - model.bias[0]))
    shared = docs.sparkSession.sparkContext.broadcast(plain)
    rows = c.narrow(docs, doc_id=doc_id, text=text)

    def run(batches):
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for part in c.slices(c.as_bytes(batch.column("text"))):
                if isinstance(shared.value, float):
                    out[part.lo : part.hi] = shared.value
                    continue
                logits, bias = shared.value
                bucket, owner = subwords(part)
                n = np.bincount(owner, minlength=part.n)
                z = GAIN * np.bincount(owner, logits[bucket], part.n) / (n + PADDING) + bias
                out[part.lo : part.hi] = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
            yield {"doc_id": batch.column("doc_id"), "score": out, "predicted": (out >= threshold).astype(np.int32)}

    return c.over_batches(rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, score double, predicted int")
