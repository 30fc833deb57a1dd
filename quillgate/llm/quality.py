"""Quality score: random-indexing word vectors, pooled per document, then a
two-layer network with temperature-calibrated probabilities.

Every word has a fixed sparse ternary index vector.  A word's own vector is
the sum of the index vectors of its neighbours over the whole corpus; a
document is the mean of its words' vectors.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from quillgate.llm import common as c

DIM = 32
NONZERO = 4
WINDOW = 2
BUCKETS = 1 << 14
#: labelled rows that the network is fitted on, about
TRAINING_ROWS = 12000
HIDDEN = 24
#: words that stand for a form, not for themselves: all capitals, a word that
#: repeats the one before, a number
CAPITALS, REPEATED, NUMBER, RESERVED = 0, 1, 2, 3
PUNCTUATION_KIND = np.where(c.SPACE, 0, np.where(c.LETTER | c.DIGIT, 1, 2)).astype(np.uint8)


@dataclass
class Network:
    mean: np.ndarray
    spread: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.mean) / self.spread @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -40, 40)))


def buckets(part: c.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Word bucket and text number of each word; a run of punctuation is a word."""
    starts, ends, text = part.words(PUNCTUATION_KIND[part.data])
    b = part.data
    h = part.hashes(part.lower(latin=True), starts, ends)
    out = (h % np.uint64(BUCKETS - RESERVED)).astype(np.int64) + RESERVED
    upper = np.concatenate([[0], np.cumsum((b >= 65) & (b <= 90))])
    lower = np.concatenate([[0], np.cumsum((b >= 97) & (b <= 122))])
    digit = np.concatenate([[0], np.cumsum(c.DIGIT[b])])
    out[digit[ends] - digit[starts] == ends - starts] = NUMBER
    same = (h[1:] == h[:-1]) & (text[1:] == text[:-1])
    out[1:][same] = REPEATED
    out[(upper[ends] - upper[starts] >= 2) & (lower[ends] == lower[starts])] = CAPITALS
    return out, text


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Positions and signs of the non-zero entries, by bucket."""
    draw = np.random.default_rng(11)
    return draw.integers(0, DIM, (BUCKETS, NONZERO)), draw.choice([-1.0, 1.0], (BUCKETS, NONZERO))


def _contexts(batches):
    place, sign = index_vectors()
    total = np.zeros(BUCKETS * DIM)
    for batch in batches:
        for part in c.slices(c.as_bytes(batch.column("text"))):
            word, text = buckets(part)
            for step in range(1, WINDOW + 1):
                near = text[step:] == text[:-step]
                left, right = word[:-step][near], word[step:][near]
                for a, b in ((left, right), (right, left)):
                    total += np.bincount((a[:, None] * DIM + place[b]).ravel(), sign[b].ravel(), BUCKETS * DIM)
    table = total.reshape(BUCKETS, DIM).astype(np.int64)
    at = np.flatnonzero(table.any(axis=1))
    yield {"bucket": at} | {f"c{i}": table[at, i] for i in range(DIM)}


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Unit vector of each bucket, from all texts of ``docs`` (text).

    The sums are whole numbers, so they do not depend on the partitioning;
    the driver gets one row of DIM numbers for each of at most BUCKETS."""
    names = [f"c{i}" for i in range(DIM)]
    got = (
        c.over_batches(docs.select("text"), _contexts, "bucket int, " + ", ".join(f"{n} long" for n in names))
        .groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names]).toPandas()
    )
    table = np.zeros((BUCKETS, DIM), np.float32)
    table[got["bucket"].to_numpy()] = got[names].to_numpy()
    return table / np.maximum(np.linalg.norm(table, axis=1, keepdims=True), 1e-9)


def pooled(vectors: np.ndarray, part: c.Slice) -> np.ndarray:
    """Mean word vector and log length of each text; zeros without a word."""
    word, text = buckets(part)
    n = np.bincount(text, minlength=part.n)
    mean = c.per_text(vectors[word], text, part.n) / np.maximum(n, 1)[:, None]
    return np.concatenate([mean, np.log1p(n)[:, None]], axis=1)


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 400, seed: int = 5) -> Network:
    """Network by Adam on four fifths of the rows, temperature on the rest."""
    draw = np.random.default_rng(seed)
    rest = draw.random(len(y)) < 0.2
    mean, spread = x.mean(axis=0), x.std(axis=0) + 1e-6
    net = Network(mean, spread, draw.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN),
                  draw.normal(0, HIDDEN ** -0.5, HIDDEN), 0.0, 1.0)
    a, t = (x[~rest] - mean) / spread, y[~rest].astype(float)
    moments = [[np.zeros_like(np.asarray(p)), np.zeros_like(np.asarray(p))] for p in (net.w1, net.b1, net.w2, net.b2)]
    for step in range(1, rounds + 1):
        h = np.tanh(a @ net.w1 + net.b1)
        d = (1 / (1 + np.exp(-np.clip(h @ net.w2 + net.b2, -40, 40))) - t) / len(t)
        back = np.outer(d, net.w2) * (1 - h * h)
        slopes = (a.T @ back + 1e-4 * net.w1, back.sum(axis=0), h.T @ d + 1e-4 * net.w2, d.sum())
        for name, slope, m in zip(("w1", "b1", "w2", "b2"), slopes, moments):
            m[0] = 0.9 * m[0] + 0.1 * slope
            m[1] = 0.999 * m[1] + 0.001 * slope * slope
            move = 0.02 * (m[0] / (1 - 0.9**step)) / (np.sqrt(m[1] / (1 - 0.999**step)) + 1e-8)
            setattr(net, name, getattr(net, name) - move)
    if rest.sum() >= 20 and 0 < y[rest].mean() < 1:
        z = net.logit(x[rest])
        grid = np.exp(np.linspace(np.log(0.25), np.log(8), 60))
        losses = [np.mean(np.logaddexp(0, -np.where(y[rest] > 0, z, -z) / g)) for g in grid]
        net.temperature = float(grid[int(np.argmin(losses))])
    return net


def train(docs: DataFrame, labelled: DataFrame, training_rows: int = TRAINING_ROWS) -> tuple[np.ndarray, Network | float]:
    """Word vectors from ``docs`` (text); network from ``labelled`` (text,
    label).  Rows with a null label are left out; with one class only the
    model is that class's share, without rows 0.5."""
    vectors = word_vectors(docs)
    labelled = labelled.filter(F.col("label").isNotNull()).select("text", "label")
    rows = labelled.agg(F.count(F.lit(1))).first()[0]
    shared = docs.sparkSession.sparkContext.broadcast(vectors)

    def features(batches):
        for batch in batches:
            for part in c.slices(c.as_bytes(batch.column("text"))):
                yield {"x": list(pooled(shared.value, part)), "label": batch.column("label").slice(part.lo, part.n)}

    sample = labelled.filter(c.picked(training_rows / max(1, rows), "text", seed="quality"))
    got = c.over_batches(sample.withColumn("label", F.col("label").cast("int")), features, "x array<double>, label int").toPandas()
    y = got["label"].to_numpy(int) if len(got) else np.zeros(0, int)
    if len(set(y)) < 2:
        return vectors, float(y.mean()) if len(y) else 0.5
    return vectors, fit(np.stack(got["x"].to_numpy()), y)


def score(docs: DataFrame, model: tuple[np.ndarray, Network | float], doc_id: str = "doc_id", text: str = "text", threshold: float = 0.3) -> DataFrame:
    """doc_id, score (0 to 1) and predicted of every row of ``docs``.

    Null and empty texts are scored as texts without words; repeated rows give
    repeated results; a null id is passed on; other columns are not looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = c.narrow(docs, doc_id=doc_id, text=text)

    def run(batches):
        vectors, net = shared.value
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for part in c.slices(c.as_bytes(batch.column("text"))):
                out[part.lo : part.hi] = net if isinstance(net, float) else net.score(pooled(vectors, part))
            yield {"doc_id": batch.column("doc_id"), "score": out, "predicted": (out >= threshold).astype(np.int32)}

    return c.over_batches(rows, run, f"doc_id {dict(rows.dtypes)['doc_id']}, score double, predicted int")
