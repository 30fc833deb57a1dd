"""Language identification by error-correcting output codes.

Every language has a codeword of bits.  For each bit one binary classifier
over hashed byte n-grams tells the languages with a 1 from those with a 0; a
text goes to the language whose codeword has the least weighted loss.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from quillgate.llm import common as c

GRAMS = (2, 3, 4)
BUCKETS = 1 << 15
#: rows that the calibration of the bits reads, about
CALIBRATION_ROWS = 3000
#: a text is ambiguous if its second language is at least this likely
AMBIGUOUS = 0.35
UNKNOWN = "und"
HAS_LETTER = r"\p{L}"


@dataclass
class Model:
    """languages, codewords (+1/-1), weights by bucket and bit, scale, offset
    and reliability of each bit."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    scale: np.ndarray
    offset: np.ndarray
    trust: np.ndarray


def codewords(n: int) -> np.ndarray:
    """All ways to part up to five languages in two; for more, random halves
    with distinct rows, 12 bits for each doubling."""
    if n < 2:
        return np.ones((n, 0))
    if n <= 5:
        sets = range(1, 1 << (n - 1))
        return np.array([[1.0 if s >> i & 1 else -1.0 for s in sets] for i in range(n)])
    draw = np.random.default_rng(n)
    bits = 12 * int(np.ceil(np.log2(n)))
    half = np.where(np.arange(n) % 2, 1.0, -1.0)
    code = np.stack([draw.permutation(half) for _ in range(bits)], axis=1)
    while len(np.unique(code, axis=0)) < n:
        code = np.concatenate([code, draw.permutation(half)[:, None]], axis=1)
    return code


def grams(part: c.Slice) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each n-gram (BUCKETS where the n-gram would leave its text)
    as (orders, positions), and each text's first position."""
    low = part.lower(latin=True)
    low[~c.LETTER[low]] = 0x20
    keep = np.ones(len(low), bool)
    keep[1:] = (low[1:] != 0x20) | (low[:-1] != 0x20)
    keep[part.start] = True
    b = low[keep].astype(np.uint32)
    first = np.concatenate([[0], np.cumsum(keep)])[part.start]
    left = np.repeat(np.append(first[1:], len(b)), np.diff(np.append(first, len(b)))) - np.arange(len(b))
    padded = np.concatenate([b, np.zeros(max(GRAMS), np.uint32)])
    out = np.empty((len(GRAMS), len(b)), np.int32)
    for row, n in enumerate(GRAMS):
        g = np.full(len(b), n, np.uint32)
        for j in range(n):
            g = g * np.uint32(0x01000193) ^ padded[j : j + len(b)] * np.uint32(0x85EBCA6B)
        g ^= g >> np.uint32(15)
        out[row] = (g * np.uint32(0x9E3779B1)) >> np.uint32(17)
        out[row][left < n] = BUCKETS
    return out, first


def _count(batches):
    """Counts of (language, bucket) in one task."""
    counts: dict[str, np.ndarray] = {}
    for batch in batches:
        texts, langs = c.as_bytes(batch.column("text")), batch.column("lang").to_pylist()
        for part in c.slices(texts):
            g, first = grams(part)
            sizes = np.diff(np.append(first, g.shape[1]))
            mine = langs[part.lo : part.hi]
            for lang in set(mine):
                at = np.repeat([x == lang for x in mine], sizes)
                found = np.bincount(g[:, at].ravel(), minlength=BUCKETS + 1)[:BUCKETS]
                counts[lang] = counts.get(lang, 0) + found
    for lang, found in counts.items():
        at = np.flatnonzero(found)
        yield {"lang": [lang] * len(at), "bucket": at, "n": found[at]}


def _margins(weights: np.ndarray, part: c.Slice) -> np.ndarray:
    """Sum of weights over the square root of the n-grams, by text and bit."""
    g, first = grams(part)
    total = np.zeros((part.n, weights.shape[1]))
    for row in g:
        total += np.add.reduceat(weights[row], first, axis=0)
    size = np.diff(np.append(first, g.shape[1]))
    return total / np.sqrt(len(GRAMS) * size)[:, None]


def train(docs: DataFrame, calibration_rows: int = CALIBRATION_ROWS) -> Model:
    """Learn from ``docs`` (text, lang; rows with a null are left out).

    N-grams are counted by language over all rows, so what reaches the driver
    is one number for each language and bucket.  Scale, offset and trust of
    the bits are fitted on about ``calibration_rows`` rows.
    """
    docs = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
    counts = (
        c.over_batches(docs, _count, "lang string, bucket int, n long")
        .groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    )
    languages = sorted(counts["lang"].unique())
    code = codewords(len(languages))
    bits = code.shape[1]
    weights = np.zeros((BUCKETS + 1, bits), np.float32)
    if not bits:
        empty = np.zeros(0)
        return Model(languages, code, weights, empty, empty, empty)
    table = np.zeros((len(languages), BUCKETS))
    np.add.at(table, (counts["lang"].map(languages.index).to_numpy(), counts["bucket"].to_numpy()), counts["n"].to_numpy())
    rate = (table + 0.5) / (table + 0.5).sum(axis=1, keepdims=True)  # every language counts alike
    for b in range(bits):
        weights[:BUCKETS, b] = np.log(rate[code[:, b] > 0].mean(axis=0) / rate[code[:, b] < 0].mean(axis=0))

    rows = docs.agg(F.count(F.lit(1))).first()[0]
    sample = docs.filter(c.picked(calibration_rows / max(1, rows), "text", seed="calibrate"))
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def margins(batches):
        for batch in batches:
            for part in c.slices(c.as_bytes(batch.column("text"))):
                m = _margins(shared.value, part)
                yield {"lang": batch.column("lang").to_pylist()[part.lo : part.hi], "m": list(m)}

    got = c.over_batches(sample, margins, "lang string, m array<double>").toPandas()
    scale, offset, trust = np.full(bits, 0.1), np.zeros(bits), np.ones(bits)
    if len(got) >= 20:
        x, y = np.stack(got["m"].to_numpy()), code[got["lang"].map(languages.index).to_numpy()]
        for b in range(bits):
            scale[b], offset[b] = _fit_line(x[:, b], y[:, b] > 0)
            trust[b] = max(0.05, 1 - 2 * np.mean(np.sign(scale[b] * x[:, b] + offset[b]) != y[:, b]))
    return Model(languages, code, weights, scale, offset, trust / trust.sum() * bits)


def _fit_line(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression on one feature, with a small pull to zero."""
    spread = x.std() or 1.0
    a = np.stack([x / spread, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        slope = a.T @ (p - y) + 0.1 * w
        w -= np.linalg.solve(a.T @ (a * (p * (1 - p))[:, None]) + 0.1 * np.eye(2), slope)
    return max(w[0] / spread, 1e-3), w[1]


def decode(model: Model, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best language, its share and the share of the next, by text."""
    if len(model.languages) == 1:
        n = len(margins)
        return np.zeros(n, int), np.ones(n), np.zeros(n)
    z = np.clip(margins * model.scale + model.offset, -30, 30)
    loss = (np.logaddexp(0, -z[:, None, :] * model.code[None]) * model.trust).sum(axis=2)
    share = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
    share /= share.sum(axis=1, keepdims=True)
    order = np.argsort(-share, axis=1, kind="stable")
    at = np.arange(len(share))
    return order[:, 0], share[at, order[:, 0]], share[at, order[:, 1]]


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", keep: list[Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, lang_pred, score, ambiguous and
    the columns of ``keep``.

    A null text, one without a letter, and every text when nothing was
    learned get ``und`` and score 0.  Texts are read whole; a repeated row
    gives a repeated result; a null id is passed on.
    """
    keep = keep or []
    known = F.coalesce(F.col(text).rlike(HAS_LETTER), F.lit(False))
    rows = docs.select(F.col(doc_id).alias("_id"), known.alias("_known"), F.when(known, F.col(text)).alias("text"),
                       F.struct(F.lit(0).alias("_0"), *keep).alias("_keep"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = np.array([*model.languages, UNKNOWN], dtype=object)

    def run(batches):
        m = shared.value
        for batch in batches:
            texts = c.as_bytes(batch.column("text"))
            known = np.array(batch.column("_known").to_pylist(), bool)
            best, first, second = np.zeros(len(texts), int), np.zeros(len(texts)), np.zeros(len(texts))
            if m.languages:
                for part in c.slices(texts):
                    got = decode(m, _margins(m.weights, part))
                    for out, x in zip((best, first, second), got):
                        out[part.lo : part.hi] = x
            else:
                known[:] = False
            best[~known], first[~known], second[~known] = len(m.languages), 0, 0
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_keep"), pa.array(names[best], pa.string()), pa.array(first),
                 pa.array(second >= AMBIGUOUS)],
                names=["_id", "_keep", "lang_pred", "score", "ambiguous"],
            )

    kinds = dict(rows.dtypes)
    schema = f"_id {kinds['_id']}, _keep {kinds['_keep']}, lang_pred string, score double, ambiguous boolean"
    return rows.mapInArrow(run, schema).select(F.col("_id").alias("doc_id"), "lang_pred", "score", "ambiguous",
                                               *[F.col(f"_keep.{n}") for n in _names(rows)])


def _names(rows: DataFrame) -> list[str]:
    return [f"`{f.name}`" for f in rows.schema["_keep"].dataType.fields if f.name != "_0"]
