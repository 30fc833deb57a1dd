"""Helpers that the operators of this subpackage share.

Inside tasks texts are handled as UTF-8 bytes, many texts at a time: one byte
array holds the texts of a slice, each with one separator before it, and all
work on it is vectorised.  Slices are cut by bytes, so memory stays bounded
however many rows an Arrow batch holds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from quillgate.session import materialise

__all__ = ["materialise"]

SLICE_BYTES = 1 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LETTER = np.zeros(256, bool)  # ASCII letters and every byte of a longer code point
LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True

_BASE = 0x9E3779B97F4A7C15 | 1
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def fold(doc_id: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; 'no fold' (-1) for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % n, F.lit(-1))


def picked(share: float, *columns: str, seed: str) -> Column:
    """True for about this share of the rows, always the same ones."""
    place = F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(1 << 30))
    return place < F.lit(int(min(1.0, share) * (1 << 30)))


def narrow(docs: DataFrame, **columns: Column | str) -> DataFrame:
    """Only the named columns, so that extra ones never clash with ours."""
    return docs.select(*[(F.col(c) if isinstance(c, str) else c).alias(n) for n, c in columns.items()])


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit hashes evenly."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2**64."""
    global _powers
    if len(_powers[0]) < n:
        size = max(n, SLICE_BYTES + 1024)

        def row(base: int) -> np.ndarray:
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            return np.cumprod(steps)

        _powers = row(_BASE), row(pow(_BASE, -1, 1 << 64))
    return _powers[0][:n], _powers[1][:n]


class Slice:
    """Texts ``lo`` to ``hi`` of a batch as one byte array.

    Each text has a line feed before it; ``start`` and ``stop`` bound text i
    with that line feed.
    """

    def __init__(self, texts: list[bytes], lo: int, hi: int):
        self.lo, self.hi = lo, hi
        mine = texts[lo:hi]
        self.n = hi - lo
        self.data = np.frombuffer(b"\n" + b"\n".join(mine), np.uint8)
        lengths = np.fromiter((len(t) + 1 for t in mine), np.int64, self.n)
        self.stop = np.cumsum(lengths)
        self.start = self.stop - lengths

    def lower(self, latin: bool = False) -> np.ndarray:
        """The bytes with A-Z (and the capitals of Latin-1) in lower case."""
        b = self.data
        out = b + ((b >= 65) & (b <= 90)).astype(np.uint8) * np.uint8(32)
        if latin:
            after = np.flatnonzero(b[:-1] == 0xC3) + 1
            up = after[(b[after] >= 0x80) & (b[after] <= 0x9E) & (b[after] != 0x97)]
            out[up] += 32
        return out

    def words(self, kind: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts, ends and text numbers of the words: runs without white
        space, or of one class where ``kind`` gives bytes classes (0: space)."""
        k = (~SPACE[self.data]).astype(np.uint8) if kind is None else kind
        edge = np.flatnonzero(np.diff(k)) + 1
        edge = np.concatenate([[0], edge, [len(k)]])
        inside = k[edge[:-1]] > 0
        starts, ends = edge[:-1][inside], edge[1:][inside]
        return starts, ends, np.searchsorted(self.stop, starts, "right")

    def hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """One 64-bit hash for each span."""
        up, down = powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
        return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def slices(texts: list[bytes], limit: int = SLICE_BYTES) -> Iterator[Slice]:
    lo = size = 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= limit:
            yield Slice(texts, lo, i + 1)
            lo, size = i + 1, 0
    if lo < len(texts):
        yield Slice(texts, lo, len(texts))


def as_bytes(column: pa.Array) -> list[bytes]:
    """Text as bytes; null as the empty text."""
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def over_batches(df: DataFrame, task: Callable, schema: str) -> DataFrame:
    """``task``: iterator of record batches to iterator of dicts of columns."""
    struct = T._parse_datatype_string(schema)
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(struct)

    def run(batches):
        for columns in task(batches):
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in ((columns[f.name], f) for f in arrow)],
                schema=arrow,
            )

    return df.mapInArrow(run, struct)


def text_sums(count: Callable[[Slice, dict, pa.RecordBatch], None], batches) -> dict:
    """Run ``count`` over all slices of a task with one dict of sums."""
    sums: dict = {}
    for batch in batches:
        texts = as_bytes(batch.column("text"))
        for part in slices(texts):
            count(part, sums, batch)
    return sums


def per_text(values: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """Sums of the rows of ``values`` by text; ``first``: sorted text numbers."""
    out = np.zeros((n, *values.shape[1:]), np.float64)
    if len(first):
        at = np.flatnonzero(np.diff(first, prepend=-1))
        out[first[at]] = np.add.reduceat(values, at, axis=0, dtype=np.float64)
    return out
