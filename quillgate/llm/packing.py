"""Documents packed into sequences of one length: cutting stock by column generation.

Every document becomes token ids and is cut into pieces of the full length and
one shorter rest.  How many rests there are of each length is a histogram of
bounded size.  A linear program over patterns (multisets of lengths that fill a
sequence, in units of a few tokens) looks for the most full sequences; its columns are priced by
a knapsack dynamic program on the duals.  The rounded patterns give places by
length and rank, and a piece finds its own from its rank among the pieces of
its length.  What no pattern takes stands in one line that is cut at full
sequences, its tail at powers of two, so that the only padding is what the
units round up.

Only the histogram and the patterns pass through the driver, both bounded by
the sequence length whatever the table.  Ranks come from counts by task, so no
task ever meets all pieces of a length.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window as W, functions as F, types as T

from quillgate.llm import common as c

SEQUENCE_TOKENS = 2048
#: id after the last token of a document
END_ID = 1
VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
#: patterns are made of lengths in units of so many tokens, rounded up; what is
#: rounded is padding (one or two tokens a piece)
GRAIN = 4
#: the linear program ends within this share of the best possible, or after
#: so many steps (work on the driver is bounded; what is left stands in line)
GAP, MOST_STEPS = 0.01, 12_000
#: columns taken from one run of the knapsack
COLUMNS_A_RUN = 96
_TINY = 1e-9
#: bytes of words and ids that a task remembers
MEMORY_BYTES = 5 << 25
#: bytes of text that are looked up at once
SLICE_BYTES = 1 << 22
#: rows of cut pieces that are broadcast to the token ids; more are joined by shuffle
MOST_SENT = 100_000
#: bytes of pieces that are handed on at once
RESULT_BYTES = 1 << 23


# -- token ids ---------------------------------------------------------------

_BLANK = re.compile(rb"[ \t\n\r\x0b\x0c]")
#: chunks in which case and word ends are the same by any table of characters
_LATIN = re.compile("[!-~À-ÖØ-öø-įı-ſ]+")
#: the vocabulary's own word pattern (fixed value), for such chunks in lower case
_WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ſ]+|[0-9]|[^a-zß-öø-ſ0-9]+")


class _Lists:
    """Lists of ids by key, in one growing array."""

    def __init__(self):
        self.number: dict = {}
        self.ids = np.zeros(1 << 12, np.uint32)
        self.start, self.length, self.asked = (np.zeros(1 << 10, np.int64) for _ in range(3))
        self.used = self.bytes = 0

    def add(self, keys: list, flat: np.ndarray, ends: np.ndarray) -> None:
        """Lists that stand one after the other in ``flat``."""
        first, length = len(self.number), np.diff(ends, prepend=0)
        last, end = first + len(keys), self.used + len(flat)
        while last > len(self.start):
            self.start, self.length, self.asked = (np.concatenate([a, np.zeros_like(a)]) for a in (self.start, self.length, self.asked))
        while end > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : end] = flat
        self.length[first:last] = length
        self.start[first:last] = self.used + ends - length
        self.number.update(zip(keys, range(first, last)))
        self.used = end
        self.bytes += 150 * len(keys) + sum(map(len, keys)) + 4 * len(flat)

    def find(self, keys: Iterable, n: int) -> np.ndarray:
        at = np.fromiter(map(self.number.__getitem__, keys), np.int64, n)
        np.add.at(self.asked, at, 1)
        return at

    def join(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists of these numbers one after the other, and where each ends."""
        length = self.length[at]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.start[at] - (ends - length), length) + np.arange(total)], ends

    def common(self) -> _Lists:
        """The quarter that was asked for most often."""
        n = len(self.number)
        chosen = np.zeros(n, bool)
        chosen[np.argsort(-self.asked[:n], kind="stable")[: n // 4]] = True
        out = _Lists()
        out.add([k for k, x in zip(self.number, chosen) if x], *self.join(np.flatnonzero(chosen)))
        return out


class Ids:
    """Ids of whole texts, one ASCII-white-space chunk at a time.

    The vocabulary drops white space before it looks for words, so a text's
    ids are those of its chunks in order.  A chunk of plain Latin letters is in
    turn the ids of its words; any other is given to the tokenizer as it is.
    Chunks and words are remembered up to a bound of bytes; beyond it only the
    more common ones stay.
    """

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        known = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(known.values()) + 1, bool)
        self.ends[[i for token, i in known.items() if token.endswith("</w>")]] = True
        self.chunks, self.words = _Lists(), _Lists()

    def _encode(self, words: list[str], together: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words, and where each word's end; ``together``: in one
        text with spaces between, parted again behind the ids that end a word."""
        if together:
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.uint32)
            ends = np.flatnonzero(self.ends[ids]) + 1
            if len(ends) == len(words) and ends[-1] == len(ids):
                return ids, ends
        got = [x.ids for x in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(got), np.uint32), np.cumsum([len(x) for x in got])

    def _learn(self, chunks: list[bytes]) -> None:
        texts = [x.decode("utf-8", "replace") for x in chunks]
        plain = [bool(_LATIN.fullmatch(x)) and "<|" not in x for x in texts]
        parts = [_WORD.findall(x.lower()) if p else [x] for x, p in zip(texts, plain)]
        other = {x for x, p in zip(texts, plain) if not p}
        new = set(chain.from_iterable(parts)) - self.words.number.keys()
        for together, mine in ((True, list(new - other)), (False, list(new & other))):
            for lo in range(0, len(mine), 4096):
                self.words.add(mine[lo : lo + 4096], *self._encode(mine[lo : lo + 4096], together))
        counts = np.cumsum([len(x) for x in parts])
        flat, ends = self.words.join(self.words.find(chain.from_iterable(parts), counts[-1]))
        self.chunks.add(chunks, flat, np.concatenate([[0], ends])[counts])

    def _some(self, texts: pa.Array) -> list[np.ndarray]:
        if self.chunks.bytes + self.words.bytes > MEMORY_BYTES:
            self.chunks, self.words = self.chunks.common(), self.words.common()
        lists = pc.ascii_split_whitespace(texts)
        found = lists.flatten().dictionary_encode()
        distinct = found.dictionary.view(pa.binary()).to_pylist()
        if new := [x for x in distinct if x not in self.chunks.number]:
            self._learn(new)
        at = self.chunks.find(distinct, len(distinct))
        flat, ends = self.chunks.join(at[found.indices.to_numpy()])
        stops = np.concatenate([[0], ends])[lists.offsets.to_numpy()]
        return [flat[a:b] for a, b in zip(stops, stops[1:])]

    def of(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """Ids of each text, many texts at a time."""
        lo = size = 0
        for i, text in enumerate(texts):
            size += len(text)
            if size >= SLICE_BYTES or i + 1 == len(texts):
                if len(text) <= SLICE_BYTES:
                    yield from self._some(_strings(texts[lo : i + 1]))
                else:
                    yield from self._some(_strings(texts[lo:i]))
                    yield np.concatenate([self._some(_strings([part]))[0] for part in _parts(text)])
                lo, size = i + 1, 0


def _strings(texts: list[bytes]) -> pa.Array:
    return pa.array(texts, pa.binary()).view(pa.string())


def _parts(text: bytes) -> Iterator[bytes]:
    """A long text in parts that end at white space."""
    lo = 0
    while lo < len(text):
        found = _BLANK.search(text, lo + SLICE_BYTES)
        hi = found.start() if found else len(text)
        yield text[lo:hi]
        lo = hi


_known: dict[str, Ids] = {}


def ids_of(vocabulary: str) -> Ids:
    """The same object for all tasks of a Python worker."""
    if vocabulary not in _known:
        _known[vocabulary] = Ids(vocabulary)
    return _known[vocabulary]


def tokenise(docs: DataFrame, text: str = "text", keep: list[Column] | None = None, vocabulary: str = VOCABULARY,
             end_id: int = END_ID, size: int = SEQUENCE_TOKENS) -> DataFrame:
    """One row per piece: ``part`` and ``pos`` (its task and its place there),
    ``kept`` (struct of the columns of ``keep``), ``start``, ``length``, ``doc_tokens``, ``rank`` among
    the pieces of its length in its task, ``ids_crc32`` and ``ids`` (little-endian unsigned 32-bit).

    Written once, so that part, pos and rank hold from then on.
    """
    rows = docs.select(F.struct(F.lit(0).alias("_0"), *(keep or [])).alias("kept"), F.col(text).alias("text"))
    kinds = T._parse_datatype_string("part int, pos long, start long, length int, doc_tokens long, rank long, ids_crc32 long, ids binary")

    def run(batches):
        part, pos = TaskContext.get().partitionId(), 0
        met = np.zeros(size + 1, np.int64)
        encoder = ids_of(vocabulary)
        for batch in batches:
            kept = batch.column("kept")
            found, held = [], 0

            def rows_out():
                cols = list(zip(*found))
                arrays = [kept.take(pa.array(cols[0], pa.int64()))]
                arrays += [pa.array(x, pa.int32() if f.name in ("part", "length") else pa.binary() if f.name == "ids" else pa.int64())
                           for x, f in zip(cols[1:], kinds)]
                return pa.RecordBatch.from_arrays(arrays, names=["kept", *kinds.names])

            for row, ids in enumerate(encoder.of(c.as_bytes(batch.column("text")))):
                ids = np.append(ids, end_id).astype("<u4")
                for start in range(0, len(ids), size):
                    raw = ids[start : start + size].tobytes()
                    length = len(raw) // 4
                    found.append((row, part, pos, start, length, len(ids), int(met[length]), zlib.crc32(raw), raw))
                    met[length] += 1
                    pos += 1
                    held += len(raw)
                if held >= RESULT_BYTES:
                    yield rows_out()
                    found, held = [], 0
            if found:
                yield rows_out()

    got = rows.mapInArrow(run, T.StructType([rows.schema["kept"], *kinds]))
    return c.materialise(got, "packing-pieces")


# -- patterns ----------------------------------------------------------------


def cheapest_fills(lengths: np.ndarray, cost: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Knapsack: of every total up to ``size`` the least cost of filling it
    exactly, and the length (its number) that such a filling ends with."""
    best, last = np.full(size + 1, np.inf), np.full(size + 1, -1)
    best[0] = 0
    upto = np.searchsorted(lengths, np.arange(size + 1), "right")
    for total in range(1, size + 1):
        if n := upto[total]:
            price = cost[:n] + best[total - lengths[:n]]
            at = int(price.argmin())
            best[total], last[total] = price[at], at
    return best, last


def fillings(lengths: np.ndarray, cost: np.ndarray, size: int, most: int) -> tuple[float, list[dict[int, int]]]:
    """The least cost of a full sequence, and cheapest patterns that hold each
    a given length: {number of the length: copies}, cheapest first; of those
    about equally cheap the one with the longest piece, as short pieces find
    room later too."""
    best, last = cheapest_fills(lengths, cost, size)
    through = cost + best[size - lengths]
    out, seen = [], set()
    for first in np.lexsort((-lengths, np.round(through, 3))):
        if not np.isfinite(through[first]) or len(out) == most:
            break
        pattern, left = {int(first): 1}, size - int(lengths[first])
        while left:
            at = int(last[left])
            pattern[at] = pattern.get(at, 0) + 1
            left -= int(lengths[at])
        key = tuple(sorted(pattern.items()))
        if key not in seen:
            seen.add(key)
            out.append(pattern)
    return float(best[size]), out


def most_full_sequences(lengths: np.ndarray, demand: np.ndarray, size: int, gap: float = GAP,
                        most_steps: int = MOST_STEPS) -> tuple[list[dict[int, int]], np.ndarray, float]:
    """Column generation: maximise the number of full sequences, using no
    length more often than it is there.

    Revised simplex with an explicit inverse, from the basis of slacks.  Gives
    the patterns, how often each is used (fractions) and an upper bound.
    """
    n = len(lengths)
    # a little more of each length than there is, by different shares: pivots that move nothing are rare then
    loose = demand * (1 + 2e-3 * np.random.default_rng(11).random(n))
    inverse, amount = np.eye(n), loose.copy()
    value, dual = np.zeros(n), np.zeros(n)  # of the basic columns; of the lengths
    basic: list[dict[int, int] | None] = [None] * n  # None: a slack
    bound, steps = float(demand @ lengths) / size, 0
    # among equal prices few long pieces, of lengths that are there more often
    favour = 1e-6 * (np.sqrt(lengths / size) + 1 / (1 + demand))

    def enter(column: np.ndarray, gain: float, pattern: dict[int, int] | None) -> bool:
        up = column > _TINY
        if not up.any():
            return False
        ratio = np.where(up, amount / np.where(up, column, 1), np.inf)
        row = int(np.where(ratio <= ratio.min() + _TINY, column, -1).argmax())
        step = max(0.0, ratio[row])
        pivot = inverse[row] / column[row]
        columns = np.flatnonzero(pivot)
        rows = np.flatnonzero(np.abs(column) > _TINY)
        rows = rows[rows != row]
        if len(columns) > n // 3:
            inverse[rows] -= np.outer(column[rows], pivot)
        else:
            inverse[np.ix_(rows, columns)] -= np.outer(column[rows], pivot[columns])
        inverse[row] = pivot
        amount[rows] = np.maximum(amount[rows] - step * column[rows], 0)
        amount[row] = step
        dual[columns] += gain * pivot[columns]
        value[row], basic[row] = (1.0 if pattern else 0.0), pattern
        return True

    while steps < most_steps:
        while dual.min() < -1e-7 and steps < most_steps:  # a slack comes back
            at = int(dual.argmin())
            steps += 1
            if not enter(inverse[:, at].copy(), -dual[at], None):
                break
        price = np.maximum(dual, 0)
        least, patterns = fillings(lengths, price + favour, size, COLUMNS_A_RUN)
        if not patterns:
            break
        if least > 1e-3:
            bound = min(bound, float(demand @ price) / min(1.0, least - 1e-3))
        if value @ amount >= (1 - gap) * bound:
            break
        moved = False
        for pattern in patterns:
            at = np.fromiter(pattern, np.int64, len(pattern))
            copies = np.fromiter(pattern.values(), np.int64, len(pattern))
            gain = 1 - float(copies @ dual[at])
            if gain > 1e-6 and 2 * gain > 1 - least:
                steps += 1
                moved |= enter(inverse[:, at] @ copies, gain, pattern)
        if not moved:
            break
    used = [i for i in range(n) if basic[i] and amount[i] > _TINY]
    return [basic[i] for i in used], amount[used], bound


@dataclass
class Plan:
    """Places by length and rank.

    ``key`` (unit length times ``STEP`` plus first rank, sorted), ``sequence``,
    ``slot`` and ``copies`` of each run of ranks that one pattern takes.  Of
    each length: ``units``, ``before`` (shorter pieces of equal units),
    ``taken`` (ranks that patterns take) and ``line`` (where the others begin
    in the line).  ``first``: the line's first sequence; ``cuts``: where the
    sequences of the line's tail begin, and its end.
    """

    size: int
    key: np.ndarray
    sequence: np.ndarray
    slot: np.ndarray
    copies: np.ndarray
    units: np.ndarray
    before: np.ndarray
    taken: np.ndarray
    line: np.ndarray
    first: int
    cuts: np.ndarray
    patterns: list = field(default_factory=list)

    STEP = 1 << 48


def plan(counts: dict[int, int], size: int = SEQUENCE_TOKENS, grain: int = GRAIN) -> Plan:
    """Patterns for ``counts`` pieces of each length, as whole numbers."""
    if size % grain:
        raise ValueError(f"{size} tokens are not a whole number of units of {grain}")
    count = np.zeros(size + 1, np.int64)
    count[list(counts)] = list(counts.values())
    length = np.arange(size + 1)
    units = -(-length // grain)
    by_units = np.bincount(units, count).astype(np.int64)
    full = size // grain
    chosen = [({full: 1}, int(by_units[full]))] if by_units[full] else []
    at_hand = np.flatnonzero(by_units[:full])
    left = by_units[at_hand]
    if len(at_hand):
        patterns, times, _ = most_full_sequences(at_hand, left.copy(), full)
        # whole parts first, then one more of those with the largest rests, as far as the pieces go
        whole = np.floor(times + 1e-6).astype(np.int64)
        for most, order in ((whole, range(len(patterns))), (np.ones_like(whole), np.argsort(whole - times, kind="stable"))):
            for i in order:
                at = np.fromiter(patterns[i], np.int64, len(patterns[i]))
                copies = np.fromiter(patterns[i].values(), np.int64, len(patterns[i]))
                if n := int(min(most[i], (left[at] // copies).min())):
                    left[at] -= n * copies
                    chosen.append(({int(at_hand[a]): int(k) for a, k in zip(at, copies)}, n))
    planned, runs, first = np.zeros(full + 1, np.int64), [], 0
    for pattern, n in chosen:
        slot = 0
        for unit, copies in sorted(pattern.items(), reverse=True):
            runs.append((unit * Plan.STEP + planned[unit], first, slot, copies))
            planned[unit] += n * copies
            slot += copies
        first += n
    runs.sort()
    columns = [np.array(x, np.int64) for x in zip(*runs)] if runs else [np.zeros(0, np.int64)] * 4
    before = np.cumsum(count) - count
    before -= before[np.searchsorted(units, units)]
    taken = np.clip(planned[units] - before, 0, count)
    tokens = (count - taken) * length
    total = int(tokens.sum())
    tail, cuts = total % size, []
    while tail:
        cuts.append(total - tail)
        tail -= 1 << (tail.bit_length() - 1)
    return Plan(size, *columns, units, before, taken, np.cumsum(tokens) - tokens, first, np.array([*cuts, total], np.int64), chosen)


def places(p: Plan, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, ...]:
    """(row, tokens of the piece before, length, sequence, slot) of the pieces
    as placed; a piece that is cut gives several rows.  Slots order the pieces
    of a sequence."""
    by_pattern = rank < p.taken[length]
    at = np.flatnonzero(by_pattern)
    key = p.units[length[at]] * Plan.STEP + p.before[length[at]] + rank[at]
    run = np.searchsorted(p.key, key, "right") - 1
    nth = key - p.key[run] if len(at) else at
    out = [(at, np.zeros(len(at), np.int64), length[at], p.sequence[run] + nth // p.copies[run], p.slot[run] + nth % p.copies[run])] if len(at) else []
    row = np.flatnonzero(~by_pattern)
    first = p.line[length[row]] + (rank[row] - p.taken[length[row]]) * length[row]
    begin, end = first, first + length[row]
    full = int(p.cuts[0] // p.size)  # full sequences of the line
    while len(row):
        inside = np.searchsorted(p.cuts, begin, "right") - 1  # -1: before the tail
        tail = inside >= 0
        opens = np.where(tail, p.cuts[np.maximum(inside, 0)], begin // p.size * p.size)
        stop = np.where(tail, p.cuts[np.minimum(inside + 1, len(p.cuts) - 1)], opens + p.size)
        stop = np.minimum(stop, end)
        out.append((row, begin - first, stop - begin, p.first + np.where(tail, full + inside, begin // p.size), begin - opens))
        more = stop < end
        row, begin, end, first = row[more], stop[more], end[more], first[more]
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*out))


# -- packing -----------------------------------------------------------------


@dataclass
class Packed:
    """``pieces``: the columns of ``keep``, ``start``, ``length``,
    ``ids_crc32``, ``doc_tokens``, ``sequence_id``, ``offset``, ``part``,
    ``pos`` and ``before``, which find its ids among the ``tokens``."""

    pieces: DataFrame
    tokens: DataFrame
    size: int

    def with_ids(self) -> DataFrame:
        """The pieces with their ``ids`` (little-endian unsigned 32-bit)."""
        ids = F.substring(F.col("_ids"), (4 * F.col("before") + 1).cast("int"), (4 * F.col("length")).cast("int"))
        return self.pieces.join(self.tokens.select("part", "pos", F.col("ids").alias("_ids")), ["part", "pos"]).select(
            *[F.col(f"`{x}`") for x in self.pieces.columns], ids.alias("ids"))

    def sequences(self) -> DataFrame:
        """One row per sequence: ``sequence_id``, ``ids`` (binary as above) and
        ``lengths`` of its pieces in order.  A sequence holds at most as many
        pieces as tokens, so the groups are bounded."""
        piece = F.struct("offset", "length", "ids")
        got = self.with_ids().groupBy("sequence_id").agg(F.array_sort(F.collect_list(piece)).alias("all"))
        joined = F.aggregate("all", F.lit(b"").cast("binary"), lambda whole, x: F.concat(whole, x["ids"]))
        return got.select("sequence_id", joined.alias("ids"), F.transform("all", lambda x: x["length"]).alias("lengths"))


def pack(docs: DataFrame, text: str = "text", keep: list[Column] | None = None, vocabulary: str = VOCABULARY,
         end_id: int = END_ID, size: int = SEQUENCE_TOKENS, grain: int = GRAIN) -> Packed:
    """Every token of every row of ``docs`` in exactly one place of a sequence.

    Sequences of patterns hold ``size`` tokens less what the units round up;
    those of the line are full, but for at most one of each smaller power of
    two.  A null or empty text is its end id alone.  Repeated rows and repeated
    or null ids are documents of their own; an empty table gives no pieces.
    Texts are tokenised whole.  Columns of ``keep`` that are named like the
    operator's own need an alias.
    """
    tokens = tokenise(docs, text, keep, vocabulary, end_id, size)
    counts = c.materialise(tokens.groupBy("part", "length").count(), "packing-counts")
    p = plan({r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("count").alias("n")).collect()}, size, grain)  # at most `size` rows
    earlier = W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    firsts = counts.select("part", "length", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("first"))
    narrow = tokens.drop("ids").join(firsts, ["part", "length"]).withColumn("rank", F.col("rank") + F.col("first"))
    narrow = narrow.select("kept", "part", "pos", "start", "length", "doc_tokens", "ids_crc32", "rank")
    shared = docs.sparkSession.sparkContext.broadcast(p)  # at most 63 lengths of each of 2,047 patterns
    kinds = T._parse_datatype_string("before long, sequence_id long, slot long")

    def place(batches):
        for batch in batches:
            length = batch.column("length").to_numpy().astype(np.int64)
            row, before, cut, sequence, slot = places(shared.value, length, batch.column("rank").to_numpy())
            got = batch.take(pa.array(row))
            arrays = [got.column(n) for n in ("kept", "part", "pos")]
            arrays += [pa.array(got.column("start").to_numpy() + before), pa.array(cut.astype(np.int32)), got.column("doc_tokens")]
            arrays.append(pa.array(got.column("ids_crc32").to_numpy(), pa.int64(), mask=cut != length[row]))
            arrays += [pa.array(x, pa.int64()) for x in (before, sequence, slot)]
            yield pa.RecordBatch.from_arrays(arrays, names=["kept", "part", "pos", "start", "length", "doc_tokens", "ids_crc32", *kinds.names])

    placed = narrow.mapInArrow(place, T.StructType([f for f in narrow.schema if f.name != "rank"] + list(kinds)))
    inside = W.partitionBy("sequence_id").orderBy("slot").rowsBetween(W.unboundedPreceding, -1)
    placed = placed.withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)))
    placed = c.materialise(placed, "packing-places")
    whole, cut = placed.filter(F.col("ids_crc32").isNotNull()), placed.filter(F.col("ids_crc32").isNull())
    part = F.substring(F.col("ids"), (4 * F.col("before") + 1).cast("int"), (4 * F.col("length")).cast("int"))
    cut = cut.drop("ids_crc32")
    if 2 * (int(p.cuts[-1]) // size + len(p.cuts)) <= MOST_SENT:  # the rows of cut pieces: two at every cut
        cut = F.broadcast(cut)
    cut = cut.join(tokens.select("part", "pos", "ids"), ["part", "pos"]).withColumn("ids_crc32", F.crc32(part))
    names = [F.col(f"kept.`{f.name}`") for f in placed.schema["kept"].dataType.fields if f.name != "_0"]
    columns = [*names, "start", F.col("length").cast("long").alias("length"), "ids_crc32", "doc_tokens", "sequence_id", "offset", "part", "pos", "before"]
    return Packed(whole.select(*columns).unionByName(cut.select(*columns)), tokens, size)
