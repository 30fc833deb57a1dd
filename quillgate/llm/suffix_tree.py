"""Language-model scoring with a probabilistic suffix tree.

Symbols are the bytes of a normal form of the text: its words (ASCII in lower
case), each with a space after it, and an end sign, so the tree gives every
sequence of words a probability.  Contexts are up to DEPTH bytes long, which
with the next symbol fills 64 bits.  Contexts of fewer than BASE bytes are all
states.  A longer one is a state if it occurs MIN_COUNT times, however large the
corpus, and its next-symbol distribution diverges from that of its suffix by
more than an information criterion; suffixes of states are states.  So the tree
grows with the corpus.  Scoring uses the longest state that ends what precedes
each symbol.  A word's probability mixes its own count with the tree's, which
counts as much as there are kinds of words; both are distributions over all
words, and so is the mixture.

Words (for their exact counts) and grams, contexts with their next symbol, go
the same way: the texts are cut into blocks where they lie, each block, as one
compressed row, is shuffled once and sends its distinct words and grams by
range, and gets the words' counts and the grams' probabilities back, with each
range's share of the totals.  Grams are dealt by their latest BASE bytes of
context, so that a range holds all longer states that its grams need; of the
rest every task knows the counts, whose number the bytes bound.  Nothing of the
vocabulary's or the tree's size is ever in one place.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from quillgate.llm import common as c

DEPTH = 7
#: latest bytes of context by which grams are dealt
BASE = 3
#: least occurrences of a context of BASE bytes or more
MIN_COUNT = 2
#: bits of divergence a context must bring for each bit that storing it costs
DIVERGENCE = 0.25
#: weight of the parent's distribution in a state's
SMOOTHING = 2.0
END = 0x0A
#: bytes of text of a block: the larger, the fewer grams are sent by several
BLOCK_BYTES = 24 << 20
#: bytes of it whose grams are sorted at once
CHUNK_BYTES = 3 << 20
#: bytes of text that are worked on at a time
SLICE_BYTES = 1 << 18
#: rows of a batch that are
SLICE_ROWS = 1000
RANGES_PER_BLOCK = 2
_BYTE = np.uint64(8)
#: lowest bytes of a gram, by their number
_LOW = [np.uint64((1 << 8 * d) - 1) for d in range(DEPTH + 2)]
_HALF = np.uint64(32)


def normal_form(part: c.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, first symbol of each text, word hashes, word texts): a text is
    one END (what stands before the first word), its words with one space after
    each, and END."""
    low = part.lower()
    starts, ends, text = part.words()
    hashes = part.hashes(low, starts, ends)
    space = c.SPACE[low]
    keep = ~space
    keep[starts - 1] = True  # the byte before a word separates it
    keep[part.start] = True
    fresh = np.diff(text, prepend=-1) > 0
    keep[part.start[text[fresh]]] = False  # a text with words has its first sign before the first word
    symbols = np.where(space, np.uint8(0x20), low)
    symbols[starts[fresh] - 1] = END
    empty = np.bincount(text, minlength=part.n) == 0
    symbols[part.start[empty]] = END
    keep[starts - 1] = True
    place = np.concatenate([[0], np.cumsum(keep)])
    stop = place[part.stop]
    at = np.concatenate([stop[~empty], stop])
    signs = np.concatenate([np.full((~empty).sum(), 0x20, np.uint8), np.full(part.n, END, np.uint8)])
    order = np.argsort(at, kind="stable")
    out = np.insert(symbols[keep], at[order], signs[order])
    more = 1 + ~empty
    first = place[part.start] + np.cumsum(more) - more
    return out, first, hashes, text


def grams(symbols: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions to predict and, for each, the DEPTH bytes before it and itself,
    the latest lowest, packed in 64 bits.  What lies before a text is all END."""
    n = len(symbols)
    lengths = np.diff(np.append(first, n))
    place = np.arange(n) + np.repeat(DEPTH * np.arange(1, len(first) + 1), lengths)
    wide = np.full(n + DEPTH * len(first), END, np.uint64)
    wide[place] = symbols
    for step in (1, 2, 4):
        wide[step:] |= wide[:-step] << np.uint64(8 * step)
    inside = np.ones(n, bool)
    inside[first] = False
    at = np.flatnonzero(inside)
    return at, wide[place[at]]


def sent_form(gram: np.ndarray) -> np.ndarray:
    """Grams with the bytes by which they are dealt highest, latest first, then
    the byte to predict, then the others, latest first.  In this order those of
    a range lie close, so that their differences are small."""
    gram = gram.byteswap()
    high = gram >> _HALF
    high = (high << _BYTE | high >> np.uint64(24)) & _LOW[4]
    return high << _HALF | gram & _LOW[4]


def from_sent_form(sent: np.ndarray) -> np.ndarray:
    high = sent >> _HALF
    high = (high >> _BYTE | high << np.uint64(24)) & _LOW[4]
    return (high << _HALF | sent & _LOW[4]).byteswap()


def _base_counts(batches):
    """Counts of the lowest BASE bytes of the grams, merged as they come."""

    def parts():
        for column in (b.column("text").slice(lo, SLICE_ROWS) for b in batches for lo in range(0, b.num_rows, SLICE_ROWS)):
            for part in c.slices(c.as_bytes(column), SLICE_BYTES):
                symbols, first, _, _ = normal_form(part)
                yield np.unique(grams(symbols, first)[1] & _LOW[BASE], return_counts=True)

    keys, counts = sum_up(parts())
    for lo in range(0, len(keys), 200_000):
        yield {"gram": keys[lo : lo + 200_000].view(np.int64), "n": counts[lo : lo + 200_000]}


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Several arrays of keys as one of distinct ones, sorted, and the sums of their counts."""
    k, n = np.concatenate([np.zeros(0, np.uint64), *(k for k, _ in parts)]), np.concatenate([np.zeros(0, np.int64), *(n for _, n in parts)])
    order = np.argsort(k, kind="stable")  # merges what is in order
    k, n = k[order], n[order]
    new = np.ones(len(k), bool)
    new[1:] = k[1:] != k[:-1]
    first = np.flatnonzero(new)
    return k[first], np.add.reduceat(n, first) if len(first) else n


def sum_up(parts) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and the sums of their counts over ``parts`` of
    (keys, counts).  Parts enter the result as they come, a quarter of it at a
    time, so that not much more than the result is held."""
    keys, counts = _merge([])
    more, waiting = [], 0

    def entered():
        if not len(keys):
            return _merge(more)
        k, n = _merge(more)
        at = np.searchsorted(keys, k)
        have = keys.take(at, mode="clip") == k
        counts[at[have]] += n[have]
        at, k, n = at[~have], k[~have], n[~have]
        return np.insert(keys, at, k), np.insert(counts, at, n)

    for part in parts:
        more.append(part)
        waiting += len(part[0])
        if waiting > max(len(keys) // 4, SLICE_BYTES):
            keys, counts = entered()
            more, waiting = [], 0
    return entered()


def pack(x: np.ndarray, differences: bool = False) -> bytes:
    """An array, byte by byte of its numbers, compressed."""
    x = np.diff(x, prepend=x.dtype.type(0)) if differences else x
    raw = np.ascontiguousarray(x.view(np.uint8).reshape(-1, x.itemsize).T).tobytes()
    return len(x).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def unpack(b: bytes, kind: type, differences: bool = False) -> np.ndarray:
    n, size = int.from_bytes(b[:8], "little"), np.dtype(kind).itemsize
    raw = np.frombuffer(pa.decompress(b[8:], n * size, codec="zstd", asbytes=True), np.uint8)
    x = np.ascontiguousarray(raw.reshape(size, n).T).view(kind).reshape(n)
    return np.cumsum(x, dtype=kind) if differences else x


def base(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The lowest BASE bytes of all grams of ``docs`` (text; null: empty),
    sorted, and their counts: no more than there are triples of bytes."""
    got = c.over_batches(docs.select("text"), _base_counts, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toPandas()
    keys, counts = got["gram"].to_numpy(np.int64).view(np.uint64), got["n"].to_numpy(np.int64)
    order = np.argsort(keys)
    return keys[order], counts[order]


def _found(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The values of ``wanted`` among sorted keys; 0 for others."""
    if not len(keys):
        return np.zeros(len(wanted), np.int64)
    at = np.searchsorted(keys, wanted).clip(max=len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], 0)


def _sums(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    k, at = np.unique(keys, return_inverse=True)
    return k, np.bincount(at, n, len(k)).astype(np.int64)


def base_states(known: tuple[np.ndarray, np.ndarray], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probability, count and count of the context of each of ``wanted`` (as in
    ``base``).  Bytes never seen share the weight of one byte."""
    for d in range(BASE):
        keys, n = _sums(known[0] & _LOW[d + 1], known[1])
        mine = wanted & _LOW[d + 1]
        count, size = _found(keys, n, mine), _found(*_sums(keys >> _BYTE, n), mine >> _BYTE)
        if d == 0:
            p = np.where(count > 0, count, 1 / max(1, 256 - len(keys))) / (known[1].sum() + 1)
        else:
            p = np.where(size > 0, (count + SMOOTHING * p) / (size + SMOOTHING), p)
    return p, count, size


def probabilities(gram: np.ndarray, n: np.ndarray, known: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Probability of the last byte of each gram (sorted, distinct) after the
    others, under the tree of their counts ``n``.  Grams with the same lowest
    BASE + 1 bytes must all be there."""
    levels = []  # deepest first: counts, context of each gram, and its place among the shorter grams
    while True:
        new = np.diff(gram >> _BYTE) != 0
        context = np.concatenate([[0], np.cumsum(new, dtype=np.int32)])[: len(gram)].astype(np.int32)
        depth = DEPTH - len(levels)
        if depth < BASE:
            break
        shorter, up = np.unique(gram & _LOW[depth], return_inverse=True)
        levels.append((n, context, up.astype(np.int32)))
        gram, n = shorter, np.bincount(up, n, len(shorter)).astype(np.int64)
    p, n, size = base_states(known, gram)
    states, shares = [], n / np.maximum(size, 1)
    for n, context, up in reversed(levels):
        size = np.bincount(context, n)
        kinds = np.bincount(context, n > 0)
        share = n / np.maximum(size, 1)[context]
        bits = np.zeros(len(n))
        some = n > 0
        bits[some] = n[some] * np.log2(share[some] / shares[up[some]])
        cost = kinds * np.log2(np.maximum(size, 1)) / 2
        states.append((size >= MIN_COUNT) & (np.bincount(context, bits) > DIVERGENCE * cost))
        shares = share
    for deep in range(len(states) - 1, 0, -1):  # suffixes of states
        _, context, up = levels[len(states) - 1 - deep]
        shorter = levels[len(states) - deep][1]
        states[deep - 1][shorter[up[states[deep][context]]]] = True
    for (n, context, up), state in zip(reversed(levels), states):
        size = np.bincount(context, n)
        p = np.where(state[context], (n + SMOOTHING * p[up]) / (size[context] + SMOOTHING), p[up])
    return p


def token_scores(gain: np.ndarray, at: np.ndarray, symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``gain`` (one for each position ``at`` to predict) over each word
    with its space, and over each end, in the order of the texts."""
    begins = symbols[at - 1] == 0x20
    begins[np.searchsorted(at, first)] = True
    return np.add.reduceat(gain, np.flatnonzero(begins))


def _sort_up(keys: np.ndarray, weight: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, and ``weight`` for each time they occur; ``keys`` is sorted in place."""
    keys.sort()
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    first = np.flatnonzero(new)
    return keys[first], np.diff(first, append=len(keys)) * weight


def distinct(texts: list[bytes], learn: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Distinct words, and distinct grams in their sent form, each with their training counts."""
    words = []
    none = np.zeros(0, np.uint64)

    def sorted_chunk(texts: list[bytes], learn: np.ndarray):
        # a text has two grams more than bytes at most; those to learn from stand in front
        room = np.empty(sum(map(len, texts)) + 2 * len(texts), np.uint64)
        front, back = 0, len(room)
        taught_words, other_words = [none], [none]
        for part in c.slices(texts, SLICE_BYTES):
            symbols, first, hashes, text = normal_form(part)
            mine = learn[part.lo : part.hi]
            taught_words.append(hashes[mine[text]])
            other_words.append(hashes[~mine[text]])
            at, gram = grams(symbols, first)
            gram, taught = sent_form(gram), mine[np.searchsorted(first, at, "right") - 1]
            some, rest = gram[taught], gram[~taught]
            room[front : front + len(some)] = some
            room[back - len(rest) : back] = rest
            front, back = front + len(some), back - len(rest)
        words.append(_merge([_sort_up(np.concatenate(taught_words), 1), _sort_up(np.concatenate(other_words), 0)]))
        return _sort_up(room[:front], 1), _sort_up(room[back:], 0)

    chunks = (sorted_chunk(texts[part.lo : part.hi], learn[part.lo : part.hi]) for part in c.slices(texts, CHUNK_BYTES))
    found = sum_up(part for chunk in chunks for part in chunk)
    return _merge(words), found


def gram_range(sent: np.ndarray, ranges: int) -> np.ndarray:
    out = np.empty(len(sent), np.int32)
    for lo in range(0, len(sent), SLICE_BYTES):
        part = slice(lo, lo + SLICE_BYTES)
        out[part] = c.mix(sent[part] >> np.uint64(64 - 8 * BASE)) % np.uint64(ranges)
    return out


def _packed_blocks(batches, block_bytes: int):
    """The rows of a task, cut into blocks of at least ``block_bytes`` of text
    (but for a task's last one, which is at least half of that or alone), each as one
    compressed value."""
    task, number = TaskContext.get().partitionId() << 32, 0

    def packed(rows):
        nonlocal number
        sink = pa.BufferOutputStream()
        table = pa.Table.from_batches(rows).combine_chunks()
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))) as out:
            out.write_table(table)
        number += 1
        return {"block": [task + number], "rows": pa.array([sink.getvalue().to_pybytes()], pa.binary())}

    ready, held, size = [], [], 0
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False) + 1, dtype=np.int64)
        lo, before = 0, 0
        while lo < batch.num_rows:
            hi = min(batch.num_rows, int(np.searchsorted(ends, before + block_bytes - size)) + 1)
            held.append(batch.slice(lo, hi - lo))
            size += ends[hi - 1] - before
            lo, before = hi, ends[hi - 1]
            if size >= block_bytes:
                if ready:
                    yield packed(ready)
                ready, held, size = held, [], 0
    if 2 * size < block_bytes:
        ready, held = ready + held, []
    for rows in (ready, held):
        if rows:
            yield packed(rows)


def _unpacked(rows: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(rows.as_buffer()).read_all()


def _block_words(key, tables):
    """Distinct words and grams of a block by range, with their training counts: a row for every range."""
    block, ranges = key[0].as_py(), tables.column("_ranges")[0].as_py()
    texts, learn = c.as_bytes(tables.column("text").combine_chunks()), np.array(tables.column("_learn").to_pylist(), bool)
    del tables
    (words, counts), (gram, uses) = distinct(texts, learn)
    uses = uses.astype(np.int32)
    del texts
    pick = _by_range(words % np.uint64(ranges), ranges)
    mine = _by_range(gram_range(gram, ranges), ranges)
    return pa.table({
        "block": pa.array([block] * ranges, pa.int64()), "range": pa.array(range(ranges), pa.int32()),
        "words": pa.array([pack(words[p], True) for p in pick], pa.binary()),
        "counts": pa.array([pack(counts[p]) for p in pick], pa.binary()),
        "grams": pa.array([pack(gram[m], True) for m in mine], pa.binary()),
        "uses": pa.array([pack(uses[m]) for m in mine], pa.binary()),
    })


def _asked(key, tables):
    """What a packed block asks of the ranges, with a sum to know it by."""
    rows = tables.column("rows")[0]
    got = _block_words(key, _unpacked(rows))
    return got.append_column("seal", pa.array([zlib.crc32(rows.as_buffer())] * got.num_rows, pa.int64()))


def _by_range(where: np.ndarray, ranges: int) -> list[np.ndarray]:
    """Places of each range's rows, in their order."""
    order = np.argsort(where, kind="stable")
    return np.split(order, np.searchsorted(where[order], np.arange(1, ranges)))


def _range_answers(key, tables, known):
    """For one range: corpus counts of every block's words and log10
    probabilities of its grams, in the order in which the block has sent them,
    and how many training words the range holds, in all and distinct ones.
    What the blocks have sent is unpacked one block at a time."""
    blocks = tables.num_rows

    def sent(keys: str, counts: str, kind: type):
        for k, n in zip(tables.column(keys), tables.column(counts)):
            yield unpack(k.as_py(), np.uint64, True), unpack(n.as_py(), kind)

    def answers(keys: str, known: np.ndarray, values: np.ndarray):
        return pa.array([pack(values[np.searchsorted(known, unpack(k.as_py(), np.uint64, True))]) for k in tables.column(keys)], pa.binary())

    words, total = sum_up(sent("words", "counts", np.int64))
    seen = total[total > 0]
    tokens, kinds = int(seen.sum()), len(seen)
    counts = answers("words", words, total)
    del words, total, seen
    sent_grams, uses = sum_up(sent("grams", "uses", np.int32))
    gram = from_sent_form(sent_grams)
    order = np.argsort(gram)
    gain = np.empty(len(gram), np.float32)
    gain[order] = np.log10(np.maximum(probabilities(gram[order], uses[order], known), 1e-30))
    del uses, gram, order
    return pa.table({
        "block": tables.column("block"), "range": pa.array([key[0].as_py()] * blocks, pa.int32()), "seal": tables.column("seal"),
        "counts": counts, "gains": answers("grams", sent_grams, gain),
        "tokens": pa.array([tokens] * blocks, pa.int64()), "kinds": pa.array([kinds] * blocks, pa.int64()),
    })


def score(docs: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Score every row of ``docs`` under a model of the rows where ``learn``.

    doc_id, held_out (not ``learn``), n_tokens, n_known, train_tokens,
    base_score (unigrams, add-one) and score (suffix tree), in log10.  A null
    text is empty: it is one end sign.  Repeated rows are each counted and
    scored; a null id is passed on; a null ``learn`` is false; other columns
    are not looked at.
    """
    docs = c.narrow(docs, doc_id=doc_id, text=F.coalesce(F.col(text), F.lit("")), _learn=F.coalesce(learn, F.lit(False)))
    shared = docs.sparkSession.sparkContext.broadcast(base(docs.filter("_learn")))
    size, ends = docs.agg(
        F.sum(F.octet_length("text")), F.sum(F.col("_learn").cast("long"))).first()
    size, ends = size or 0, ends or 0
    block_bytes = min(block_bytes, max(size // 8, SLICE_BYTES // 4))
    blocks = max(8, size // block_bytes + 1)
    ranges = max(4, int(blocks * RANGES_PER_BLOCK))
    # no more tasks than blocks, so that none makes much smaller ones; the blocks are shuffled once for both uses
    dealt = c.over_batches(docs.withColumn("_ranges", F.lit(ranges)).coalesce(blocks),
                           lambda batches: _packed_blocks(batches, block_bytes), "block long, rows binary")
    asked = dealt.groupBy("block").applyInArrow(_asked, "block long, range int, words binary, counts binary, grams binary, uses binary, seal long")
    answered = asked.groupBy("range").applyInArrow(lambda key, tables: _range_answers(key, tables, shared.value),
                                                   "block long, range int, seal long, counts binary, gains binary, tokens long, kinds long")
    kind = docs.schema["doc_id"].dataType

    def run(key, left, right):
        rows = left.column("rows")
        if left.num_rows != 1 or right.num_rows != ranges or {zlib.crc32(rows[0].as_buffer())} != set(right.column("seal").to_pylist()):
            raise RuntimeError("the blocks were cut anew from rows in another order")
        left = _unpacked(rows[0])
        texts = c.as_bytes(left.column("text").combine_chunks())
        left = left.drop_columns("text")
        n, v = pc.sum(right.column("tokens")).as_py() + ends, pc.sum(right.column("kinds")).as_py() + (1 if ends else 0)
        known, gram = (keys for keys, _ in distinct(texts, np.zeros(len(texts), bool)))
        where = known % np.uint64(ranges)
        counts = np.zeros(len(known), np.int64)
        mine = _by_range(gram_range(gram, ranges), ranges)
        gains = np.zeros(len(gram), np.float32)
        for r, b, g in zip(*(right.column(x) for x in ("range", "counts", "gains"))):
            counts[where == np.uint64(r.as_py())] = unpack(b.as_py(), np.int64)
            gains[mine[r.as_py()]] = unpack(g.as_py(), np.float32)
        del mine
        value = np.log10((counts + 1) / (n + v + 1))
        end = np.log10((ends + 1) / (n + v + 1))
        n_tokens, n_known = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        base, model = np.zeros(len(texts)), np.zeros(len(texts))
        for part in c.slices(texts, SLICE_BYTES):
            symbols, first, h, owner = normal_form(part)
            at = np.searchsorted(known, h)
            mine = slice(part.lo, part.hi)
            n_tokens[mine] = np.bincount(owner, minlength=part.n) + 1
            n_known[mine] = np.bincount(owner, counts[at] > 0, part.n).astype(int) + (ends > 0)
            base[mine] = np.bincount(owner, value[at], part.n) + end
            here, own = grams(symbols, first)
            own = sent_form(own)
            order = np.argsort(own)
            gain = np.empty(len(own))
            gain[order] = gains[np.searchsorted(gram, own[order])]
            # a word's own count, with as much of the tree as there are kinds of words
            seen = np.insert(counts[at], np.searchsorted(owner, np.arange(part.n), "right"), ends)
            word = np.log10((seen + (v + 1) * 10 ** token_scores(gain, here, symbols, first)) / (n + v + 1))
            whose = np.repeat(np.arange(part.n), n_tokens[mine])
            model[mine] = np.bincount(whose, word, part.n)
        return pa.table({
            "doc_id": left.column("doc_id"), "held_out": pa.array(~np.array(left.column("_learn").to_pylist(), bool)),
            "n_tokens": n_tokens, "n_known": n_known, "train_tokens": np.full(len(texts), n), "base_score": base, "score": model,
        })

    schema = (f"doc_id {kind.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
              "base_score double, score double")
    return dealt.groupBy("block").cogroup(answered.groupBy("block")).applyInArrow(run, schema)
