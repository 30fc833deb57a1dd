"""Packing: token ids, patterns, places, whole results."""

import zlib
from collections import Counter
from itertools import combinations_with_replacement

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from quillgate.llm import packing
from quillgate.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
ODD = "aZ09 .,'!<|>sStTéÀÖßſǰJ̌ĸÉİ́ͅΣσςKÅ한ᄀ́  \x1c\x85\t\n😀中$½²"


@pytest.fixture(scope="module")
def ids():
    return packing.Ids(packing.VOCABULARY)


def plainly(ids, text):
    return ids.tokenizer.encode(text, add_special_tokens=False).ids


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.text(alphabet=ODD, max_size=30), st.sampled_from(["'s", "it's", "<|endoftext|>", "<|ENDOFTEXT|>", " a<|startoftext|>b "])), max_size=6))
def test_ids_equal_the_tokenizer(parts):
    encoder = packing.ids_of(packing.VOCABULARY)
    text = "".join(parts)
    got = list(encoder.of([text.encode(), b"", text.encode()]))
    assert got[0].tolist() == plainly(encoder, text) == got[2].tolist() and len(got[1]) == 0


def test_ids_of_documents_and_long_texts(ids, spark):
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").filter("text is not null").select("text").collect()]
    texts.append(" ".join(texts) * 12)
    assert len(texts[-1]) > packing.SLICE_BYTES
    texts.append("x" * 3_000)
    for text, got in zip(texts, ids.of([t.encode() for t in texts])):
        assert got.tolist() == plainly(ids, text)


def test_remembered_words_are_bounded(monkeypatch, ids):
    monkeypatch.setattr(packing, "MEMORY_BYTES", 2_000)
    fresh = packing.Ids(packing.VOCABULARY)
    for i in range(30):
        words = " ".join(f"w{i}x{j}" for j in range(20))
        assert next(fresh.of([words.encode()])).tolist() == plainly(ids, words)
        assert len(fresh.chunks.number) <= 80


def test_knapsack_is_cheapest():
    lengths, cost = np.array([3, 4, 7, 11]), np.array([1.0, 2.0, 2.5, 3.6])
    best, _ = packing.cheapest_fills(lengths, cost, 20)
    for total in range(1, 21):
        every = [sum(cost[list(x)]) for n in range(1, 8) for x in combinations_with_replacement(range(4), n) if lengths[list(x)].sum() == total]
        assert best[total] == pytest.approx(min(every, default=np.inf))


@pytest.mark.parametrize("lengths, demand, most", [
    ([6, 4, 3, 2], [4, 4, 4, 3], 5.5),
    ([7, 3], [5, 2], 2.0), ([9], [4], 0.0), ([5], [7], 3.5), ([1], [25], 2.5),
])
def test_linear_program(lengths, demand, most):
    at = np.argsort(lengths)
    patterns, times, bound = packing.most_full_sequences(np.array(lengths)[at], np.array(demand)[at], 10, gap=0.0)
    assert times.sum() == pytest.approx(most, abs=0.02)
    if most:  # the dual value closes the gap, so no better program exists
        assert times.sum() - 0.02 <= bound <= times.sum() + 0.05
    assert all(sum(np.array(lengths)[at][i] * n for i, n in p.items()) == 10 for p in patterns)


def lay_out(counts, size, grain):
    """All pieces placed at once: tokens of each sequence, rows per piece."""
    p = packing.plan(counts, size, grain)
    length = np.repeat(list(counts), list(counts.values())).astype(np.int64)
    rank = np.concatenate([np.arange(n) for n in counts.values()]).astype(np.int64)
    return p, length, packing.places(p, length, rank)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 32), st.integers(1, 40), min_size=1, max_size=20), st.sampled_from([1, 2, 4]))
def test_places_are_whole(counts, grain):
    p, length, (row, before, cut, sequence, slot) = lay_out(counts, 32, grain)
    assert np.array_equal(np.bincount(row, cut, minlength=len(length)), length)
    for r in np.flatnonzero(np.bincount(row) > 1):
        mine = np.argsort(before[row == r])
        b, n = before[row == r][mine], cut[row == r][mine]
        assert b[0] == 0 and np.array_equal(np.cumsum(n)[:-1], b[1:])
    assert len({*zip(sequence.tolist(), slot.tolist())}) == len(row)
    totals = Counter()
    for s, n in zip(sequence.tolist(), cut.tolist()):
        totals[s] += n
    assert max(totals.values()) <= 32 and sorted(totals) == list(range(len(totals)))
    in_line = {s: n for s, n in totals.items() if s >= p.first}
    short = [n for n in in_line.values() if n < 32]
    assert len(set(short)) == len(short) and all(n & (n - 1) == 0 for n in short)
    if grain == 1:
        assert all(n == 32 for s, n in totals.items() if s < p.first)


def test_most_tokens_go_by_patterns():
    """Of many documents nearly all stay whole, and there is hardly any padding."""
    draw = np.random.default_rng(5)
    counts = Counter(np.clip(draw.lognormal(5.5, 1.0, 60_000), 1, 2047).astype(int).tolist())
    p, length, (row, before, cut, sequence, _) = lay_out(dict(counts), 2048, packing.GRAIN)
    totals = np.bincount(sequence, cut).astype(int)
    padding = sum(2048 - n for n in totals if n & (n - 1))
    assert p.cuts[-1] < 0.03 * length.sum()
    assert padding < 0.01 * length.sum()
    assert (np.bincount(row) > 1).mean() < 0.01


TEXTS = ["", None, "one two three", "a " * 5000, "same text here"] + ["same text here"] * 40 + [f"text of number {i} " * (i % 90) for i in range(300)]


def check(rows, texts, size, ids):
    """Pieces hold every id once, sequences are gapless and within bounds."""
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.key, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert len(by_doc) == len(texts)
    for key, mine in by_doc.items():
        want = np.array([*plainly(ids, texts[key] or ""), 1], "<u4")
        at = 0
        for r in sorted(mine, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(want)
            assert r.ids_crc32 == zlib.crc32(want[at : at + r.length].tobytes())
            at += r.length
        assert at == len(want)
    padding = 0
    for mine in by_sequence.values():
        at = 0
        for r in sorted(mine, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= size
        padding += size - at if at & (at - 1) else 0
    return padding


def test_pieces_are_whole(spark, ids):
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(TEXTS)], "key int, text string, part int, offset int").repartition(5)
    packed = packing.pack(docs, keep=[F.col("key"), F.col("part").alias("my part")], size=64, grain=2)
    rows = packed.pieces.collect()
    assert check(rows, dict(enumerate(TEXTS)), 64, ids) < 0.05 * sum(r.length for r in rows)
    for r in packed.with_ids().collect():
        assert zlib.crc32(r.ids) == r.ids_crc32
    whole = {r.sequence_id: r for r in packed.sequences().collect()}
    assert {s: sum(r.lengths) for s, r in whole.items()} == {s: len(r.ids) // 4 for s, r in whole.items()}
    flat = Counter(i for r in whole.values() for i in np.frombuffer(r.ids, "<u4").tolist())
    assert flat == Counter(i for t in TEXTS for i in [*plainly(ids, t or ""), 1])


def test_empty_table_and_null_ids(spark, ids):
    schema = "key long, text string"
    assert packing.pack(spark.createDataFrame([], schema), keep=[F.col("key")]).pieces.count() == 0
    rows = packing.pack(spark.createDataFrame([(None, "a b"), (None, "a b"), (1, None)], schema), keep=[F.col("key")]).pieces.collect()
    assert sorted((r.key or 0, r.doc_tokens) for r in rows if r.start == 0) == [(0, 3), (0, 3), (1, 1)]
    assert sum(r.length for r in rows) == 7


def test_query(spark, ids):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op11_column_generation"](spark, SF).withColumnRenamed("doc_id", "key").collect()
    assert check(rows, texts, 2048, ids) < 0.02 * sum(r.length for r in rows)
