"""Fill-in-middle against plain slicing, odd texts, exact return."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from quillgate.llm import infill
from quillgate.llm.queries import QUERIES

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


def plainly(doc_id, text):
    """The same by a list of units."""
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    a, b, c, d = (int(h[i : i + 8], 16) for i in range(0, 32, 8))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or c % 100 >= 90:
        return len(units), "plain", None, None, text
    lo, hi = sorted((a % (len(units) + 1), b % (len(units) + 1)))
    p, m, s = "".join(units[:lo]), "".join(units[lo:hi]), "".join(units[hi:])
    if d % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aZ é\n<PSM>1😀́ ", max_size=60))
def test_units_and_offsets(text):
    starts = infill.unit_starts(text)
    units = UNIT.findall(text)
    assert [text[a:b] for a, b in zip(starts, [*starts[1:], len(text)])] == units
    if units:
        lanes = infill.SkipList(starts, len(text))
        assert [lanes.offset(r) for r in range(len(units) + 1)] == [len("".join(units[:r])) for r in range(len(units) + 1)]


def test_lanes_are_express():
    """Far fewer steps than units, and every lane adds up to the whole."""
    starts = np.cumsum(np.arange(100_000) % 7 + 1) - 1
    end = int(starts[-1]) + 5
    lanes = infill.SkipList(starts, end)
    assert 5 <= len(lanes.units) <= 12
    for units, points in zip(lanes.units, lanes.points):
        assert units.sum() == 100_000 and points.sum() == end
    assert all(len(b) < 0.5 * len(a) + 2 for a, b in zip(lanes.units, lanes.units[1:]))
    for rank in (0, 1, 2, 77_777, 99_999):
        assert lanes.offset(rank) == starts[rank]
    assert lanes.offset(100_000) == end


TEXTS = [None, "", "a", "😀", "one two", "x<P>y", "<S", "S>", "<", "a < b <M", "M>", "<P", "word " * 50, "é" * 40, "tab\tnew\nline\r\x00"]
ROWS = [(i, TEXTS[i % len(TEXTS)], "x", "y", 5) for i in range(300)] + [(7, "same row", "x", "y", 5)] * 2 + [(None, "no id at all", None, None, None)]
SCHEMA = "doc_id long, text string, output string, form string, n long"


def test_rows_equal_slicing(spark):
    """Nulls, odd texts, repeated rows, and columns that clash with the results."""
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = infill.rearrange(docs, keep=[F.col("doc_id"), F.col("text"), F.col("form").alias("old form")])
    rows = got.withColumn("again", infill.restored()).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plainly(r.doc_id, r.text)
        assert r.again == (r.text or "")
    assert {"plain", "psm", "spm"} == {r.form for r in rows}
    none = infill.rearrange(docs.limit(0))
    assert none.columns == ["n", "form", "prefix_chars", "middle_chars", "output"] and none.count() == 0


def test_very_long_text(spark):
    text = "lorem ipsum, dolor < sit 12 " * 120_000
    docs = spark.range(40).select(F.col("id").alias("doc_id"), F.lit(text).alias("text")).filter("doc_id in (3, 4, 7)")
    for r in infill.rearrange(docs, keep=[F.col("doc_id")]).withColumn("again", infill.restored()).collect():
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == plainly(r.doc_id, text)
        assert r.again == text


@pytest.mark.parametrize("shares, forms", [((0, 0), {"psm"}), ((0, 100), {"spm"}), ((100, 0), {"plain"})])
def test_shares(spark, shares, forms):
    docs = spark.createDataFrame([(i, f"some words of text {i}") for i in range(50)], "doc_id long, text string")
    assert {r.form for r in infill.rearrange(docs, plain_share=shares[0], suffix_first_share=shares[1], seed="other").collect()} == forms


def test_query_rows(spark):
    got = QUERIES["op12_skip_list"](spark, "/root/testdata/sf0.001")
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()}
    rows = got.collect()
    assert len(rows) == len(docs)
    for r in rows:
        n, form, p, m, output = plainly(r.doc_id, docs[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, p, m)
        assert r.output_sha256 == hashlib.sha256(output.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()
