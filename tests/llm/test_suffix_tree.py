"""What the suffix tree sends between its tasks."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillgate.llm import suffix_tree


def syllables(n, size, seed):
    """``n`` texts of ``size`` words, put together from a few syllables."""
    draw = np.random.default_rng(seed)
    some = np.array("th he an in er on re ed nd ha at en es of or nt ea ti to io le is ou ar as de rt ve".split())
    words = ["".join(some[draw.integers(0, len(some), draw.integers(1, 5))]) for _ in range(20_000)]
    return [" ".join(words[i] for i in draw.integers(0, len(words), size)) for _ in range(n)]


def test_a_block_sends_less_than_its_text():
    """Grams that lie close are sent as small differences: of 2.2 MB of text in 40
    ranges their keys take 0.39 bytes a byte (0.65 sorted by their earliest byte)."""
    texts = syllables(1500, 250, 3)
    table = pa.table({"text": texts, "_learn": [i % 7 != 2 for i in range(1500)], "_ranges": [40] * 1500})
    got = suffix_tree._block_words((pa.scalar(0),), table)
    sent = sum(map(len, got.column("grams").to_pylist()))
    assert sent < 0.45 * sum(map(len, texts)), sent / sum(map(len, texts))


def test_texts_are_shuffled_once_and_answers_not_written(spark, tmp_path):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(syllables(60, 40, 4))], "doc_id long, text string")
    got = suffix_tree.score(docs, F.col("doc_id") % 3 != 0)
    assert len(got.collect()) == 60
    plan = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("ReusedExchange") == 1
    assert plan.count("Exchange hashpartitioning") == 4  # blocks (named again where reused), ranges, answers
    assert "MapInArrow" in plan and "suffix-words" not in plan


def test_sent_form_is_reversible():
    gram = np.array([0x0706050403020153, 0, 0xFFFFFFFFFFFFFFFF, 0x0A0A0A0A0A0A0A61], np.uint64)
    sent = suffix_tree.sent_form(gram)
    assert hex(sent[0]) == "0x102035304050607"  # latest three, what follows, the others
    assert (suffix_tree.from_sent_form(sent) == gram).all()


@pytest.mark.parametrize("parts", [1, 7, 40])
def test_cut_of_blocks_changes_no_score(spark, parts):
    """Blocks lie where the rows lie, down to one row each: no row is lost or told apart, whatever the cut."""
    texts = [*syllables(50, 30, 5), "", None, " \t", "Zqé once", "x" * 9000, "the the"]
    rows = [(None if i % 17 == 3 else f"d{i % 40}", t, None if i % 11 == 5 else i % 3 != 0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id string, text string, taught boolean")
    key = lambda r: [str(x) for x in r]
    ask = lambda df, size: sorted((tuple(r) for r in suffix_tree.score(df, F.col("taught"), block_bytes=size).collect()), key=key)
    want = ask(docs.coalesce(1), 1 << 30)
    assert len(want) == len(rows)
    got = ask(docs.repartition(parts, "text"), 200)
    assert [r[:-2] for r in got] == [r[:-2] for r in want]
    assert np.allclose([r[-2:] for r in got], [r[-2:] for r in want], rtol=1e-9)


def test_blocks_are_neither_small_nor_much_too_large(monkeypatch):
    """Two thousand rows as one task gets them, in batches cut anywhere: every row once, in order."""
    monkeypatch.setattr(suffix_tree.TaskContext, "get", classmethod(lambda cls: type("Task", (), {"partitionId": lambda self: 3})()))
    texts = [t[: 1 + i % 200] for i, t in enumerate(syllables(2000, 30, 6))]
    whole = pa.table({"doc_id": range(2000), "text": texts})
    for rows in (1, 333, 2000):
        got = list(suffix_tree._packed_blocks(iter(whole.to_batches(max_chunksize=rows)), 30_000))
        blocks = [suffix_tree._unpacked(b["rows"][0]) for b in got]
        assert pa.concat_tables(blocks).column("doc_id").to_pylist() == list(range(2000))
        sizes = [sum(len(t) + 1 for t in b.column("text").to_pylist()) for b in blocks]
        assert min(sizes) >= 15_000 and max(sizes) < 46_000
        assert len({b["block"][0] for b in got}) == len(got)
