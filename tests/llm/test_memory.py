"""What a task holds at a time."""

import tracemalloc

import numpy as np
import pyarrow as pa

from quillgate.llm import suffix_tree


def test_suffix_tree_merges_a_block_by_slices():
    """The grams of a block are merged slice by slice: 4 MB of text take less
    than 40 bytes of memory a byte at a time (64 if all are sorted at once)."""
    draw = np.random.default_rng(1)
    words = [f"word{i}" for i in range(500)]
    texts = [" ".join(words[i] for i in draw.integers(0, 500, 300)) for _ in range(2000)]
    size = sum(map(len, texts))
    table = pa.table({"text": texts, "_learn": [i % 7 != 2 for i in range(2000)], "_block": [0] * 2000, "_ranges": [4] * 2000})
    suffix_tree._block_words((pa.scalar(0),), table.slice(0, 10))
    tracemalloc.start()
    got = suffix_tree._block_words((pa.scalar(0),), table)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.num_rows == 4 and size > 4 << 20
    assert peak < 40 * size, peak / size
