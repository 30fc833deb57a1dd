"""Hard negatives: trees, bounds, whole results against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillgate.llm import hard_negatives as hn

SCHEMA = "vec_id long, embedding array<double>, label int, key string, cell int"


def plainly(rows, every, positives=5, negatives=3):
    """All pairs, in Python integers."""
    fine = {}
    for i, vec, label in rows:
        if i is None or label is None or vec is None or any(v is None or not np.isfinite(v) for v in vec):
            continue
        whole = tuple(int(np.floor(256 * v)) if abs(256 * v) < 2**52 else int(256 * v) for v in vec)
        fine[i, label, whole] = None
    fine = list(fine)
    out = []
    for a in fine:
        if a[0] % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a[2], b[2])), b[0], b[1]) for b in fine if b is not a)
        for s, i, _ in [x for x in scored if x[2] == a[1]][:positives]:
            hits = [(-t, j) for t, j, lab in scored if lab != a[1] and -50 * s <= -100 * t <= -95 * s][:negatives]
            out += [(a[0], i, r, j, -s, t) for r, (t, j) in enumerate(hits, 1)]
    return sorted(out)


def mined(spark, rows, every, **more):
    frame = spark.createDataFrame([(*r, "own key", 3) for r in rows], SCHEMA)
    return sorted(tuple(r) for r in hn.mine(frame, F.col("vec_id") % every == 0, **more).collect())


def clustered(n, dim, seed, groups=8):
    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(groups, dim))
    return (centres[draw.integers(groups, size=n)] + 0.1 * draw.normal(size=(n, dim))).round(3)


@pytest.mark.parametrize("fanout, leaf", [(2, 1), (4, 3), (16, 40)])
def test_cover_tree(fanout, leaf):
    """Own centre among the children, every row within the radius, centres
    apart by what covers the rest, each row in one leaf."""
    x = np.floor(256 * clustered(500, 6, 1))
    top = float((x**2).sum(1).max())
    tree = hn.plant(x, np.arange(500) % 7, [[i] for i in range(500)], top, leaf_rows=leaf, fanout=fanout)
    high = hn.raised(tree.x, top)

    def below(node):
        if tree.leaf[node]:
            return list(range(tree.first[node], tree.last[node]))
        return [r for child in range(tree.first[node], tree.last[node]) for r in below(child)]

    assert sorted(below(0)) == list(range(500))
    for node in range(len(tree.leaf)):
        rows = below(node)
        assert hn.distances(high[rows], high[tree.centre[node]]).max() <= tree.radius[node] + 1e-9
        assert np.bitwise_or.reduce(hn.bit(tree.labels[rows])) == tree.bits[node]
        if not tree.leaf[node]:
            children = np.arange(tree.first[node], tree.last[node])
            assert tree.centre[node] in tree.centre[children]
            cover = tree.radius[children].max()
            for i, child in enumerate(children[1:], 1):
                assert hn.distances(high[tree.centre[children[:i]]], high[tree.centre[child]]).min() >= cover - 1e-9


def test_bounds_hold():
    x = np.floor(256 * clustered(300, 5, 2))
    top = float((x**2).sum(1).max())
    high = hn.raised(x, top)
    q = x[17]
    for centre in range(0, 300, 20):
        near = np.argsort(hn.distances(high, high[centre]))[:30]
        radius = hn.distances(high[near], high[centre]).max()
        least, most = hn.ball_bounds(np.array([x[centre] @ q]), np.array([radius]), float(q @ q), top)
        assert least[0] <= (x[near] @ q).min() and (x[near] @ q).max() <= most[0]


@pytest.mark.parametrize("together", [1, 20])
def test_descent_skips_nodes_and_loses_nothing(together):
    x = np.floor(256 * clustered(4000, 8, 3, groups=40))
    labels = np.random.default_rng(3).integers(0, 5, 4000)
    tree = hn.plant(x, labels, [[i] for i in range(4000)], float((x**2).sum(1).max()), leaf_rows=32)
    place = {tuple(row): i for i, row in enumerate(x)}
    order = np.array([place[tuple(row)] for row in tree.x])
    read = []

    class Counted(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, slice):
                read.append(at.stop - at.start)
            return np.asarray(self)[at]

    tree.x = tree.x.view(Counted)
    asked = list(range(0, 4000, 200))
    for lo in range(0, len(asked), together):
        some = np.array(asked[lo : lo + together])
        best = [[hn.Best(6)] for _ in some]
        hn.descend(tree, x[some], labels[some], best, True)
        windows = [[hn.Best(3, *hn.score_window(-n, 50, 95, 100)) for n, _, _ in b.found[1:]] for (b,) in best]
        hn.descend(tree, x[some], labels[some], windows, False)
        for a, (b,), mine in zip(some, best, windows):
            s = x @ x[a]
            first = lambda rows, k: sorted(((int(s[i]), int(i)) for i in rows), key=lambda t: (-t[0], t[1]))[:k]
            assert [(-n, i) for n, i, _ in b.found] == first(np.flatnonzero(labels == labels[a]), 6)
            assert [i for _, i, same in b.found if same] == [i for _, i, _ in b.found if i == a]
            for (n, _, _), w in zip(b.found[1:], mine):
                assert [(-m, i) for m, i, _ in w.found] == first([i for i in np.flatnonzero(labels != labels[a]) if 50 * -n <= 100 * s[i] <= 95 * -n], 3)
    assert sorted(order) == list(range(4000))
    if together == 1:
        assert sum(read) < 2 * len(asked) * 400  # of 4,000 rows


@pytest.mark.parametrize("cell_rows", [8192, 40])
def test_equals_brute_force(spark, monkeypatch, cell_rows):
    """Clusters, copies (a third of all rows, other labels too), exact ties,
    repeated rows; one cell and many cells in parts."""
    monkeypatch.setattr(hn, "BLOCK_QUERIES", 5 if cell_rows == 40 else 65536)
    monkeypatch.setattr(hn, "MOST_CELLS", 3 if cell_rows == 40 else 4096)
    draw = np.random.default_rng(4)
    vecs = clustered(400, 4, 5)
    rows = [(i, [float(v) for v in vecs[i]], int(draw.integers(4))) for i in range(400)]
    rows += [(400 + i, [0.5, 0.25, 1.0, -0.5], i % 9 // 7) for i in range(200)]
    rows += rows[:20] + [(7, [0.1, 0.2, 0.3, 0.4], 1), (10, [0.1, 0.2, 0.3, 0.4], 2)]
    assert mined(spark, rows, 10, cell_rows=cell_rows) == plainly(rows, 10)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 1), (1, [0.9, 0.5], 1), (2, [0.8, 0.1], 2), (3, [0.6, 0.3], 2), (4, None, 1), (5, [1.0, None], 2),
            (6, [nan, 1.0], 2), (7, [inf, 1.0], 2), (None, [1.0, 0.6], 2), (8, [0.7, 0.3], None), (9, [0.8], 2), (10, [], 2), (11, [0.0, 0.0], 1)]
    padded = [(i, v + [0.0] * (2 - len(v)) if v is not None else None, lab) for i, v, lab in rows]
    got = mined(spark, rows, 1)
    assert got == plainly(padded, 1) and got
    assert mined(spark, rows[4:8], 1) == [] and mined(spark, rows[:1], 1) == [] and mined(spark, [], 1) == []
    assert mined(spark, rows, 1000) == plainly(padded, 1000)


def test_integers_beyond_doubles(spark):
    draw = np.random.default_rng(6)
    rows = [(i, [float(v) for v in np.floor(draw.normal(size=3) * 2.0**20)], i % 3) for i in range(60)]
    assert mined(spark, rows, 5) == plainly(rows, 5)


@pytest.mark.parametrize("positive, window", [(100, (50, 95)), (101, (51, 95)), (0, (0, 0)), (1, (1, 0)), (7, (4, 6))])
def test_window(positive, window):
    assert hn.score_window(positive, 50, 95, 100) == window
