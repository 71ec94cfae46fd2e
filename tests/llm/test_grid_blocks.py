"""The grid join on what one pair of intervals holds: all near copies of one another, and vectors wider than the sketch."""

import tracemalloc

import numpy as np

from catalume.llm import grid


def test_pairs_of_near_copies_are_never_held_at_once(monkeypatch):
    r = np.random.default_rng(1)
    x = r.normal(size=(1, 32)) + 0.01 * r.normal(size=(3000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    axes = np.linalg.qr(r.normal(size=(32, 16)))[0]
    tracemalloc.start()
    n, root = np.zeros(3000, np.int64), np.arange(3000)
    for i, j in grid.compare(x, x, axes, 0.95, True):
        assert len(i) <= 1 << 16
        np.add.at(n, i, 1)
        np.add.at(n, j, 1)
        grid.merge(root, i, j)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (n == 2999).all() and (root == 0).all()
    assert peak < 90_000_000  # a list of 4.5 million pairs and their vectors would be over 2 GB


def test_merging_is_that_of_plain_components():
    r = np.random.default_rng(2)
    root, label = np.arange(400), list(range(400))
    for _ in range(6):
        i, j = r.integers(0, 400, 60), r.integers(0, 400, 60)
        grid.merge(root, i, j)
        for a, b in zip(i, j):
            low, high = sorted((label[a], label[b]))
            label = [low if x == high else x for x in label]
        assert root.tolist() == label


def test_wide_vectors(spark):
    r = np.random.default_rng(3)
    base = r.normal(size=(30, 700))
    x = np.concatenate([base, base[:12] + 0.05 * r.normal(size=(12, 700)), base[:5] * 3]).astype(np.float32)
    docs = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = {g.vec_id: (g.n_links, g.component_id) for g in grid.near_duplicates(docs, size=8).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = u @ u.T >= 0.95
    assert got == {i: (int(near[i].sum()) - 1, int(np.flatnonzero(near[i]).min())) for i in range(len(x))}
