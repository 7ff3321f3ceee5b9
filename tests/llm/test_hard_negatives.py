"""Hard negatives: packing and search against a plain scan, shards and blocks, edge cases."""

import math

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from regstar.llm import hard_negatives as H


def plain(rows, every=50):
    """Rows (id, label, vector) by comparing each anchor with everything."""
    able = {(i, k, tuple(math.floor(256 * x) for x in v)) for i, k, v in rows
            if i is not None and k is not None and v and all(x is not None and math.isfinite(x) for x in v)}
    out = []
    for i, k, q in able:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(q, p, strict=True)), j, m) for j, m, p in able if j != i and len(p) == len(q))
        for s, j, _ in [x for x in scored if x[2] == k][:5]:
            fit = [(r, n) for r, n, m in scored if m != k and 50 * -s <= 100 * -r <= 95 * -s][:3]
            out += [(i, j, rank + 1, n, -s, -r) for rank, (r, n) in enumerate(fit)]
    return sorted(out)


def check(spark, rows, every=50):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumns({"id": F.lit("x"), "q": F.lit(1), "aid": F.lit(None)})
    got = sorted(map(tuple, H.mine_hard_negatives(df.repartition(3), anchor_every=every).collect()))
    exact = [(i, k, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, k, v in rows]
    assert got == plain(exact, every)
    return got


@given(st.integers(0, 300), st.integers(1, 5), st.integers(1, 20), st.integers(0, 3))
@settings(max_examples=60, deadline=None)
def test_packing_holds_every_row_once_and_boxes_hold_their_rows(n, d, leaf, seed):
    x = np.random.default_rng(seed).integers(-4, 4, size=(n, d))
    tree = H.RTree(x, leaf)
    assert sorted(tree.order.tolist()) == list(range(n))
    assert all(0 < b - a <= leaf for a, b in zip(tree.first, tree.last, strict=True))
    q = np.random.default_rng(seed + 9).integers(-4, 4, size=(3, d))
    wide = np.full(3, -(H.LOWEST // 2))
    bound = tree.leaf_bounds(q, -wide, wide) if n else None
    for at, (a, b) in enumerate(zip(tree.first, tree.last, strict=True)):
        assert (bound[:, at] >= (q @ tree.x[a:b].T).max(axis=1)).all()


@given(st.integers(1, 200), st.integers(0, 5), st.integers(1, 6), st.booleans())
@settings(max_examples=60, deadline=None)
def test_best_first_equals_a_scan(n, seed, keep, same):
    rng = np.random.default_rng(seed)
    x, q = rng.integers(-3, 3, size=(n, 3)).astype(float), rng.integers(-3, 3, size=(4, 3)).astype(float)
    ids, labels = rng.permutation(n) + 10, rng.integers(0, 3, n)
    own, label = np.array([10, 11, -1, -2]), np.array([0, 1, 2, 0])
    least, most = rng.integers(-9, 3, size=(4, 2)), rng.integers(0, 12, size=(4, 2))
    tree = H.RTree(x, 8)
    got = H.best_first(tree, ids[tree.order], labels[tree.order], q, own, label, least, most, keep, same)
    want = []
    for a in range(4):
        for w in range(2):
            fit = sorted((-int(q[a] @ x[r]), int(ids[r])) for r in range(n) if (labels[r] == label[a]) == same and ids[r] != own[a]
                         and least[a, w] <= q[a] @ x[r] <= most[a, w])[:keep]
            want += [(a, w, i, -s) for s, i in fit]
    assert sorted(zip(*(c.tolist() for c in got), strict=True)) == sorted(want)


def test_boxes_far_from_an_anchor_are_left_out():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(400, 2)) + c for c in ((100, 0), (0, 100), (-100, 0), (0, -100))])
    tree = H.RTree(np.floor(x), 50)
    bound = tree.leaf_bounds(np.array([[1.0, 0.0]]), np.array([50]), np.array([1000]))
    assert (bound > H.LOWEST).sum() <= 10 < len(tree.first)


def test_shards_and_blocks_give_the_same_rows(spark, monkeypatch):
    rng = np.random.default_rng(2)
    centre = rng.normal(size=(12, 6))
    rows = [(k, int(k % 4), (centre[k % 12] + 0.3 * rng.normal(size=6)).astype(float).tolist()) for k in range(900)]
    rows += [(2000 + k, k % 3, [0.5] * 6) for k in range(450)]  # a third of all rows are one vector
    whole = check(spark, rows, 30)
    monkeypatch.setattr(H, "SHARD_ROWS", 100)
    monkeypatch.setattr(H, "ANCHOR_ROWS", 7)
    assert check(spark, rows, 30) == whole and len(whole) > 100


def test_edges(spark):
    rng = np.random.default_rng(3)
    rows = [(k, k % 3, rng.normal(size=4).tolist()) for k in range(60)]
    rows += [(70, None, [1.0] * 4), (71, 1, None), (72, 1, []), (73, 1, [None, 1.0, 1.0, 1.0]), (74, 2, [float("nan"), 1.0, 1.0, 1.0]),
             (75, 2, [float("inf"), 1.0, 1.0, 1.0]), (None, 1, [1.0] * 4), (80, 1, [0.0] * 4), (81, 1, [0.0] * 4),
             (100, 0, [1.0, 2.0]), (101, 0, [1.0, 2.0]), (102, 1, [0.5, 1.0]), (103, 1, [0.5, 1.0]), (150, 7, [1.0, 1.0, 1.0, 1.0])]
    check(spark, rows + rows[:20] + rows[:20], 10)
    check(spark, [])
    with pytest.raises(Exception, match="too large"):
        check(spark, [(0, 1, [1e30])])
