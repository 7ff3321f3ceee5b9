"""The spanning forest of a block's links against a plain one, links against all pairs, and the disk they take."""

import os

import numpy as np
from hypothesis import given, settings, strategies as st

from regstar.llm import embedding_dedup
from regstar.llm.embedding_dedup import Forest, lay_tiles, link_vectors, nearest, unit
from regstar.session import ensure_checkpoint_dir


def classes(n, pairs):
    root = list(range(n))
    for _ in range(n):
        for i, j in pairs:
            root[i] = root[j] = min(root[i], root[j])
    return root


@given(st.integers(1, 12), st.lists(st.lists(st.tuples(st.integers(0, 11), st.integers(0, 11)), max_size=20), max_size=4))
@settings(max_examples=150, deadline=None)
def test_forest_joins_what_the_links_join(n, batches):
    batches = [[(i % n, j % n) for i, j in b] for b in batches]
    forest = Forest(np.arange(n) * 10)
    for b in batches:
        forest.join(np.array([i for i, _ in b], dtype=np.int64), np.array([j for _, j in b], dtype=np.int64))
    every = [p for b in batches for p in b]
    links = [(u // 10, v // 10) for u, v in forest.links]
    assert classes(n, links) == classes(n, every)
    assert len(links) == n - len(set(classes(n, every))) and set(links) <= set(every)


def test_dense_groups(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(size=(60, 16)), rng.normal(size=16) + 0.05 * rng.normal(size=(900, 16))])
    rows = [(k, v.tolist()) for k, v in enumerate(x)]
    got = {r.id: (r.n_links, r.component_id) for r in link_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = u @ u.T >= 0.9
    np.fill_diagonal(close, False)
    assert [got[k][0] for k in range(len(x))] == close.sum(axis=1).tolist()
    assert all(got[k][1] == 60 for k in range(60, 960))


def test_tiles_hold_whole_cells_or_pieces_of_one():
    rng = np.random.default_rng(1)
    c, weight = rng.normal(size=(40, 8)), rng.integers(1, 30, 40)
    weight[7] = 1000
    first, pieces = lay_tiles(c, weight, 100)
    tiles = [set(range(f, f + p)) for f, p in zip(first.tolist(), pieces.tolist(), strict=True)]
    assert set.union(*tiles) == set(range(max(map(max, tiles)) + 1)) and pieces[7] == 10 and (np.delete(pieces, 7) == 1).all()
    for i in range(40):
        own = [j for j in range(40) if tiles[i] & tiles[j]]
        assert own == [7] if i == 7 else weight[own].sum() <= 100


def test_equal_vectors_have_one_home_wherever_they_stand():
    rng = np.random.default_rng(2)
    c = unit(rng.normal(size=(50, 64)))
    x = unit(np.concatenate([c[3] + c[11], c[4] + c[30], rng.normal(size=64 * 500)]).reshape(-1, 64))
    alone = [int(nearest(v[None], c)[0]) for v in x]
    for _ in range(5):
        order = rng.permutation(np.repeat(np.arange(len(x)), 2))[:rng.integers(300, 1000)]
        assert nearest(x[order], c).tolist() == [alone[i] for i in order]


def test_links_across_many_tiles(spark, monkeypatch):
    """Loose and dense groups, multiples and copies of vectors, ids that repeat: cut into many tiles, a dense group into several."""
    monkeypatch.setattr(embedding_dedup, "TILE_LEAST", 50)
    monkeypatch.setattr(embedding_dedup, "TILE", 0)
    monkeypatch.setattr(embedding_dedup, "SAMPLE", 300)
    rng = np.random.default_rng(7)
    groups = [rng.normal(size=32) + s * rng.normal(size=(m, 32)) for s, m in ((0.02, 260), (0.25, 150), (0.33, 150), (0.4, 60))]
    x = np.concatenate([rng.normal(size=(400, 32)), *groups]).astype(np.float32)
    x = np.concatenate([x, 2 * x[::20], x[::30], x[::30]])[rng.permutation(len(x) + len(x[::20]) + 2 * len(x[::30]))]
    got = {r.id: (r.n_links, r.component_id) for r in link_vectors(
        spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(5)).collect()}
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    close = u @ u.T >= 0.9
    np.fill_diagonal(close, False)
    assert [got[k][0] for k in range(len(x))] == close.sum(axis=1).tolist()
    assert [got[k][1] for k in range(len(x))] == classes_of(close)


def classes_of(close):
    least = np.arange(len(close))
    while True:
        new = np.minimum(least, np.where(close, least[None], len(close)).min(axis=1))
        if (new == least).all():
            return least.tolist()
        least = new


def test_disk_does_not_grow_with_the_cells_that_a_vector_is_near(spark, tmp_path):
    """Random vectors are near many borders; still the disk holds each about twice: once shuffled, once stored."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(20_000, 64)).astype(np.float32)
    spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(4).write.parquet(str(tmp_path / "v"))

    def kept():
        folders = [str(f) for f in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
        folders.append(ensure_checkpoint_dir(spark).removeprefix("file:"))
        return {os.path.join(d, f): os.path.getsize(os.path.join(d, f)) for top in folders for d, _, names in os.walk(top) for f in names}

    before = kept()
    assert link_vectors(spark.read.parquet(str(tmp_path / "v"))).filter("n_links = 0").count() == len(x)
    assert sum(size for path, size in kept().items() if path not in before) <= 4 * x.nbytes
