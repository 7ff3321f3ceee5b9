"""Near-duplicate vectors: spherical k-means cells, packed in tiles that meet where they are stored.

1. Equal vectors are one vector with a count. Centroids are fitted on a bounded
   sample; every vector's *home* is the cell of its nearest centroid. Vectors are
   shuffled once, to the *tile* that holds their home: neighbouring cells up to a
   number of vectors, or a piece of a cell that has more. A tile is one stored row.
2. Every two tiles meet in a task that reads both from that copy (a Cartesian
   product of stored rows: no shuffle). So the disk holds each vector once,
   however many it is compared with. Tiles whose balls are too far apart do not meet.
3. Two unit vectors of cosine s are sqrt(2 - 2 s) apart. The border between two
   cells lies between them, so their distances from it add up to no more than
   that. Only pairs for which they do are looked at; none is missed.
4. Of these, the first of rotated coordinates and the length of the rest bound the
   cosine from above. Whole vectors are multiplied only where the bound reaches.

A task returns sums of links and a spanning forest of its links, never the pairs.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from regstar.llm.common import ship, stage
from regstar.llm.components import components
from regstar.session import scratch_path
from regstar.sources.tables import read_table

THRESHOLD = 0.9
#: Vectors that the centroids are fitted on, about (more if cells are many), and rounds of fitting.
SAMPLE, A_CELL, ROUNDS = 20_000, 8, 12
#: Cells are so many times the root of the vectors' number, at most MOST_CELLS.
CELLS, MOST_CELLS = 0.4, 8192
#: Vectors of a tile: so many times the root of the vectors' number, within bounds, and bytes of it at most.
TILE, TILE_LEAST, TILE_MOST, TILE_BYTES = 16, 4096, 16_384, 4 << 20
#: Bytes of tiles that a task holds on one side, tiles' pairs of a task, and bytes of unpacked tiles that a worker remembers.
SIDE_BYTES, TASK_PAIRS, REMEMBERED = 16 << 20, 64, 80 << 20
#: Settings under which a worker gets two tiles at a time.
TWO_TILES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1"}
#: Rows of a product that are looked at together; pairs that are settled in double precision at once; facts gathered before they are summed up.
STRIP, PAIRS, GATHERED = 256, 1 << 16, 1 << 20
#: Vectors that the number of rotated coordinates is chosen on, and the share of their pairs that the bound may let through.
TRIED, LET_THROUGH = 2000, 2e-4
#: Cells whose centroids are no further apart have no border worth measuring from.
ONE_PLACE = 1e-3


def fit_centroids(x: np.ndarray, k: int, seed: int = 5) -> np.ndarray:
    """Spherical k-means: unit centroids of unit vectors, no two the same."""
    rng = np.random.default_rng(seed)
    c = x[np.sort(rng.choice(len(x), size=min(k, len(x)), replace=False))].copy()
    for _ in range(ROUNDS):
        home = nearest(x, c)
        total = np.zeros_like(c)
        np.add.at(total, home, x)
        norm = np.linalg.norm(total, axis=1)
        c = np.where(norm[:, None] > 1e-9, total / np.maximum(norm, 1e-9)[:, None], c)
    return c[np.sort(np.unique(np.round(c, 7), axis=0, return_index=True)[1])]


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Each row's centroid of greatest inner product; equal rows have the same one wherever they stand.

    A product's last digits depend on the rows around it, so products that are
    all but equal are added up exactly.
    """
    home, rows = np.zeros(len(x), dtype=np.int32), max(64, (1 << 19) // len(c))
    for at in range(0, len(x), rows):
        s = x[at:at + rows] @ c.T
        best = s.argmax(axis=1)
        high = s >= s[np.arange(len(s)), best][:, None] - 1e-9
        for i in np.flatnonzero(high.sum(axis=1) > 1).tolist():
            v = x[at + i] / np.abs(x[at + i]).max()
            best[i] = max(np.flatnonzero(high[i]).tolist(), key=lambda j: (math.fsum(v * c[j]), -j))
        home[at:at + rows] = best
    return home


def fit_turn(x: np.ndarray, threshold: float) -> np.ndarray:
    """Orthonormal columns, of greatest spread first: as many as make the bound on the cosine rule out nearly all pairs below the threshold."""
    turn = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    x = x[::max(1, len(x) // TRIED)][:TRIED]
    below, m = x @ x.T < threshold, 8
    while m + 1 < x.shape[1]:
        y = shortened(x, turn[:, :m])
        if ((y @ y.T >= threshold) & below).mean() <= LET_THROUGH:
            break
        m += max(8, m // 4)
    return np.ascontiguousarray(turn[:, :m]) if m + 1 < x.shape[1] else turn


def shortened(x: np.ndarray, turn: np.ndarray) -> np.ndarray:
    """Coordinates of unit rows along ``turn`` and the length of what is left: their products are no less than the cosines."""
    z = x @ turn
    return np.column_stack([z, np.sqrt(np.maximum(1 - (z * z).sum(axis=1), 0))])


def lay_tiles(c: np.ndarray, weight: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(first tile, number of tiles) of each cell: neighbouring cells share a tile of about ``most`` at most, a heavier cell has several."""
    first, pieces = np.zeros(len(c), dtype=np.int64), np.ones(len(c), dtype=np.int64)
    tiles, left = 0, [np.arange(len(c))]
    while left:
        g = left.pop()
        w = weight[g]
        if len(g) > 1 and w.sum() > most:
            apart = c[g] - c[g].mean(axis=0)
            axis = apart[np.argmax((apart * apart).sum(axis=1))]
            for _ in range(8):
                axis = apart.T @ (apart @ axis)
                axis = axis / max(np.linalg.norm(axis), 1e-300)
            order = np.argsort(apart @ axis, kind="stable")
            cut = int(np.clip(np.searchsorted(np.cumsum(w[order]), w.sum() / 2), 1, len(g) - 1))
            left += [g[order[cut:]], g[order[:cut]]]
            continue
        first[g], pieces[g] = tiles, max(1, math.ceil(w.sum() / most))
        tiles += int(pieces[g[0]])
    return first, pieces


def unit(x: np.ndarray) -> np.ndarray:
    """Unit rows in double precision."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of a list array of equal lengths."""
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(len(vectors), -1)


def _packed(x: np.ndarray) -> pa.Array:
    """A binary value for each row."""
    wide = x.shape[1] * x.dtype.itemsize
    return pa.Array.from_buffers(pa.binary(), len(x), [None, pa.py_buffer(np.arange(0, len(x) * wide + 1, wide, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(x))])


def _one_each(ka: np.ndarray, kb: np.ndarray, ids: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(a row of each key, its least id, its count)."""
    order = np.lexsort((kb, ka))
    new = np.append(True, (np.diff(ka[order]) != 0) | (np.diff(kb[order]) != 0))
    at = np.flatnonzero(new)
    return order[at], np.minimum.reduceat(ids[order], at), np.add.reduceat(n[order], at)


DEALT = pa.schema([("tile", pa.int64()), ("cell", pa.int32()), ("id", pa.int64()), ("n", pa.int64()), ("ka", pa.int64()), ("kb", pa.int64()), ("vec", pa.binary())])


def _deal(layout):
    """Vectors (id, ka, kb, vec) to their tiles; rows of a batch with equal vectors become one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c, first, pieces, _ = layout.value
        for b in batches:
            if not len(b):
                continue
            ids, ka, kb = (b.column(i).to_numpy() for i in range(3))
            rows, ids, n = _one_each(ka, kb, ids, np.ones(len(b), dtype=np.int64))
            x, ka, kb = _matrix(b.column(3))[rows], ka[rows], kb[rows]
            cell = nearest(unit(x), c)
            yield pa.RecordBatch.from_arrays([pa.array(first[cell] + ka % pieces[cell]), *map(pa.array, (cell, ids, n, ka, kb)), _packed(x)], schema=DEALT)

    return run


TILES = pa.schema([("tile", pa.int64()), ("cells", pa.binary()), ("ids", pa.binary()), ("ns", pa.binary()), ("vecs", pa.binary()),
                   ("center", pa.list_(pa.float64())), ("radius", pa.float64())])


def _pack(kind: str):
    """A tile's vectors, ordered by cell, as one row with the ball that holds them."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        t = table.combine_chunks()
        rows, ids, n = _one_each(*(t[c].to_numpy() for c in ("ka", "kb", "id", "n")))
        cells = t["cell"].to_numpy()[rows]
        order = np.argsort(cells, kind="stable")
        x = np.frombuffer(b"".join(t["vec"].take(pa.array(rows[order])).to_pylist()), dtype=kind).reshape(len(rows), -1)
        u = unit(x)
        center = u.mean(axis=0)
        center = center / norm if (norm := np.linalg.norm(center)) > 1e-9 else u[0]
        radius = math.acos(max(-1.0, min(1.0, float((u @ center).min()))))
        return pa.Table.from_pylist([{"tile": key[0].as_py(), "cells": cells[order].astype("<i4").tobytes(), "ids": ids[order].astype("<i8").tobytes(),
                                      "ns": n[order].astype("<i8").tobytes(), "vecs": x.tobytes(), "center": center.tolist(), "radius": radius}], schema=TILES)

    return run


class Forest:
    """Spanning forest of links between rows; rows with one id are one node."""

    def __init__(self, ids: np.ndarray):
        self.ids, self.node = np.unique(ids, return_inverse=True)
        self.root = np.arange(len(self.ids))
        self.links: list[tuple[int, int]] = []

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Adds links; in each round every open tree takes one, so few are walked through."""
        u, v = self.node[a], self.node[b]
        while True:
            p, q = self.root[u], self.root[v]
            still = p != q
            if not still.any():
                return
            u, v, p, q = u[still], v[still], p[still], q[still]
            for i in np.unique(p, return_index=True)[1].tolist():
                x, y = int(p[i]), int(q[i])
                while self.root[x] != x:
                    x = int(self.root[x])
                while self.root[y] != y:
                    y = int(self.root[y])
                if x != y:
                    self.root[max(x, y)] = min(x, y)
                    self.links.append((int(self.ids[u[i]]), int(self.ids[v[i]])))
            while not np.array_equal(flat := self.root[self.root], self.root):
                self.root = flat


class Tile:
    """An unpacked tile: its vectors in both precisions, and where each cell's begin."""

    def __init__(self, cells: bytes, ids: bytes, ns: bytes, vecs: bytes, kind: str, c: np.ndarray, turn: np.ndarray):
        own, self.ids, self.n = np.frombuffer(cells, "<i4"), np.frombuffer(ids, "<i8").copy(), np.frombuffer(ns, "<i8").copy()
        self.x = unit(np.frombuffer(vecs, kind).reshape(len(own), -1))
        self.narrow, self.short = self.x.astype(np.float32), shortened(self.x, turn).astype(np.float32)
        self.cells, self.starts, self.of = np.unique(own, return_index=True, return_inverse=True)
        self.ends = np.append(self.starts[1:], len(own))
        self.c = c[self.cells]
        self.high = np.einsum("ij,ij->i", self.x, self.c[self.of])
        self.bytes = self.x.nbytes + self.narrow.nbytes + self.short.nbytes


class Meeting:
    """Links between the vectors of two tiles, or within one."""

    def __init__(self, a: Tile, b: Tile, threshold: float, reach: float):
        self.a, self.b, self.threshold, self.most = a, b, threshold, 2 * reach + 1e-6
        self.off = (a.x.shape[1] + 4) * 1.2e-7  # more than single precision is off by
        self.to_a, self.to_b, self.forest = np.zeros(len(a.ids)), np.zeros(len(b.ids)), None

    def margins(self, t: Tile, others: np.ndarray) -> np.ndarray:
        """[cell of ``others``, row]: distance from the border with that cell."""
        gap = np.sqrt(((t.c[:, None, :] - others[None]) ** 2).sum(axis=2))
        far = t.high[:, None] - t.x @ others.T
        wide = gap[t.of]
        return np.ascontiguousarray(np.where(wide < ONE_PLACE, 0.0, far / np.maximum(wide, ONE_PLACE)).T)

    def run(self) -> None:
        a, b = self.a, self.b
        m_a = self.margins(a, b.c)
        m_b = self.margins(b, a.c)
        low_a = np.minimum.reduceat(m_a, a.starts, axis=1).T
        low_b = np.minimum.reduceat(m_b, b.starts, axis=1)
        space = np.empty(STRIP * int((b.ends - b.starts).max()), dtype=np.float32)
        for i, j in np.argwhere(low_a + low_b <= self.most).tolist():
            s, t = slice(a.starts[i], a.ends[i]), slice(b.starts[j], b.ends[j])
            if a is b and i >= j:
                if i == j:
                    self.within(np.arange(a.starts[i], a.ends[i]))
                continue
            near_a, near_b = m_a[j, s], m_b[i, t]
            rows = np.flatnonzero(near_a <= self.most - low_b[i, j])
            cols = np.flatnonzero(near_b <= self.most - low_a[i, j])
            rows, cols = rows[np.argsort(near_a[rows])], cols[np.argsort(near_b[cols])]
            near_a, near_b = near_a[rows], near_b[cols]
            rows, cols = rows + a.starts[i], cols + b.starts[j]
            x, y = a.short[rows], b.short[cols].T
            for at in range(0, len(rows), STRIP):
                upto = int(np.searchsorted(near_b, self.most - near_a[at], side="right"))
                if not upto:
                    break
                some = x[at:at + STRIP]
                self.bounded(rows[at:at + STRIP], cols[:upto], np.matmul(some, y[:, :upto], out=space[:len(some) * upto].reshape(len(some), upto)))

    def within(self, rows: np.ndarray) -> None:
        for at in range(0, len(rows), STRIP):
            self.links(rows[at:at + STRIP], rows[at:], corner=True)

    def bounded(self, rows: np.ndarray, cols: np.ndarray, bound: np.ndarray) -> None:
        """Links of rows of ``a`` with rows of ``b``, given bounds of their cosines."""
        least = self.threshold - self.off - 1e-6
        r = np.flatnonzero(bound.max(axis=1) >= least)
        if len(r):
            self.links(rows[r], cols[bound[r].max(axis=0) >= least])

    def links(self, rows: np.ndarray, cols: np.ndarray, corner: bool = False) -> None:
        """Links of rows of ``a`` with rows of ``b``; ``corner``: each pair of the rows counts once."""
        g = self.a.narrow[rows] @ self.b.narrow[cols].T
        r, c = np.nonzero(g >= self.threshold - self.off)
        if corner:
            upper = c > r
            r, c = r[upper], c[upper]
        if not len(r):
            return
        s, r, c = g[r, c], rows[r], cols[c]
        ok = self.a.ids[r] != self.b.ids[c]
        unsure = np.flatnonzero(ok & (s < self.threshold + self.off))
        for k in range(0, len(unsure), PAIRS):
            u = unsure[k:k + PAIRS]
            ok[u] = np.einsum("ij,ij->i", self.a.x[r[u]], self.b.x[c[u]]) >= self.threshold
        r, c = r[ok], c[ok]
        if not len(r):
            return
        self.to_a += np.bincount(r, self.b.n[c], len(self.to_a))
        self.to_b += np.bincount(c, self.a.n[r], len(self.to_b))
        if self.forest is None:
            self.forest = Forest(np.concatenate([self.a.ids, self.b.ids]))
        self.forest.join(r, c + len(self.a.ids))


LINKS = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("n", pa.int64())])


class Found:
    """Link sums and links of a task's meetings, summed up as they grow."""

    def __init__(self):
        self.ids, self.n, self.links = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), []
        self.more: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, m: Meeting) -> None:
        if m.forest is None:
            return
        for t, by in ((m.a, m.to_a), (m.b, m.to_b)):
            some = np.flatnonzero(by)
            self.more.append((t.ids[some], by[some].astype(np.int64)))
            self.size += len(some)
        self.links += m.forest.links
        self.size += len(m.forest.links)
        if self.size > GATHERED:
            self.sum_up()

    def sum_up(self) -> None:
        every = np.concatenate([self.ids, *(i for i, _ in self.more)])
        n = np.concatenate([self.n, *(k for _, k in self.more)])
        self.ids, at = np.unique(every, return_inverse=True)
        self.n, self.more, self.size = np.zeros(len(self.ids), dtype=np.int64), [], 0
        np.add.at(self.n, at, n)
        if self.links:
            ends = np.array(self.links, dtype=np.int64)
            forest = Forest(ends.T.reshape(-1))
            forest.join(np.arange(len(ends)), np.arange(len(ends), 2 * len(ends)))
            self.links = forest.links

    def batch(self) -> pa.RecordBatch:
        self.sum_up()
        ends = np.array(self.links, dtype=np.int64).reshape(-1, 2)
        none = [pa.nulls(k, pa.int64()) for k in (len(self.ids), len(ends))]
        return pa.RecordBatch.from_arrays([pa.array(np.append(self.ids, ends[:, 0])), pa.concat_arrays([none[0], pa.array(ends[:, 1])]),
                                           pa.concat_arrays([pa.array(self.n), none[1]])], schema=LINKS)


def _meet(layout, kind: str, threshold: float, reach: float):
    """Rows of two tiles, five columns each, to the links of all of the task's."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (c, _, _, turn), found = layout.value, Found()
        known: OrderedDict[int, Tile] = OrderedDict()

        def tile(b: pa.RecordBatch, i: int, at: int) -> Tile:
            k = b.column(at)[i].as_py()
            if k not in known:
                known[k] = Tile(*(b.column(at + j)[i].as_buffer() for j in range(1, 5)), kind, c, turn)
                while len(known) > 2 and sum(t.bytes for t in known.values()) > REMEMBERED:
                    known.popitem(last=False)
            known.move_to_end(k)
            return known[k]

        for b in batches:
            for i in range(len(b)):
                m = Meeting(tile(b, i, 0), tile(b, i, 5), threshold, reach)
                m.run()
                found.add(m)
        yield found.batch()

    return run


def _sample(v: DataFrame, n_vectors: int, want: int) -> np.ndarray:
    """About ``want`` of the distinct vectors, those whose hash is low."""
    low = F.pmod(F.col("kb"), F.lit(1 << 40)) < int((1 << 40) * min(1.0, want / n_vectors))
    t = v.filter(low).groupBy("ka", "kb").agg(F.first("vec").alias("vec")).toArrow().sort_by([("ka", "ascending"), ("kb", "ascending")])
    return _matrix(t["vec"].combine_chunks())


def _one_length(v: DataFrame, length: int, n_vectors: int, threshold: float, reach: float) -> DataFrame:
    """(u, v, n): link sums (v NULL) and links (n NULL) of vectors (id, ka, kb, vec) of one length."""
    spark = v.sparkSession
    kind = "<f4" if v.schema["vec"].dataType.elementType.simpleString() == "float" else "<f8"
    v = v if kind == "<f4" else v.withColumn("vec", F.col("vec").cast("array<double>"))
    k = min(MOST_CELLS, max(4, math.ceil(CELLS * math.sqrt(n_vectors))))
    sample = unit(_sample(v, n_vectors, max(SAMPLE, A_CELL * k)))
    c = fit_centroids(sample, k)
    wide = length * int(kind[2])
    most = max(16, min(TILE_MOST, max(TILE_LEAST, int(TILE * math.sqrt(n_vectors))), TILE_BYTES // wide))
    weight = np.maximum(np.bincount(nearest(sample, c), minlength=len(c)), 1) * (n_vectors / len(sample))
    first, pieces = lay_tiles(c, weight, most)
    n_tiles = int((first + pieces).max())
    layout = spark.sparkContext.broadcast((c, first, pieces, fit_turn(sample, threshold)))
    dealt = v.select("id", "ka", "kb", "vec").mapInArrow(_deal(layout), "tile long, cell int, id long, n long, ka long, kb long, vec binary")
    stored, links = scratch_path(spark, "tiles"), scratch_path(spark, "links")
    dealt.repartition(n_tiles, "tile").groupBy("tile").applyInArrow(
        _pack(kind), "tile long, cells binary, ids binary, ns binary, vecs binary, center array<double>, radius double").write.parquet(stored)
    own = spark.newSession()  # for settings of the product alone
    for name, value in TWO_TILES.items():
        own.conf.set(name, value)
    tiles = own.read.parquet(stored)
    tasks = max(4 * spark.sparkContext.defaultParallelism, n_tiles * n_tiles // (2 * TASK_PAIRS))
    held = min(n_tiles, max(math.ceil(n_vectors * wide / SIDE_BYTES), math.ceil(math.sqrt(tasks))))
    cols = ["tile", "cells", "ids", "ns", "vecs"]
    a, b = (tiles.coalesce(parts).select(*(F.col(x).alias(f"{side}_{x}") for x in [*cols, "center", "radius"]))
            for side, parts in (("a", min(n_tiles, math.ceil(tasks / held))), ("b", held)))
    angle = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.aggregate(F.zip_with("a_center", "b_center", lambda x, y: x * y), F.lit(0.0), lambda x, y: x + y))))
    widest = 2 * math.asin(min(1.0, reach)) + 1e-4
    both = a.hint("shuffle_replicate_nl").join(b, (F.col("a_tile") <= F.col("b_tile")) & (angle <= F.col("a_radius") + F.col("b_radius") + widest))
    both.select(*(f"{side}_{x}" for side in "ab" for x in cols)).mapInArrow(_meet(layout, kind, threshold, reach), "u long, v long, n long").write.parquet(links)
    return spark.read.parquet(links)


def link_vectors(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", threshold: float = THRESHOLD,
                 reach: float | None = None) -> DataFrame:
    """Per vector row: (id, n_links, component_id).

    Links join vectors of equal length whose cosine is at least ``threshold``.
    Vectors that are NULL, empty, zero, or hold NULL or non-finite components
    link with nothing, and so do rows without id. Repeated rows are vectors of
    their own: they link with each other and count in ``n_links``. Other columns
    are not looked at. ``reach`` is half the distance up to which vectors are
    compared; with less than the default, links across cells are missed.
    """
    ship(vectors.sparkSession)
    reach = math.sqrt(2 - 2 * threshold) / 2 if reach is None else reach
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).alias("vec"))
    sound = (F.col("id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0)
             & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
             & F.exists("vec", lambda x: x != 0))
    v = v.select("id", F.when(F.coalesce(sound, F.lit(False)), F.col("vec")).alias("vec"))
    keys = [F.when(F.col("vec").isNotNull(), k).alias(c) for k, c in ((F.xxhash64("vec"), "ka"), (F.xxhash64(F.lit(1), F.col("vec")), "kb"))]
    v = v.select("id", "vec", *keys, F.when(F.col("vec").isNotNull(), F.size("vec")).alias("length"))
    rows = stage(v.select("id", "ka", "kb", "length"), "vector-rows")
    distinct = stage(rows.filter("length is not null").groupBy("ka", "kb", "length").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")), "distinct-vectors")
    found = None
    for length, n in sorted((r[0], r[1]) for r in distinct.groupBy("length").count().collect()):
        part = _one_length(v.filter(F.col("length") == length), length, n, threshold, reach)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return rows.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    sums = found.filter("v is null").groupBy(F.col("u").alias("first")).agg(F.sum("n").alias("others"))
    comp = components(found.filter("v is not null").select("u", "v")).select(F.col("node").alias("first"), "component")
    # the others have no link, so what a row has without facts
    facts = (distinct.join(sums, "first", "left").join(comp, "first", "left").filter("n > 1 or others is not null or component is not null")
             .select("ka", "kb", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("component", "first").alias("component_id")))
    return rows.join(facts, ["ka", "kb"], "left").select(
        "id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("component_id", "id").alias("component_id"))


def op1_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's row per vector."""
    found = link_vectors(read_table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
