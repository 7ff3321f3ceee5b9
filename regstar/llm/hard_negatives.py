"""Hard negatives from vectors, by best-first search of STR-packed R-trees.

Components are rounded down to integers, so every score is an exact integer.
Anchors are a stated share of the rows. For each anchor the job finds the best
rows of its label (positives), then for each positive the best rows of other
labels within a window below the positive's score.

1. Rows are dealt to shards: tiles cut on the coordinates of greatest spread
   (cut points from a bounded sample), a tile of more than ``SHARD_ROWS`` rows
   in as many pieces as it needs, also if all its vectors are equal.
2. Blocks of anchors meet every shard of their vectors' length. A shard is
   packed by sort-tile-recursive: sorted by a coordinate and cut into
   ceil(P^(1/k)) slabs for P leaves and k coordinates left, each slab likewise by
   the next one. Upper levels take ``FANOUT`` boxes in that order.
3. A box gives each coordinate an interval, hence the least and greatest inner
   product with an anchor. Boxes outside the anchor's score windows are left out
   from the root down. The leaves left are an anchor's queue, greatest possible
   score first, read in rounds of 1, 2, 4, ... boxes; it ends at a box strictly
   below the k-th best score so far of all of the anchor's windows.
4. The best of each shard are ranked by a window with a partial limit.

The search is exact: tiles and boxes only decide what is skipped. Random vectors
of many coordinates have wide boxes, so little is skipped there.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from regstar.llm.common import ship, stage
from regstar.sources.tables import read_table

SCALE = 256
ANCHOR_EVERY, POSITIVES, NEGATIVES = 50, 5, 3
#: A negative's score is from so many to so many hundredths of the positive's.
LOW, HIGH = 50, 95
#: Vectors that the cuts of the tiles are fitted on, at most, and the least of them in a tile.
SAMPLE, IN_A_TILE = 20_000, 16
SHARD_ROWS, ANCHOR_ROWS = 16_384, 4096
LEAF, FANOUT = 128, 16
#: Anchors that are searched for together.
TOGETHER = 1024
LOWEST = np.iinfo(np.int64).min


def str_pack(x: np.ndarray, leaf: int = LEAF) -> tuple[np.ndarray, np.ndarray]:
    """(order, first): the rows in leaf order and where each leaf begins."""
    coordinates = np.argsort(-x.astype(np.float64).std(axis=0), kind="stable") if len(x) else np.zeros(0, dtype=np.int64)
    leaves: list[np.ndarray] = []

    def tile(rows: np.ndarray, k: int) -> None:
        pages = math.ceil(len(rows) / leaf)
        if pages <= 1:
            leaves.append(rows)
            return
        if k < len(coordinates):
            rows = rows[np.argsort(x[rows, coordinates[k]], kind="stable")]
            slabs = math.ceil(pages ** (1 / (len(coordinates) - k)) - 1e-9)
        else:
            slabs = pages
        size = leaf * math.ceil(pages / slabs)
        for at in range(0, len(rows), size):
            tile(rows[at:at + size], k + 1)

    if len(x):
        tile(np.arange(len(x)), 0)
    if not leaves:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(leaves), np.cumsum([0, *[len(r) for r in leaves]])[:-1]


class RTree:
    """Boxes over rows in leaf order: ``levels`` from the leaves to the root, each (lo, hi) of its boxes."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF):
        self.order, self.first = str_pack(x, leaf)
        self.x = x[self.order]
        self.last = np.append(self.first, len(x))[1:]
        self.levels = []
        if len(x):
            lo, hi = np.minimum.reduceat(self.x, self.first, axis=0), np.maximum.reduceat(self.x, self.first, axis=0)
            self.levels.append((lo, hi))
            while len(lo) > 1:
                at = np.arange(0, len(lo), FANOUT)
                lo, hi = np.minimum.reduceat(lo, at, axis=0), np.maximum.reduceat(hi, at, axis=0)
                self.levels.append((lo, hi))

    def leaf_bounds(self, q: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        """Greatest inner product of each query with each leaf; LOWEST if the leaf, or a box
        above it, can't have one from ``least`` to ``most``."""
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        live, top = None, None
        for lo, hi in reversed(self.levels):
            top = up @ hi.T + down @ lo.T
            bottom = up @ lo.T + down @ hi.T
            here = (top >= least[:, None]) & (bottom <= most[:, None])
            live = here if live is None else here & np.repeat(live, FANOUT, axis=1)[:, :here.shape[1]]
        return np.where(live, top, LOWEST).astype(np.int64)


def best_first(tree: RTree, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, own: np.ndarray, label: np.ndarray,
               least: np.ndarray, most: np.ndarray, keep: int, same: bool) -> tuple[np.ndarray, ...]:
    """(anchor, window, row id, score) of the ``keep`` best rows of each anchor's windows.

    ``least`` and ``most`` are (anchors, windows), both inclusive; rows have the
    anchor's label or, without ``same``, another one, and never its id. ``ids``
    and ``labels`` are in the tree's order. Ties go to the smaller id.
    """
    m, windows = least.shape
    bound = tree.leaf_bounds(q, least.min(axis=1), most.max(axis=1))
    queue = np.argsort(~bound, axis=1, kind="stable")  # ~LOWEST is the greatest number, -LOWEST overflows
    kth, kth_id = np.full((m, windows), LOWEST), np.full((m, windows), np.iinfo(np.int64).max)
    best = tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    at, step = 0, 1
    while at < queue.shape[1]:
        leaves = queue[:, at:at + step]
        value = np.take_along_axis(bound, leaves, axis=1)
        needed = np.maximum(least, kth).min(axis=1)
        who, place = np.nonzero((value >= needed[:, None]) & (value > LOWEST))
        if not len(who):
            break
        leaf = leaves[who, place]
        order = np.argsort(leaf, kind="stable")
        who, leaf = who[order], leaf[order]
        numbers, begin = np.unique(leaf, return_index=True)
        found = [best]
        for number, a in zip(numbers.tolist(), np.split(who, begin[1:]), strict=True):
            rows = slice(int(tree.first[number]), int(tree.last[number]))
            score = (q[a] @ tree.x[rows].T).astype(np.int64)
            able = (labels[rows][None] == label[a][:, None]) == same
            able &= ids[rows][None] != own[a][:, None]
            for j in range(windows):
                ok = able & (score >= least[a, j][:, None]) & (score <= most[a, j][:, None])
                ok &= (score > kth[a, j][:, None]) | ((score == kth[a, j][:, None]) & (ids[rows][None] < kth_id[a, j][:, None]))
                r, c = np.nonzero(ok)
                found.append((a[r], np.full(len(r), j), ids[rows][c], score[r, c]))
        anchor, window, row, score = (np.concatenate(c) for c in zip(*found, strict=True))
        order = np.lexsort((row, ~score, window, anchor))  # ~score falls as score rises, without overflow
        anchor, window, row, score = anchor[order], window[order], row[order], score[order]
        group = anchor * windows + window
        rank = np.arange(len(group)) - np.searchsorted(group, group)
        full = np.flatnonzero(rank == keep - 1)
        kth[anchor[full], window[full]], kth_id[anchor[full], window[full]] = score[full], row[full]
        best = tuple(c[rank < keep] for c in (anchor, window, row, score))
        at, step = at + step, step * 2
    return best


def _matrix(lists: pa.ChunkedArray, rows: np.ndarray, length: int) -> np.ndarray:
    return lists.combine_chunks().flatten().to_numpy().reshape(-1, length)[rows]


FOUND = pa.schema([("aid", pa.int64()), ("place", pa.int32()), ("row", pa.int64()), ("score", pa.int64())])


def _search(length: int, keep: int, same: bool):
    """Best rows of a shard for a block of anchors, of their label (one window) or of others (a window per positive)."""
    def run(table: pa.Table) -> pa.Table:
        side = table["side"].to_numpy()
        data, anchors = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(data) or not len(anchors):
            return FOUND.empty_table()
        every_id, every_label = table["id"].to_numpy(), table["label"].to_numpy()
        x, q = _matrix(table["q"], data, length), _matrix(table["q"], anchors, length)
        ids, labels = every_id[data], every_label[data]
        if len(np.unique(ids)) < len(ids):  # equal rows are one row; they always meet in one shard
            rows = {(i, k, v.tobytes()): n for n, (i, k, v) in enumerate(zip(ids.tolist(), labels.tolist(), x, strict=True))}
            once = np.array(sorted(rows.values()))
            x, ids, labels = x[once], ids[once], labels[once]
        reach = length * max(1, int(np.abs(x.astype(np.int64)).max())) * max(1, int(np.abs(q.astype(np.int64)).max()))
        if reach >= 1 << 62:
            raise ValueError("an inner product may not fit a long")
        kind = np.float64 if reach < 1 << 53 else np.int64  # either way exact
        tree = RTree(x.astype(kind))
        ids, labels, q = ids[tree.order], labels[tree.order], q.astype(kind)
        aid, label, own = table["aid"].take(pa.array(anchors)).to_numpy(), every_label[anchors], every_id[anchors]
        if same:
            least = np.full((len(anchors), 1), LOWEST // 2)
            most = -least
        else:
            score = table["scores"].take(pa.array(anchors)).to_pylist()
            wide = max(len(s) for s in score)
            least = np.array([[-((-LOW * p) // 100) for p in s] + [1] * (wide - len(s)) for s in score], dtype=np.int64)
            most = np.array([[(HIGH * p) // 100 for p in s] + [0] * (wide - len(s)) for s in score], dtype=np.int64)
        parts = []
        for at in range(0, len(anchors), TOGETHER):
            cut = slice(at, at + TOGETHER)
            a, w, row, s = best_first(tree, ids, labels, q[cut], own[cut], label[cut], least[cut], most[cut], keep, same)
            parts.append((aid[cut][a], (w + 1).astype(np.int32), row, s))
        return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*parts, strict=True)], schema=FOUND)

    return run


def _tiles(sample: np.ndarray, depth: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """(coordinates, cuts): level k halves each tile of level k - 1 at cuts[k][tile] of coordinates[k]."""
    coordinates = np.argsort(-sample.astype(np.float64).std(axis=0), kind="stable")
    depth = min(depth, len(coordinates))
    tile, cuts = np.zeros(len(sample), dtype=np.int64), []
    for k in range(depth):
        value = sample[:, coordinates[k]]
        cuts.append(np.array([np.median(value[tile == t]) if (tile == t).any() else 0.0 for t in range(1 << k)]))
        tile = 2 * tile + (value > cuts[k][tile])
    return coordinates[:depth], cuts


def _deal(tiles, length: int):
    coordinates, cuts = tiles

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = b.column(2).flatten().to_numpy().reshape(-1, length)
            tile = np.zeros(len(b), dtype=np.int64)
            for c, cut in zip(coordinates, cuts, strict=True):
                tile = 2 * tile + (x[:, c] > cut[tile])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(tile.astype(np.int32))], names=["id", "label", "q", "tile"])

    return run


def _first(found: DataFrame, keys: list[str], n: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc("row"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n)


def _one_length(rows: DataFrame, length: int, n: int, anchor: Column, positives: int, negatives: int) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) among vectors of one length."""
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("q").toArrow()["q"]
    depth = min(math.ceil(math.log2(max(1, n / SHARD_ROWS))), int(math.log2(max(1, len(sample) // IN_A_TILE))))
    tiles = _tiles(_matrix(sample, np.arange(len(sample)), length), depth)
    placed = stage(rows.mapInArrow(_deal(tiles, length), "id long, label long, q array<int>, tile int"), "tiles")
    pieces = placed.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / SHARD_ROWS).cast("int").alias("pieces")).orderBy("tile").collect()  # at most SAMPLE / IN_A_TILE
    before = np.cumsum([0, *[r.pieces for r in pieces]])
    shards = int(before[-1])
    bases = rows.sparkSession.createDataFrame([(r.tile, r.pieces, int(b)) for r, b in zip(pieces, before, strict=False)], "tile int, pieces int, base int")
    anchors = stage(placed.filter(anchor).select("id", "label", "q").dropDuplicates().withColumn("aid", F.xxhash64("id", "label", "q")), "anchors")
    blocks = max(1, math.ceil(anchors.count() / ANCHOR_ROWS))
    none = F.lit(None)
    data = placed.join(F.broadcast(bases), "tile").select(
        (F.col("base") + F.pmod(F.xxhash64("id"), F.col("pieces").cast("long")).cast("int")).alias("shard"),
        F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(0).alias("side"), "id", "label", "q",
        none.cast("long").alias("aid"), none.cast("array<long>").alias("scores"))

    def search(queries: DataFrame, keep: int, same: bool) -> DataFrame:
        asked = queries.select(
            F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.pmod(F.col("aid"), F.lit(blocks)).cast("int").alias("block"),
            F.lit(1).alias("side"), "id", "label", "q", "aid", "scores")
        return data.unionByName(asked).groupBy("shard", "block").applyInArrow(
            _search(length, keep, same), "aid long, place int, row long, score long")

    best = _first(search(anchors.withColumn("scores", none.cast("array<long>")), positives, True), ["aid"], positives)
    best = stage(best.select("aid", F.col("rank").alias("place"), F.col("row").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    scores = best.groupBy("aid").agg(F.array_sort(F.collect_list(F.struct("place", "positive_score"))).alias("s"))  # at most ``positives`` an anchor
    queries = stage(anchors.join(scores, "aid").select("*", F.col("s.positive_score").alias("scores")).drop("s"), "windows")
    hard = _first(search(queries, negatives, False), ["aid", "place"], negatives)
    named = best.join(anchors.select("aid", F.col("id").alias("anchor_id")), "aid")
    return hard.join(named, ["aid", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("row").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))


def mine_hard_negatives(vectors: DataFrame, id_col: str = "vec_id", label_col: str = "label", vec_col: str = "embedding",
                        anchor_every: int = ANCHOR_EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES, scale: int = SCALE) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Rows without id, label or vector, with an empty vector, or with NULL or
    non-finite components take no part. Vectors meet those of equal length only. Equal rows
    are one row; rows that share an id and differ are rows of their own, but none
    is a positive or negative of its own id. An anchor without positives, or a
    positive without negatives in its window, has no rows; nor has an empty
    table. A component of 2^31 / scale or more fails. Other columns are not
    looked at.
    """
    spark = vectors.sparkSession
    ship(spark)
    v = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), F.col(vec_col).cast("array<double>").alias("vec"))
    v = v.filter(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.coalesce(F.size("vec"), F.lit(0)) > 0)
                 & F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))))
    whole = F.transform("vec", lambda x: F.when(F.abs(x) * scale < (1 << 31) - 1, F.floor(x * scale).cast("int"))
                        .otherwise(F.raise_error(F.lit("a component is too large")).cast("int")))
    rows = stage(v.select("id", "label", whole.alias("q")), "whole-vectors")
    anchor = F.col("id") % anchor_every == 0
    out = None
    for length, n in sorted((r[0], r[1]) for r in rows.groupBy(F.size("q")).count().collect()):  # one row a vector length
        part = _one_length(rows.filter(F.size("q") == length), length, n, anchor, positives, negatives)
        out = part if out is None else out.unionByName(part)
    return out if out is not None else spark.createDataFrame(
        [], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's rows: labels of ids divisible by 7 are first moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(read_table(spark, sf_dir, "embeddings").withColumn("label", moved))


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, v.vec_id, a.label = v.label AS same, CAST(list_inner_product(a.q, v.q) AS BIGINT) AS score
  FROM v AS a JOIN v ON a.vec_id <> v.vec_id AND len(a.q) = len(v.q) WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INT) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""
