"""Near duplicates by improved consistent weighted sampling (ICWS).

1. Every document's words (lower-cased letters and digits) give shingles of
   ``SHINGLE`` words. Texts are stored in *packs* of some MB. A pack ships each of
   its distinct shingles once, with the number of its documents that have it, to
   the shingle's bucket; a bucket counts over all packs and gives each pack back
   the document frequencies of the shingles that several documents have. All
   other shingles have one document, so every frequency is exact.
2. A shingle weighs its count in the document times its inverse frequency. A
   document whose shared shingles have less than ``THRESHOLD`` of its weight is
   near nothing and goes no further: no similarity can exceed that share.
3. Documents with one text are one class from the start, and one of them goes on.
4. ``BANDS * ROWS`` consistent weighted samples are drawn per document; two
   documents agree in a sample with the probability of their weighted Jaccard
   similarity. Documents with equal samples in a band share a bucket.
5. In each bucket the members are compared with a pivot (the smallest id, then
   two drawn by a hash), never with each other, and links of at least
   ``THRESHOLD`` are kept. Buckets whose members are then one component are
   done. In the others the members of different components are compared in
   blocks, of which only the links come out; so no candidate is left unseen.
6. Classes are the connected components of the links.

A pair of similarity 0.8 shares a bucket with probability 0.9998 (one of 12
bands of 3 samples).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from regstar.llm import wordhash as wh
from regstar.llm.common import ship, stage, text_of
from regstar.llm.components import components
from regstar.session import scratch_path
from regstar.sources.tables import read_table

SHINGLE, THRESHOLD = 5, 0.8
BANDS, ROWS = 12, 3
#: Bytes of text in a pack, and for each bucket that shingles are counted in.
PACK_BYTES, BUCKET_BYTES = 8 << 20, 32 << 20
#: Compression of a pack: it is stored once and shuffled once.
LEVEL = 7
#: Bytes of text whose words are worked on at once: small enough to stay in a core's cache.
PIECE_BYTES = 1 << 18
#: Bytes of text on each side of the pairs that are compared at once.
PAIR_BYTES = 1 << 20
#: Pivots that a bucket's members are compared with before the blocked comparison.
PIVOTS = 3
#: Members of a bucket that one task compares with as many others.
BLOCK = 200


def _shingles(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle, count) of a string array, sorted; a text of fewer words has one shingle."""
    w = wh.words_of(text, wh.NOT_ALNUM, wh.LOWER)
    n = w.counts
    all_runs = wh.runs(w.hash, SHINGLE)
    doc = np.repeat(np.arange(len(n)), np.maximum(n - SHINGLE + 1, 0))
    begin = np.repeat(w.first[:-1], np.maximum(n - SHINGLE + 1, 0))
    place = np.arange(len(doc)) - np.repeat(np.cumsum(np.maximum(n - SHINGLE + 1, 0)) - np.maximum(n - SHINGLE + 1, 0), np.maximum(n - SHINGLE + 1, 0))
    h = all_runs[begin + place]
    short = np.flatnonzero((n > 0) & (n < SHINGLE))
    if len(short):
        own = np.array([wh.mix(wh.runs(w.hash[w.first[k]:w.first[k + 1]], int(n[k])) + np.uint64(n[k]))[0] for k in short], dtype=np.uint64)
        doc, h = np.concatenate([doc, short]), np.concatenate([h, own])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.append(True, (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])) if len(h) else np.zeros(0, dtype=bool)
    at = np.flatnonzero(new)
    return doc[at], h[at], np.diff(np.append(at, len(h)))


def _inverse(n: np.ndarray, documents: int) -> np.ndarray:
    """(1 + ln((documents + 1) / (n + 1)) / ln(documents + 2)) / 2 for shingles of n documents.

    From 1 for a shingle of one document down to 1/2 for one that all have, where
    plain inverse frequencies go down to 0: a passage weighs less the more
    documents share it, but the members of a large group of near copies still find
    each other by what they share. The price is contrast: a very common passage
    counts half, so two documents may be near by it alone if it is most of both.
    """
    return (0.5 + 0.5 * np.log((documents + 1.0) / (n + 1.0)) / np.log(documents + 2.0)).astype(np.float32)


PACK = pa.schema([("pack", pa.int64()), ("bytes", pa.int64()), ("rows", pa.int64()), ("blob", pa.binary())])
PACKS = "pack long, bytes long, rows long, blob binary"


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc, t) as compressed packs of about PACK_BYTES."""
    number, parts, size = TaskContext.get().partitionId() << 32, [], 0

    def out() -> pa.RecordBatch:
        table = pa.Table.from_batches(parts)
        sink = pa.BufferOutputStream()
        codec = pa.Codec("zstd", compression_level=LEVEL)
        with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression=codec)) as w:
            w.write_table(table.combine_chunks())
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(
            (number, size, len(table), sink.getvalue().to_pybytes()), PACK, strict=True)], schema=PACK)

    for big in batches:
        for b in wh.slices(big, 1):
            parts.append(b)
            size += pc.sum(pc.binary_length(b.column(1))).as_py() or 0
            if size >= PACK_BYTES:
                yield out()
                number, parts, size = number + 1, [], 0
    if parts:
        yield out()


def _unpack(blob: bytes) -> Iterator[pa.RecordBatch]:
    for b in pa.ipc.open_stream(pa.py_buffer(blob)):
        yield from wh.slices(b, 1, PIECE_BYTES)


def _squeeze(x: np.ndarray) -> bytes:
    """Whole numbers as compressed byte planes: those of high bytes, mostly zero, take no room."""
    return pa.compress(np.ascontiguousarray(x.astype(np.uint64).view(np.uint8).reshape(-1, 8).T).tobytes(), codec="zstd", asbytes=True)


def _spread(data: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(data, decompressed_size=8 * n, codec="zstd", asbytes=True), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view(np.uint64).reshape(-1)


def _pack_shingles(blob: bytes, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(shingles, documents of the pack that have each, where each bucket begins): sorted by bucket, then shingle."""
    h = np.concatenate([np.zeros(0, np.uint64), *[_shingles(b.column(1))[1] for b in _unpack(blob)]])
    h.sort()
    at = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
    h, n = h[at], np.diff(np.append(at, len(h)))
    del at
    bucket = (h % np.uint64(buckets)).astype(np.uint16 if buckets <= 1 << 16 else np.int64)
    order = np.argsort(bucket, kind="stable")
    return h[order], n[order], np.searchsorted(bucket[order], np.arange(buckets + 1))


SHIPPED = pa.schema([("bucket", pa.int64()), ("pack", pa.int64()), ("size", pa.int64()), ("h", pa.binary()), ("n", pa.binary())])


def _ship_shingles(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for pack, blob in zip(big.column(0).to_pylist(), big.column(1), strict=True):
                h, n, first = _pack_shingles(blob.as_py(), buckets)
                h //= np.uint64(buckets)  # in a bucket the quotients tell shingles apart, in fewer bits
                rows = [(k, pack, int(b - a), _squeeze(np.diff(h[a:b], prepend=np.uint64(0))), _squeeze(n[a:b]))
                        for k, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)) if a < b]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), SHIPPED, strict=True)], schema=SHIPPED)

    return run


RETURNED = pa.schema([("pack", pa.int64()), ("bucket", pa.int64()), ("size", pa.int64()), ("at", pa.binary()), ("n", pa.binary())])


def _count_bucket(table: pa.Table) -> pa.Table:
    """Adds up a bucket's shingles over all packs: per pack the places of those of several documents, and their numbers."""
    packs, sizes = table["pack"].to_pylist(), table["size"].to_pylist()
    h = np.concatenate([np.cumsum(_spread(x, k), dtype=np.uint64) for x, k in zip(table["h"].to_pylist(), sizes, strict=True)])
    n = np.concatenate([_spread(x, k) for x, k in zip(table["n"].to_pylist(), sizes, strict=True)])
    order = np.argsort(h, kind="stable")
    h = h[order]
    begin = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
    del h
    sums = np.add.reduceat(n[order], begin)
    total = n  # its numbers are summed up already
    total[order] = np.repeat(sums, np.diff(np.append(begin, len(n))))
    del order, begin, sums
    rows, upto = [], np.cumsum([0, *sizes])
    for k, pack in enumerate(packs):
        own = total[upto[k]:upto[k + 1]]
        at = np.flatnonzero(own > 1)
        if len(at):
            rows.append((pack, table["bucket"][0].as_py(), len(at), _squeeze(np.diff(at, prepend=0)), _squeeze(own[at])))
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), RETURNED, strict=True)], schema=RETURNED) \
        if rows else RETURNED.empty_table()


class Sampler:
    """Consistent weighted samples. A hash of (shingle, sample) picks r and c, both
    Gamma(2, 1), and beta, uniform, from tables of 65,536 quantiles each."""

    def __init__(self) -> None:
        rng = np.random.default_rng(20)
        u = (np.arange(65_536) + 0.5) / 65_536
        grid = np.linspace(1e-4, 30, 400_000)
        quantiles = np.interp(u, 1 - np.exp(-grid) * (1 + grid), grid)
        self.r = rng.permutation(quantiles).astype(np.float32)
        self.per_r = (1 / self.r).astype(np.float32)
        self.ln_c = np.log(rng.permutation(quantiles)).astype(np.float32)
        self.beta = u.astype(np.float32)
        self.factors = wh.randoms(41, BANDS * ROWS)
        self.joins = wh.randoms(43, BANDS * ROWS)

    def bands(self, h: np.ndarray, weight: np.ndarray, first: np.ndarray) -> np.ndarray:
        """A hash per document and band; document k has entries first[k] to first[k + 1], at least one."""
        counts = np.diff(first)
        ln_w = np.log(weight).astype(np.float32)
        owner = np.repeat(np.arange(len(counts)), counts)
        out = np.zeros((len(counts), BANDS), dtype=np.uint64)
        for k in range(BANDS * ROWS):
            y = h * self.factors[k]
            y ^= y >> np.uint64(32)
            y *= np.uint64(0xD6E8FEB86659FD93)
            y ^= y >> np.uint64(29)
            lane = y.view(np.uint16).reshape(-1, 4)
            r, beta = self.r[lane[:, 0]], self.beta[lane[:, 2]]
            t = np.floor(ln_w * self.per_r[lane[:, 0]] + beta)
            ln_a = self.ln_c[lane[:, 1]] - r * (t - beta + np.float32(1))
            least = np.minimum.reduceat(ln_a, first[:-1])
            hit = np.flatnonzero(ln_a == np.repeat(least, counts))
            at = hit[np.append(True, owner[hit[1:]] != owner[hit[:-1]])]
            sample = wh.mix(h[at] + t[at].astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            out[:, k // ROWS] += sample * self.joins[k]
        return wh.mix(out + np.arange(BANDS, dtype=np.uint64)[None])


#: A document as it is compared: its compressed text, and the document frequency of each of its shingles in order.
BODY = pa.struct([("z", pa.binary()), ("bytes", pa.int64()), ("df", pa.binary()), ("n", pa.int64())])
SIGNED = pa.schema([("doc", pa.int64()), ("ta", pa.int64()), ("body", BODY), ("bands", pa.list_(pa.int64()))])
SIGNEDS = "doc long, ta long, body struct<z:binary,bytes:long,df:binary,n:long>, bands array<long>"


def _sign(documents: int, buckets: int):
    """Packs (blob, found) to the documents that may be near others, with their bands."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler = Sampler()
        for big in batches:
            for blob, found in zip(big.column(0), big.column(1), strict=True):
                if not found.is_valid:
                    continue  # no shingle of the pack is shared
                blob = blob.as_py()
                h, _, begin = _pack_shingles(blob, buckets)
                at, n = [], []
                for f in found.as_py():
                    at.append(np.cumsum(_spread(f["at"], f["size"])).astype(np.int64) + begin[f["bucket"]])
                    n.append(_spread(f["n"], f["size"]).astype(np.int64))
                at, n = np.concatenate(at), np.concatenate(n)
                order = np.argsort(h[at])
                known, count = h[at][order], n[order]
                del h, begin, at, n, order
                for piece in _unpack(blob):
                    yield from _sign_slice(piece, known, count, documents, sampler)

    return run


def _sign_slice(b: pa.RecordBatch, known: np.ndarray, count: np.ndarray, documents: int, sampler: Sampler) -> Iterator[pa.RecordBatch]:
    doc, h, n = _shingles(b.column(1))
    if not len(doc):
        return
    place = np.minimum(np.searchsorted(known, h), len(known) - 1)
    shared = known[place] == h
    df = np.where(shared, count[place], 1)
    weight = n * _inverse(df, documents)
    every = np.bincount(doc, weight, len(b))
    some = np.bincount(doc, weight * shared, len(b)) >= (THRESHOLD - 1e-6) * every
    some &= (every > 0) & b.column(0).is_valid().to_numpy(zero_copy_only=False)
    if not some.any():
        return
    own = some[doc]
    doc, h, weight, df = doc[own], h[own], weight[own], df[own]
    kept = np.flatnonzero(some)
    first = np.append(np.searchsorted(doc, kept), len(doc))
    flat = pa.array(sampler.bands(h, weight, first).reshape(-1).view(np.int64))
    lists = pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, BANDS, dtype=np.int32), flat)
    rows = pa.array(kept)
    bodies = []
    for text, at, end in zip(b.column(1).take(rows).to_pylist(), first[:-1], first[1:], strict=True):
        raw = text.encode()
        bodies.append((pa.compress(raw, codec="zstd", asbytes=True), len(raw), _squeeze(df[at:end]), int(end - at)))
    body = pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*bodies, strict=True), BODY, strict=True)], fields=list(BODY))
    yield pa.RecordBatch.from_arrays([b.column(0).take(rows), b.column(2).take(rows), body, lists], schema=SIGNED)


def sign_documents(base: DataFrame) -> tuple[DataFrame, int]:
    """(doc, ta, body, bands) of the rows (doc, t) that may be near others, and the number of rows; ``ta`` is a hash of the text."""
    spark = base.sparkSession
    packs = scratch_path(spark, "packs")
    base.select("doc", "t", F.xxhash64("t").alias("ta")).mapInArrow(_pack, PACKS).write.option("compression", "uncompressed").parquet(packs)
    packs = spark.read.schema(PACKS).parquet(packs)
    size = packs.agg(F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()
    buckets = max(1, math.ceil(size.bytes / BUCKET_BYTES))
    shipped = packs.select("pack", "blob").mapInArrow(_ship_shingles(buckets), "bucket long, pack long, size long, h binary, n binary")
    found = stage(shipped.groupBy("bucket").applyInArrow(_count_bucket, "pack long, bucket long, size long, at binary, n binary"), "frequencies")
    per_pack = found.groupBy("pack").agg(F.collect_list(F.struct("bucket", "size", "at", "n")).alias("found"))
    signed = packs.select("pack", "blob").join(per_pack, "pack").select("blob", "found").mapInArrow(_sign(size.rows, buckets), SIGNEDS)
    path = scratch_path(spark, "signed")
    signed.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(SIGNEDS).parquet(path), size.rows


def _slices(body: pa.StructArray, most: int = PAIR_BYTES) -> Iterator[slice]:
    """Parts of an array of bodies with about ``most`` bytes of text; at least a row each."""
    upto, at = np.cumsum(body.field("bytes").to_numpy()), 0
    while at < len(body):
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + most, side="right")))
        yield slice(at, end)
        at = end


class Weighted:
    """Bodies as weighted shingles, for exact similarities."""

    def __init__(self, bodies: list[dict], documents: int):
        texts = pa.array([pa.decompress(x["z"], decompressed_size=x["bytes"], codec="zstd", asbytes=True) for x in bodies], pa.binary())
        self.doc, self.h, n = _shingles(texts.cast(pa.string()))
        self.first = np.searchsorted(self.doc, np.arange(len(texts) + 1))
        df = np.concatenate([np.zeros(0, np.uint64), *[_spread(x["df"], x["n"]) for x in bodies]]).astype(np.int64)
        self.weight = (n * _inverse(df, documents)).astype(np.float64)
        total = np.append(0.0, np.cumsum(self.weight))
        self.total = total[self.first[1:]] - total[self.first[:-1]]

    def similarity(self, i: int, j: int) -> float:
        """Weighted Jaccard similarity: sum of the lesser weights over sum of the greater."""
        a, b = slice(self.first[i], self.first[i + 1]), slice(self.first[j], self.first[j + 1])
        least, most = sorted((self.total[i], self.total[j]))
        if not most or least < THRESHOLD * most - 1e-6:
            return 0.0  # can't reach the threshold
        _, x, y = np.intersect1d(self.h[a], self.h[b], assume_unique=True, return_indices=True)
        both = float(np.minimum(self.weight[a][x], self.weight[b][y]).sum())
        return both / (least + most - both)


def _verify(documents: int):
    """Of (a, body a, b, body b) the pairs (a, b) that are similar enough."""
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, of_a, c, of_c = b.columns
            for cut in _slices(of_a):
                n = cut.stop - cut.start
                x = Weighted(of_a[cut].to_pylist() + of_c[cut].to_pylist(), documents)
                ok = np.array([x.similarity(i, n + i) >= THRESHOLD for i in range(n)])
                yield pa.RecordBatch.from_arrays([pa.array(a[cut].to_numpy()[ok]), pa.array(c[cut].to_numpy()[ok])], schema=schema)

    return run


def _compare_block(documents: int):
    """Links between the two blocks of a bucket (or within one) across components."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        i, j = key[1].as_py(), key[2].as_py()
        b = table.combine_chunks().to_batches()[0]
        x = Weighted(b.column("body").to_pylist(), documents)
        comp, blk, doc = (b.column(c).to_numpy() for c in ("component", "blk", "doc"))
        out = []
        for p in np.flatnonzero(blk == i):
            for q in np.flatnonzero((blk == j) & (comp != comp[p])):
                if (i != j or p < q) and x.similarity(p, q) >= THRESHOLD:
                    out.append((doc[p], doc[q]))
        return pa.table({"u": pa.array([u for u, _ in out], pa.int64()), "v": pa.array([v for _, v in out], pa.int64())})

    return run


def _labelled(buckets: DataFrame, links: DataFrame) -> DataFrame:
    """Members with their components, of buckets that have more than one."""
    comp = components(links).select(F.col("node").alias("doc"), "component")
    m = buckets.join(comp, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    m = stage(m, "labelled")
    open_ = m.groupBy("bucket").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count(F.lit(1)).alias("n"))
    return m.join(open_.filter("lo <> hi").select("bucket", "n"), "bucket")


def find_links(signed: DataFrame, documents: int) -> DataFrame:
    """Links (u, v) between documents (doc, body, bands) of different texts, enough to join each component."""
    spark = signed.sparkSession
    every = stage(signed.select("doc", F.posexplode("bands").alias("band", "value")).select(
        F.xxhash64("band", "value").alias("bucket"), "doc"), "bands")
    full = every.groupBy("bucket").agg(F.min("doc").alias("lo"), F.max("doc").alias("hi")).filter("lo <> hi").select("bucket")
    buckets = stage(every.join(full, "bucket").distinct(), "buckets")
    active = stage(signed.select("doc", "body").join(buckets.select("doc").distinct(), "doc", "left_semi"), "candidate-texts")
    other = active.select(F.col("doc").alias("b"), F.col("body").alias("body_b"))

    def compare(pairs: DataFrame, name: str) -> DataFrame:
        """Verified ones of the pairs (doc, b)."""
        both = active.join(pairs, "doc").join(other, "b").select("doc", "body", "b", "body_b")
        return stage(both.mapInArrow(_verify(documents), "u long, v long"), name)

    links = spark.createDataFrame([], "u long, v long")
    for turn in range(PIVOTS):
        if turn == 0:
            open_ = buckets.withColumn("component", F.col("doc"))
            order = F.struct("doc", "component")
        else:
            open_ = _labelled(buckets, links)
            order = F.struct(F.xxhash64("doc", F.lit(turn)).alias("o"), "doc", "component")
        pivot = open_.groupBy("bucket").agg(F.min(order).alias("p")).select(
            "bucket", F.col("p.doc").alias("b"), F.col("p.component").alias("other"))
        pairs = open_.join(pivot, "bucket").filter("component <> other").select("doc", "b").distinct()
        links = stage(links.unionByName(compare(pairs, "verified")), "links-so-far")
    left = _labelled(buckets, links).select("bucket", "doc", "component", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks"))
    left = left.withColumn("blk", F.pmod(F.xxhash64("doc"), F.col("blocks").cast("long")).cast("int"))
    turns = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1),
                        lambda k: F.struct(F.least(k, F.col("blk")).alias("i"), F.greatest(k, F.col("blk")).alias("j")))
    rest = (left.select("bucket", "doc", "component", "blk", F.explode(turns).alias("turn")).select("*", "turn.i", "turn.j")
            .drop("turn").join(active, "doc").groupBy("bucket", "i", "j")
            .applyInArrow(_compare_block(documents), "u long, v long"))
    return links.unionByName(rest).distinct()


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc, class_id) for every id: class_id is the smallest id of its class.

    A row is a document; rows with one id count as one document, which is near
    whatever one of its texts is near. Rows without id are in no class (pass
    them on as they are). Texts without words are near nothing, not even each
    other; texts of fewer than five words are one shingle. Other columns are not
    looked at.
    """
    ship(docs.sparkSession)
    base = docs.select(F.col(id_col).cast("long").alias("doc"), text_of(text_col).alias("t"))
    known = base.filter(F.col("doc").isNotNull())
    marked = known.select("doc", F.xxhash64("t").alias("ta"), F.xxhash64(F.lit(1), F.col("t")).alias("tb"),
                          F.col("t").rlike("[0-9A-Za-z\\x{80}-\\x{10FFFF}]").alias("worded"))
    marked = stage(marked, "text-hashes")
    firsts = marked.filter("worded").groupBy("ta", "tb").agg(F.min("doc").alias("first"), F.count(F.lit(1)).alias("n"))
    copies = stage(marked.filter("worded").join(firsts.filter("n > 1"), ["ta", "tb"]).select(F.col("doc").alias("u"), F.col("first").alias("v"), "ta"), "copies")
    signed, documents = sign_documents(base)
    later = copies.filter("u <> v").select(F.col("u").alias("doc"), "ta")
    stands = signed.join(later, ["doc", "ta"], "left_anti").drop("ta")
    links = find_links(stands, documents).unionByName(copies.drop("ta"))
    comp = components(links)
    ids = marked.select("doc").distinct()
    return ids.join(comp.withColumnRenamed("node", "doc"), "doc", "left").select(
        "doc", F.coalesce("component", "doc").alias("class_id"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document its class and whether it is the one that stays."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    c = near_duplicate_classes(docs)
    return c.select(F.col("doc").alias("doc_id"), "class_id", (F.col("doc") == F.col("class_id")).alias("kept"))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """The documents that stand for their class, and those without id; all columns stay."""
    gone = near_duplicate_classes(docs).filter("doc <> class_id").select(F.col("doc").alias("doc_id"))
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
