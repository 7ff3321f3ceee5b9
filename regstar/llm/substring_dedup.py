"""Removal of word passages that repeat across documents, by level-wise doubling.

A passage is a window of ``window`` consecutive words. Windows are searched at
``window / 2^k`` words first; only what repeats there is extended to twice the
length, until the asked length is reached or nothing survives.

* Of the documents with one text the smallest stands for all; the others lose
  every word (if they have a window at all) and take no further part.
* At the first length n only a content-chosen subset is looked at: of any n + 1
  consecutive windows the one with the least hash. A repeated window of 2 n words
  has the same n + 1 windows wherever it stands, so its chosen one is looked at
  everywhere, and none is missed.
* A window of twice the length goes on if its chosen window occurs in more than
  one document; beyond that, if both its halves do. At the last length the
  smallest document of each window decides.

Counts are aggregates with a partial step and the rest are joins on a hash, so
a passage that a third of all documents share is one row per task before the
shuffle, and its rows are joined without one. Texts are shuffled only where they have
candidates: their ids are broadcast if they are few (checked), else joined.
Facts are joined back by document id and checked against the text's own hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from regstar.llm import wordhash as wh
from regstar.llm.common import is_small, ship, small_side, stage, text_of
from regstar.sources.tables import read_table

WINDOW = 50
#: Windows are halved down to no fewer words than this.
LEAST_WORDS = 25
#: Windows of more than one in so many rows are joined without a shuffle.
HOT = 200
#: Documents without id stand after all others, in the order of a hash of their text.
LAST = (1 << 63) - 1
WORD_END = r"[\x20\x09-\x0D]+"


def lengths(window: int) -> list[int]:
    """Lengths that are searched, each twice the one before."""
    out = [window]
    while out[0] % 2 == 0 and out[0] // 2 >= LEAST_WORDS:
        out.insert(0, out[0] // 2)
    return out


def _level_hashes(h: np.ndarray, window: int) -> np.ndarray:
    """Hashes of all runs of ``window`` words, built by doubling."""
    n, *more = lengths(window)
    out = wh.runs(h, n)
    for size in more:
        out, n = wh.doubled(out, n), size
    return out


def _second_hash(w: wh.Words, start: np.ndarray, n: int) -> np.ndarray:
    """An independent 32-bit hash of the runs that begin at some words."""
    weights = wh.randoms(37, n)
    total = np.zeros(len(start), dtype=np.uint64)
    own = wh.mix(w.hash ^ np.uint64(0x5851F42D4C957F2D))
    for k in range(n):
        total += own[start + k] * weights[k]
    return (wh.mix(total) >> np.uint64(32)).astype(np.uint32).view(np.int32)


def least_of(h: np.ndarray, span: int) -> np.ndarray:
    """For each ``span`` consecutive values the place of the least (the first of equals)."""
    if len(h) < span:
        return np.zeros(0, dtype=np.int64)
    views = np.lib.stride_tricks.sliding_window_view(h, span)
    step = 1 << 15
    return np.concatenate([views[k:k + step].argmin(axis=1) + np.arange(k, min(k + step, len(views))) for k in range(0, len(views), step)])


def _first_level(n: int, window: int):
    schema = pa.schema([("h", pa.int64()), ("doc", pa.int64()), ("at", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in wh.slices(big, 1):
                w = wh.words_of(b.column(1))
                doc = b.column(0).to_numpy()
                h = wh.runs(w.hash, n)
                places, texts = [], np.flatnonzero(w.counts >= window)
                for k in texts:
                    first, last = int(w.first[k]), int(w.first[k + 1])
                    # a window of `window` words holds window - n + 1 runs of n words
                    least = least_of(h[first:last - n + 1], window - n + 1)
                    places.append(first + least[np.append(True, least[1:] != least[:-1])])
                if places:
                    at = np.concatenate(places)
                    own = np.repeat(texts, [len(p) for p in places])
                    yield pa.RecordBatch.from_arrays([pa.array(h[at].view(np.int64)), pa.array(doc[own]),
                                                      pa.array((at - w.first[own]).astype(np.int32))], schema=schema)

    return run


def _next_level(n: int, size: int, first: bool):
    """Windows of ``size`` words from survivors of ``n`` words: those whose chosen run
    survived or, after the first level, whose two halves both did."""
    schema = pa.schema([("h", pa.int64()), ("check", pa.int32()), ("doc", pa.int64()), ("at", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in wh.slices(big, 1):
                doc, ats = b.column(0).to_numpy(), b.column(2)
                edge = ats.offsets.to_numpy()
                survived = ats.values.to_numpy()
                w = wh.words_of(b.column(1))
                low = wh.runs(w.hash, n) if first else None
                h = _level_hashes(w.hash, size)
                places, own = [], []
                for k in np.flatnonzero(w.counts >= size):
                    begin, count = int(w.first[k]), int(w.counts[k])
                    may = np.zeros(count + 1, dtype=bool)
                    at = survived[edge[k]:edge[k + 1]]
                    may[at[at < count]] = True
                    if first:
                        start = np.flatnonzero(may[least_of(low[begin:begin + count - n + 1], size - n + 1)])
                    else:
                        start = np.flatnonzero(may[:count - size + 1] & may[n:n + count - size + 1])
                    places.append(begin + start)
                    own.append(np.full(len(start), k))
                if places and sum(map(len, places)):
                    at, own_ = np.concatenate(places), np.concatenate(own)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(h[at].view(np.int64)), pa.array(_second_hash(w, at, size)), pa.array(doc[own_]),
                         pa.array((at - w.first[own_]).astype(np.int32))], schema=schema)

    return run


def _cut(window: int):
    """Words covered by the windows that are listed for a text go; the others are joined."""
    schema = pa.schema([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in wh.slices(big, 1):
                row, text, at = b.column(0), b.column(1), b.column(2)
                w = wh.words_of(text)
                h = _level_hashes(w.hash, window)
                edge, values = at.offsets.to_numpy(), at.values
                starts, wants = values.field("at").to_numpy().astype(np.int64), values.field("h").to_numpy().view(np.uint64)
                out = []
                for k in range(len(row)):
                    first, n = int(w.first[k]), int(w.counts[k])
                    start, want = starts[edge[k]:edge[k + 1]], wants[edge[k]:edge[k + 1]]
                    fits = start + window <= n
                    start, want = start[fits], want[fits]
                    start = start[h[first + start] == want]
                    turn = np.zeros(n + 1, dtype=np.int64)
                    np.add.at(turn, start, 1)
                    np.add.at(turn, start + window, -1)
                    gone = np.cumsum(turn)[:n] > 0
                    kept = b" ".join([w.data[s:e].tobytes() for s, e in zip(
                        w.start[first:first + n][~gone].tolist(), w.end[first:first + n][~gone].tolist(), strict=True)])
                    out.append((n, int(gone.sum()), kept.decode()))
                got = pa.StructArray.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], fields=list(schema))
                yield pa.RecordBatch.from_arrays([row, got], names=["row", "cut"])

    return run


CUT = "struct<n_words:bigint,n_removed:bigint,kept:string>"


def _with(docs: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """Documents that have facts, joined with them. Where the facts' keys are few,
    only those documents are shuffled."""
    ids = stage(facts.select(key), "ids")
    return (docs.join(F.broadcast(ids), key, "left_semi") if is_small(ids) else docs).join(facts, key)


def _shared(found: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of a staged table whose windows are in more than one document, with the smallest as ``lo``.

    A window of more than one in ``HOT`` rows (counted; fewer than ``HOT`` windows,
    whatever the data) is joined where its rows lie, so none goes to one task.
    """
    least = stage(found.groupBy(*keys).agg(F.min("doc").alias("lo"), F.max("doc").alias("hi"), F.count("*").alias("n"))
                  .filter("lo < hi").select(*keys, "lo", "n"), "least")
    is_hot = F.col("n") * HOT > found.count()
    hot = least.filter(is_hot).drop("n")
    cold = found.join(F.broadcast(hot.drop("lo")), keys, "left_anti").join(least.filter(~is_hot).drop("n"), keys)
    return found.join(F.broadcast(hot), keys).unionByName(cold)


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row as ``row`` with ``cut``: n_words, n_removed and kept (the words that
    stay, joined by a space).

    A word goes if it is in a window whose words also begin in a document with a
    smaller id; all windows are judged on the input. NULL texts have no words.
    Rows without id stand after all others, in the order of a hash of their text;
    rows with one id are never earlier than each other, and repeated rows get
    equal results. Extra columns of any name are carried in ``row``.
    """
    ship(docs.sparkSession)
    n, *more = lengths(window)
    if not more:
        raise ValueError(f"a window of {window} words can't be halved to {LEAST_WORDS} or more")
    base = docs.select(F.struct("*").alias("row"))
    text = text_of(F.col("row")[text_col])
    no_id = F.lit(LAST) - F.pmod(F.xxhash64(text), F.lit(1 << 40))
    base = base.select("row", F.coalesce(F.col("row")[id_col].cast("long"), no_id).alias("doc"))
    hashed = base.select("doc", F.xxhash64(text).alias("ta"), F.xxhash64(F.lit(1), text).alias("tb"))
    firsts = hashed.groupBy("ta", "tb").agg(F.min("doc").alias("first"), F.max("doc").alias("last")).filter("first < last")
    copies = small_side(stage(hashed.join(firsts, ["ta", "tb"]).filter("doc > first").select("doc", "ta").distinct(), "copies"))
    marked = base.withColumn("ta", F.xxhash64(text))
    stands = marked.join(copies, ["doc", "ta"], "left_anti").select("doc", "row")

    found = stage(stands.select("doc", text.alias("t")).mapInArrow(_first_level(n, more[0]), "h long, doc long, at int"), "level")
    keys = ["h"]
    for i, size in enumerate(more):
        per_doc = stage(_shared(found, keys).groupBy("doc").agg(F.collect_list("at").alias("ats")), "survivors")
        found = stage(_with(stands.select("doc", text.alias("t")), per_doc, "doc").select("doc", "t", "ats")
                      .mapInArrow(_next_level(n, size, i == 0), "h long, check int, doc long, at int"), "level")
        keys, n = ["h", "check"], size
    covered = _shared(found, keys).filter("lo < doc")
    covered = stage(covered.groupBy("doc").agg(F.collect_list(F.struct("at", "h")).alias("ats")), "covered")

    kind = base.schema["row"].dataType.simpleString()
    cut = _with(stands, covered, "doc").select("row", text.alias("t"), "ats").mapInArrow(_cut(window), f"row {kind}, cut {CUT}")
    # the others keep all their words, or none if an earlier document has their text
    rest = marked.join(copies.withColumn("copy", F.lit(True)), ["doc", "ta"], "left").join(
        small_side(stage(covered.select("doc").withColumn("cut_here", F.lit(True)), "cut-ids")), "doc", "left")
    words = F.array_remove(F.split(text, WORD_END, -1), "")
    copy = F.coalesce(F.col("copy"), F.lit(False))
    rest = rest.filter(copy | F.col("cut_here").isNull()).select("row", F.struct(words.alias("w"), copy.alias("copy")).alias("x"))
    count = F.size("x.w").cast("long")
    gone = F.col("x.copy") & (count >= window)
    whole = rest.select("row", F.struct(count.alias("n_words"), F.when(gone, count).otherwise(F.lit(0).cast("long")).alias("n_removed"),
                                        F.when(gone, "").otherwise(F.array_join("x.w", " ")).alias("kept")).alias("cut"))
    return cut.unionByName(whole)


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's row per document."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("row.doc_id", "cut.n_words", "cut.n_removed",
                                       F.sha2(F.col("cut.kept"), 256).alias("kept_sha256"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, s, md5(array_to_string(w[s : s + 49], ' ')) AS g
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS s FROM d WHERE len(w) >= 50)),
firsts AS (SELECT g, min(doc_id) AS lo FROM win GROUP BY g),
gone AS (
  SELECT DISTINCT doc_id, p
  FROM (SELECT doc_id, unnest(generate_series(s, s + 49)) AS p FROM win JOIN firsts USING (g) WHERE lo < doc_id)),
each_word AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS p FROM d),
kept AS (
  SELECT e.doc_id, count(*) AS n, count(gone.p) AS n_removed,
         string_agg(CASE WHEN gone.p IS NULL THEN e.x END, ' ' ORDER BY e.p) AS k
  FROM each_word e LEFT JOIN gone ON gone.doc_id = e.doc_id AND gone.p = e.p GROUP BY e.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
