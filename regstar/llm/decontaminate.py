"""Benchmark decontamination with a positional inverted index, in DataFrame operations only.

An item's *windows* are its runs of ``length`` consecutive words; an item of
fewer words (but not none) is one window. The job:

1. counts, over all documents, the words that occur in any window;
2. ranks each window's words by that count, words that no document has first,
   and takes the rarest as its anchors: ``SURE`` more than may be missing;
3. stores the postings (word, document, position) of the anchors;
4. finds as candidates the places at which at least ``SURE`` anchors stand within
   ``slop`` words of theirs;
5. joins the candidates to their documents and compares the whole window.

A window occurs *nearly* where most of its words (``NEAR`` of them) stand within
``slop`` words of their places. As many anchors as words may be missing, and
``SURE`` more, so step 4 leaves out no near or exact place, also if a window has
words that no document has. Where only exact places are asked for, nothing may
be missing and the ``RARE`` rarest words must stand at their very places.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from regstar.llm.common import row_key, small_side, stage, text_of
from regstar.sources.tables import read_table

WINDOW_WORDS = 10
SLOP = 2
#: Tenths of a window's words, rounded up, that are in a near place of it.
NEAR = 8
#: Anchors of a window where only exact places are asked for.
RARE = 3
#: Anchors of a window that must stand near their places before the documents are read.
SURE = 2
#: What stands between words: ASCII other than digits and lower-case letters.
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Lower-cased (A-Z only) words of a text, in order."""
    low = F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(low, BETWEEN_WORDS, -1), "")


def item_windows(items: DataFrame, length: int, id_col: str, text_col: str) -> DataFrame:
    """Distinct windows with the sorted ids of the items that have them: (wid, win, items)."""
    w = items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                     words(text_of(text_col)).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("w") - length, F.lit(0)))
    each = w.select("item", "w", F.explode(starts).alias("at")).select(
        "item", F.expr(f"slice(w, at + 1, {length})").alias("win"))
    return each.groupBy("win").agg(F.array_sort(F.collect_set("item")).alias("items")).select(
        F.xxhash64("win").alias("wid"), "win", "items")


def least_words(length: Column) -> Column:
    """Words of a window of some length that a near place has."""
    return F.ceil(length * NEAR / 10).cast("int")


def rare_words(windows: DataFrame, docs_words: DataFrame, near: bool) -> DataFrame:
    """Per window and anchor: (wid, rank, off, term, sure), ``sure`` being how many of its
    anchors every near (or exact) place has. Words that no document has rank first, as 0."""
    terms = windows.select("wid", F.size("win").alias("len"), F.posexplode("win").alias("off", "term"))
    vocabulary = small_side(stage(terms.select("term").distinct(), "vocabulary"))
    counts = (docs_words.select(F.explode("w").alias("term")).join(vocabulary, "term")
              .groupBy("term").agg(F.count(F.lit(1)).alias("n")))
    ranked = (terms.join(counts, "term", "left").groupBy("wid", "len")
              .agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "off", "term"))).alias("t")))
    missing = F.col("len") - least_words(F.col("len")) if near else F.lit(0)
    ranked = ranked if near else ranked.filter(F.col("t")[0]["n"] > 0)
    ranked = ranked.withColumn("k", F.least(missing + (SURE if near else RARE), F.col("len"))).withColumn("sure", F.col("k") - missing)
    return ranked.select("wid", "sure", F.posexplode(F.slice("t", F.lit(1), F.col("k"))).alias("rank", "a")).filter("a.n > 0").select(
        "wid", "rank", "a.off", "a.term", "sure")


def candidates(docs_words: DataFrame, windows: DataFrame, slop: int, near: bool) -> DataFrame:
    """(key, wid, start): places at which enough of a window's anchors stand within ``slop``, or exactly."""
    anchors, slop = stage(rare_words(windows, docs_words, near), "anchors"), slop if near else 0
    wanted = small_side(stage(anchors.select("term").distinct(), "rare-terms"))
    postings = docs_words.select("key", F.posexplode("w").alias("pos", "term")).join(wanted, "term").select("term", "key", "pos")
    places = postings.join(small_side(anchors), "term").select(
        "key", "wid", "sure", "rank", F.explode(F.sequence(F.col("pos") - F.col("off") - slop, F.col("pos") - F.col("off") + slop)).alias("start"))
    found = places.groupBy("key", "wid", "start", "sure").agg(F.bit_or(F.expr("shiftleft(1L, rank)")).alias("ranks"))
    return found.filter(F.bit_count("ranks") >= F.col("sure")).select("key", "wid", "start")


def find_benchmark(docs: DataFrame, items: DataFrame, length: int = WINDOW_WORDS, slop: int = SLOP,
                   id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                   item_text_col: str = "text", near: bool = True) -> DataFrame:
    """Per document row: ``row`` (all its columns), ``n_words``, ``hits``, ``near``.

    * ``hits``: array of (start, end, items), one per exact occurrence of a
      window; ``start`` and ``end`` count words, ``end`` exclusive.
    * ``near``: array of (start, items, missing), one per window that does not
      occur but has places where most of its words stand within ``slop`` of
      theirs: the first of those with the fewest words missing; empty without ``near``.

    NULL texts have no words; documents and items without words match nothing.
    Repeated rows get equal results. NULL item ids count as the id ''. Extra
    columns of any name are carried inside ``row``. Empty tables give empty
    results, and an empty benchmark leaves every document clean.
    """
    base = docs.select(F.struct("*").alias("row")).select(
        "row", text_of(F.col("row")[text_col]).alias("t"),
        row_key(F.col("row")[id_col], F.col("row")[text_col]).alias("key"))
    narrow = docs.select(row_key(F.col(id_col), F.col(text_col)).alias("key"), words(text_of(text_col)).alias("w"))
    windows = stage(item_windows(items, length, item_col, item_text_col), "windows")
    found = candidates(narrow, windows, slop, near).join(small_side(windows), "wid")
    per_doc = found.groupBy("key").agg(F.collect_list(F.struct("start", "wid", "win", "items")).alias("found"))
    w = base.join(per_doc, "key", "left").select(
        "row", words(F.col("t")).alias("w"), F.coalesce("found", F.expr("cast(array() as array<struct<start:int,wid:bigint,win:array<string>,items:array<string>>>)")).alias("found"))
    missing = (" size(filter(c.win, (x, i) -> not array_contains(slice(w, greatest(c.start + i - SLOP, 0) + 1,"
               " greatest(c.start + i + SLOP + 1 - greatest(c.start + i - SLOP, 0), 0)), x)))").replace("SLOP", str(slop)) if near else "size(c.win)"
    checked = w.select("row", F.size("w").cast("long").alias("n_words"), F.expr(
        "transform(found, c -> struct(c.start, c.start + size(c.win) as end, c.wid, c.items, size(c.win) as len,"
        " c.start >= 0 and slice(w, greatest(c.start, 0) + 1, size(c.win)) = c.win as exact,"
        f" {missing} as missing))").alias("c"))
    whole = checked.withColumn("exact", F.expr("array_distinct(transform(filter(c, x -> x.exact), x -> x.wid))"))
    nearly = whole.withColumn("n", F.expr(
        f"array_sort(transform(filter(c, x -> x.len - x.missing >= ceil(x.len * {NEAR} / 10) and not array_contains(exact, x.wid)),"
        " x -> struct(x.wid, x.missing, x.start, x.items)))"))
    return nearly.select(
        "row", "n_words",
        F.expr("array_sort(transform(filter(c, x -> x.exact), x -> struct(x.start, x.end, x.items)))").alias("hits"),
        F.expr("array_sort(transform(filter(n, (x, i) -> i = 0 or n[greatest(i - 1, 0)].wid <> x.wid), x -> struct(x.start, x.items, x.missing)))").alias("near"))


#: Words inside any hit: a running maximum of the ends over the hits in order of start.
COVERED = ("aggregate(hits, struct(0 as upto, 0L as n), (a, h) -> struct(greatest(a.upto, h.end) as upto,"
           " a.n + greatest(0, h.end - greatest(a.upto, h.start)) as n), a -> a.n)")


def op9_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's row per document: words, words hit, and the items that occur."""
    found = find_benchmark(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), near=False)
    ids = F.array_sort(F.array_distinct(F.flatten("hits.items")))
    out = found.select("row.doc_id", "n_words", F.expr(COVERED).cast("long").alias("n_hit"), ids.alias("ids"))
    return out.select("doc_id", "n_words", "n_hit", F.size("ids").cast("long").alias("n_items"),
                      F.sha2(F.concat_ws(",", "ids"), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


def op9_near_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the number and ids (comma-joined) of the items that nearly occur and don't occur."""
    found = find_benchmark(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    out = found.select("row.doc_id", F.array_sort(F.array_except(F.flatten("near.items"), F.flatten("hits.items"))).alias("near"))
    return out.select("doc_id", F.size("near").cast("long").alias("n_near"), F.concat_ws(",", "near").alias("near_items"))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents in which no window occurs, with their columns."""
    return find_benchmark(docs, items, near=False).filter(F.size("hits") == 0).select("row.*")


ORACLE_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
bw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item_id, array_to_string(w[s + 1 : s + 10], ' ') AS g, least(len(w), 10) AS n
  FROM (SELECT item_id, w, unnest(generate_series(0, greatest(len(w) - 10, 0))) AS s FROM bw WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
occ AS (
  SELECT d.doc_id, d.s, d.n, win.item_id
  FROM (SELECT doc_id, n, s, array_to_string(w[s + 1 : s + n], ' ') AS g
        FROM (SELECT doc_id, w, n, unnest(generate_series(0, len(w) - n)) AS s FROM dw, lens WHERE len(w) >= n)) d
  JOIN win ON win.n = d.n AND win.g = d.g),
hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM (SELECT DISTINCT doc_id, s, n FROM occ)) GROUP BY doc_id),
ids AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS l
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM occ) GROUP BY doc_id)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(l, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)
"""
