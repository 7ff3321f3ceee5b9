"""Exact duplicates by Grace hash deduplication.

1. Each task puts its rows into an open-addressing table of bounded size. When
   the table is full it is emptied: every distinct text of it leaves as one
   *lead* with the ids of its rows, so a text that a third of all rows have
   leaves a task a few times, not once a row.
2. Leads are dealt by a hash of their text to buckets, as many as their bytes
   ask for; the spill files are those of Spark's shuffle. A task reads a bucket
   into an open-addressing table, which compares complete texts. Once the table
   is full it takes no new text, and leads of texts that it does not hold are
   written to overflow files.
3. Overflow is dealt again by another hash to more buckets, until none is left.
   Each table takes at least one text, so that ends.

A bucket gives back, for the leads of texts with several leads, the row that
stays and the number of rows; every other lead is a class of its own. Ids are
never gathered by text: they stay with their leads.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from regstar.llm import wordhash as wh
from regstar.llm.common import ship, small_side, text_of
from regstar.session import scratch_path
from regstar.sources.tables import read_table

#: Bytes of text that a task's table holds before its leads leave it.
LEAD_BYTES = 16 << 20
#: Bytes of text that a bucket should have, and that its table takes at most.
BUCKET_BYTES, TABLE_BYTES = 32 << 20, 64 << 20
LEAST = np.iinfo(np.int64).min


class OpenTable:
    """Distinct texts by open addressing with linear probing; texts are equal if all their bytes are.

    Full once a text would take it beyond ``most`` bytes: from then on no new
    text is taken, so that a text is either held from its first row on or never.
    """

    def __init__(self, most: float = math.inf):
        self.most, self.bytes, self.full = most, 0, False
        self.texts: list[bytes] = []
        self.hashes = np.zeros(512, dtype=np.int64)
        self.slots = np.full(1024, -1, dtype=np.int64)

    def __len__(self) -> int:
        return len(self.texts)

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return (wh.mix(h.view(np.uint64)) & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def _grow(self, room: int) -> None:
        """At least as many slots as twice the texts held and to come."""
        size = len(self.slots)
        while size < 2 * (len(self) + room):
            size *= 2
        if size == len(self.slots):
            return
        self.hashes = np.concatenate([self.hashes[:len(self)], np.zeros(size // 2 - len(self), dtype=np.int64)])
        self.slots = np.full(size, -1, dtype=np.int64)
        at, waiting = self._slot(self.hashes[:len(self)]), np.arange(len(self))
        while len(waiting):
            free = waiting[self.slots[at[waiting]] < 0]
            self.slots[at[free]] = free  # of those that meet in a slot one stays
            waiting = waiting[self.slots[at[waiting]] != waiting]
            at[waiting] = (at[waiting] + 1) & (size - 1)

    def _take(self, slot: int, h: int, text: bytes) -> None:
        if self.full or (self.texts and self.bytes + len(text) > self.most):
            self.full = True
            return
        self.slots[slot] = len(self)
        self.hashes[len(self)] = h
        self.texts.append(text)
        self.bytes += len(text)

    def place(self, h: np.ndarray, texts: list[bytes]) -> np.ndarray:
        """The number of each row's text in the table, -1 where it is not held and not taken."""
        self._grow(len(h))
        out = np.full(len(h), -1, dtype=np.int64)
        at, waiting = self._slot(h), np.arange(len(h))
        while len(waiting):
            entry = self.slots[at[waiting]]
            new = waiting[entry < 0]
            if len(new):
                slot, first = np.unique(at[new], return_index=True)
                for s, row in zip(slot.tolist(), new[first].tolist(), strict=True):
                    self._take(s, h[row], texts[row])
                if self.full:
                    waiting = waiting[self.slots[at[waiting]] >= 0]
                entry = self.slots[at[waiting]]
            same = np.flatnonzero(self.hashes[entry] == h[waiting])
            equal = np.array([self.texts[e] == texts[r] for e, r in zip(entry[same].tolist(), waiting[same].tolist(), strict=True)], dtype=bool)
            found = same[equal]
            out[waiting[found]] = entry[found]
            waiting = np.delete(waiting, found)
            at[waiting] = (at[waiting] + 1) & (len(self.slots) - 1)
        return out


LEAD = pa.schema([("lead", pa.int64()), ("h", pa.int64()), ("n", pa.int64()), ("top", pa.int64()),
                  ("ids", pa.list_(pa.int64())), ("t", pa.string())])
LEADS = "lead long, h long, n long, top long, ids array<long>, t string"


def _bytes(text: pa.Array) -> list[bytes]:
    return text.cast(pa.large_binary() if pa.types.is_large_string(text.type) else pa.binary()).to_pylist()


def _lead_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (id, h, t) to leads; the ids of a lead are in descending order, unknown ones last."""
    number = TaskContext.get().partitionId() << 40
    table, parts = OpenTable(), []

    def out() -> pa.RecordBatch:
        nonlocal number
        entry, ids, known = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((~ids, ~known, entry))
        entry, ids, known = entry[order], ids[order], known[order]
        first = np.searchsorted(entry, np.arange(len(table)))
        lists = pa.ListArray.from_arrays(np.append(first, len(entry)).astype(np.int32), pa.array(ids, mask=~known))
        batch = pa.RecordBatch.from_arrays([
            pa.array(number + np.arange(len(table))), pa.array(table.hashes[:len(table)]), pa.array(np.diff(np.append(first, len(entry)))),
            pa.array(ids[first], mask=~known[first]), lists, pa.array(table.texts, pa.binary()).cast(pa.string())], schema=LEAD)
        number += len(table)
        return batch

    for big in batches:
        for b in wh.slices(big, 2):
            entry = table.place(b.column(1).to_numpy(), _bytes(b.column(2)))
            parts.append((entry, b.column(0).fill_null(LEAST).to_numpy(), b.column(0).is_valid().to_numpy(zero_copy_only=False)))
            if table.bytes >= LEAD_BYTES or sum(len(p[0]) for p in parts) >= 1 << 18:
                yield out()
                table, parts = OpenTable(), []
    if parts:
        yield out()


FACT = pa.schema([("lead", pa.int64()), ("keep_lead", pa.int64()), ("keep_id", pa.int64()), ("size", pa.int64()),
                  ("h", pa.int64()), ("n", pa.int64()), ("top", pa.int64()), ("t", pa.string())])
FACTS = "lead long, keep_lead long, keep_id long, size long, h long, n long, top long, t string"


def _bucket(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Leads (lead, h, n, top, t) of a bucket: its overflow as it comes, then what its table found."""
        table, parts = OpenTable(most), []
        for big in batches:
            for b in wh.slices(big, 4):
                entry = table.place(b.column(1).to_numpy(), _bytes(b.column(4)))
                held = entry >= 0
                top = b.column(3)
                parts.append([x[held] for x in (entry, b.column(0).to_numpy(), b.column(2).to_numpy(), top.fill_null(LEAST).to_numpy(),
                                                top.is_valid().to_numpy(zero_copy_only=False))])
                if not held.all():
                    rest = b.filter(pa.array(~held))
                    none = pa.nulls(len(rest), pa.int64())
                    yield pa.RecordBatch.from_arrays([rest.column(0), none, none, none, *rest.columns[1:]], schema=FACT)
        if not parts:
            return
        entry, lead, n, top, known = (np.concatenate(c) for c in zip(*parts, strict=True))
        order = np.lexsort((lead, ~top, ~known, entry))  # of each text the lead with the largest id first
        entry, lead, n, top, known = (x[order] for x in (entry, lead, n, top, known))
        first = np.searchsorted(entry, np.arange(len(table)))
        size = np.add.reduceat(n, first)
        several = np.flatnonzero(np.diff(np.append(first, len(entry)))[entry] > 1)
        best = first[entry[several]]
        none = pa.nulls(len(several), pa.int64())
        yield pa.RecordBatch.from_arrays([
            pa.array(lead[several]), pa.array(lead[best]), pa.array(top[best], mask=~known[best]), pa.array(size[entry[several]]),
            none, none, none, pa.nulls(len(several), pa.string())], schema=FACT)

    return run


def _store(df: DataFrame, name: str, parts: list[str] | None = None) -> str:
    path = scratch_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*parts) if parts else writer).parquet(path)
    return path


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     bucket_bytes: int = BUCKET_BYTES, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """Per row: (id, keep_id, group_size, kept, text_sha256).

    Rows are copies if their texts are identical; NULL counts as the empty text.
    The row with the largest id of a group stays. Exactly one row of a group is
    ``kept``: of repeated rows with the largest id one, and of a group whose rows
    all lack an id one (its ``keep_id`` is NULL). An empty table has no rows.
    Other columns are not looked at.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("t"))
    leads = rows.select("id", F.xxhash64("t").alias("h"), "t").mapInArrow(_lead_rows, LEADS)
    leads = spark.read.schema(LEADS + ", sha string, size long").parquet(_store(
        leads.withColumns({"sha": F.sha2("t", 256), "size": F.octet_length("t").cast("long")}), "leads"))
    left, level, found = leads.select("lead", "h", "n", "top", "t", "size"), 0, None
    while (waiting := left.agg(F.sum("size")).first()[0]) is not None:
        buckets = max(2 if level else 1, math.ceil(waiting / bucket_bytes))
        dealt = left.drop("size").repartition(buckets, F.xxhash64(F.lit(level), F.col("h")))
        facts = dealt.mapInArrow(_bucket(table_bytes), FACTS).withColumn("overflow", F.col("n").isNotNull())
        stored = spark.read.schema(FACTS + ", overflow boolean").parquet(_store(facts, f"bucket-facts-{level}", ["overflow"]))
        part = stored.filter("not overflow").select("lead", "keep_lead", "keep_id", "size")
        found = part if found is None else found.unionByName(part)
        left = stored.filter("overflow").select("lead", "h", "n", "top", "t", F.octet_length("t").cast("long").alias("size"))
        level += 1
    each = leads.select("lead", F.col("n").alias("own"), "top", "ids", "sha")
    if found is None:
        found = spark.createDataFrame([], "lead long, keep_lead long, keep_id long, size long")
    joined = each.join(_small(found), "lead", "left")
    alone = F.col("keep_lead").isNull()
    return joined.select(
        F.posexplode("ids").alias("place", "id"), F.when(alone, F.col("top")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("size", "own").alias("group_size"), (alone | (F.col("keep_lead") == F.col("lead"))).alias("best"), "sha"
    ).select("id", "keep_id", "group_size", (F.col("best") & (F.col("place") == 0)).alias("kept"), F.col("sha").alias("text_sha256"))


def _small(found: DataFrame) -> DataFrame:
    return small_side(found) if found.inputFiles() else found


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; extra columns may have any name."""
    stay = exact_duplicates(docs, id_col, text_col).filter("kept").select("id", F.col("text_sha256").alias("sha"))
    rows = docs.select(F.struct("*").alias("row")).select(
        "row", F.col("row")[id_col].cast("long").alias("own_id"), F.sha2(text_of(F.col("row")[text_col]), 256).alias("own_sha"))
    match = F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_sha") == F.col("sha"))
    return rows.join(stay, match, "left_semi").dropDuplicates(["own_id", "own_sha"]).select("row.*")


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's row per document."""
    docs = read_table(spark, sf_dir, "documents")
    return exact_duplicates(docs).withColumnRenamed("id", "doc_id")


ORACLE_SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
