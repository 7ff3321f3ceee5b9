"""Importance resampling towards a target distribution, over hashed word runs.

Features of a text are its runs of 1 to ``RUN`` words, joined by one space;
their bucket is the CRC-32 of their bytes modulo ``BUCKETS``. From the bucket
counts of all documents and of all target texts follows each bucket's gain, from
these a document's weight, and the documents with the greatest weights plus
Gumbel noise (drawn from a hash of the id) are a sample without replacement.

Buckets are made in Arrow batches. The distinct runs of a slice of words are
found by numbers, never by hashes: words are dictionary-encoded, and a run of k
words is the pair of its first k - 1 words' number and its last word's number.
Distinct runs of equal length are the rows of a uint8 matrix, whose CRCs are
updated column by column; the buckets are then scattered back to all runs.

Counts are two columns of at most ``BUCKETS`` rows, which every task gets.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from regstar.llm import wordhash as wh
from regstar.llm.common import ship, stage, text_of
from regstar.operators.keys import dense_key
from regstar.sources.tables import read_table

RUN, BUCKETS, SEED = 3, 10_000, 42
#: Documents of fewer words are not drawn; so many of a hundred others are.
LEAST_WORDS, PERCENT = 20, 5
#: Words, and matrix bytes, that are worked on at once.
WORDS_AT_ONCE, MATRIX_BYTES = 1 << 18, 8 << 20


def _crc_table() -> np.ndarray:
    """CRC-32 of each byte, from the reflected polynomial."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & np.uint32(1), (t >> np.uint32(1)) ^ np.uint32(0xEDB88320), t >> np.uint32(1))
    return t


TABLE = _crc_table()


def crc32_rows(matrix: np.ndarray) -> np.ndarray:
    """CRC-32 of each row of a uint8 matrix; all rows are updated column by column."""
    crc = np.full(len(matrix), 0xFFFFFFFF, dtype=np.uint32)
    for column in np.ascontiguousarray(matrix.T):
        crc = TABLE[(crc ^ column) & np.uint32(0xFF)] ^ (crc >> np.uint32(8))
    return crc ^ np.uint32(0xFFFFFFFF)


def crc32_slices(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC-32 of data[start:start + size], grouped by size."""
    out = np.empty(len(start), dtype=np.uint32)
    order = np.argsort(size, kind="stable")
    lengths, first = np.unique(size[order], return_index=True)
    for length, rows in zip(lengths.tolist(), np.split(order, first[1:]), strict=True):
        step = max(1, MATRIX_BYTES // max(length, 1))
        for at in range(0, len(rows), step):
            part = rows[at:at + step]
            out[part] = crc32_rows(data[start[part][:, None] + np.arange(length)])
    return out


def _spaced(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The folded words one after the other, a space after each, and where each begins."""
    begin = np.cumsum(size + 1) - (size + 1)
    out = np.full(int((size + 1).sum()), 0x20, dtype=np.uint8)
    inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(begin, size) + inside] = wh.LOWER[data[np.repeat(start, size) + inside]]
    return out, begin


def _word_numbers(spaced: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """Equal words have equal numbers, by their bytes."""
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(begin), [None, pa.py_buffer(np.append(begin, len(spaced)).astype(np.int64)), pa.py_buffer(spaced)])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


def run_buckets(data: np.ndarray, start: np.ndarray, end: np.ndarray, last: np.ndarray, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word, bucket) of every run of 1 to RUN words; ``word`` is where it begins, ``last`` the end of each word's text.

    Works on WORDS_AT_ONCE beginnings at a time, so a very long text needs no more memory.
    """
    for a in range(0, len(start), WORDS_AT_ONCE):
        b = min(a + WORDS_AT_ONCE, len(start))
        upto = min(b + RUN - 1, len(start))
        size = (end - start)[a:upto]
        spaced, begin = _spaced(data, start[a:upto], size)
        word = _word_numbers(spaced, begin)
        many = int(word.max()) + 1
        number, owner = word, np.arange(b - a)
        for k in range(1, RUN + 1):
            if k > 1:  # the run one shorter, and the word after it
                going = np.flatnonzero(a + owner + k <= last[a + owner])
                owner = owner[going]
                number = number[going] * many + word[owner + k - 1]
            if not len(owner):
                break
            number, distinct = pd.factorize(number[:len(owner)])
            example = np.empty(len(distinct), dtype=np.int64)
            example[number] = owner
            length = begin[example + k - 1] + size[example + k - 1] - begin[example]
            crc = crc32_slices(spaced, begin[example], length)
            yield a + owner, (crc % np.uint32(buckets)).astype(np.int64)[number]


def _batch_runs(text: pa.Array, buckets: int):
    data, start, end, first = wh.split_words(text, wh.NOT_ALNUM)
    doc = np.repeat(np.arange(len(text)), np.diff(first))
    return np.diff(first), doc, run_buckets(data, start, end, first[1:][doc], buckets)


def _counts(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for big in batches:
            for b in wh.slices(big, 0):
                for _, bucket in _batch_runs(b.column(0), buckets)[2]:
                    total += np.bincount(bucket, minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": pa.array(at.astype(np.int32)), "n": pa.array(total[at])})

    return run


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): runs of all texts in each bucket that has any; at most ``buckets`` rows."""
    ship(texts.sparkSession)
    parts = texts.select(text_of(text_col).alias("t")).mapInArrow(_counts(buckets), "bucket int, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, text_col: str = "text", target_col: str = "text", buckets: int = BUCKETS) -> DataFrame:
    """(bucket, gain) of every bucket: 1000 times the log ratio of its smoothed shares, rounded down."""
    s, t = bucket_counts(docs, text_col, buckets), bucket_counts(target, target_col, buckets)
    both = (docs.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket"))
            .join(s.withColumnRenamed("n", "s"), "bucket", "left").join(t.withColumnRenamed("n", "t"), "bucket", "left").fillna(0, ["s", "t"]))
    both = stage(both, "bucket-counts")
    total = both.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("all_s"), F.coalesce(F.sum("t"), F.lit(0)).alias("all_t")).first()
    up = (F.col("t") + 1).cast("double") * F.lit(float(total.all_s + buckets))
    down = (F.col("s") + 1).cast("double") * F.lit(float(total.all_t + buckets))
    return both.select("bucket", F.floor(F.lit(1000.0) * F.log(up / down)).cast("long").alias("gain"))


WEIGHED = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()), ("weight", pa.int64())])


def _weigh(gains, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain = gains.value
        for big in batches:
            for b in wh.slices(big, 1):
                words, doc, found = _batch_runs(b.column(1), buckets)
                weight = np.zeros(len(b), dtype=np.int64)
                for word, bucket in found:
                    of = doc[word]
                    begin = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
                    weight[of[begin]] += np.add.reduceat(gain[bucket], begin)
                runs = sum(np.maximum(words - k, 0) for k in range(RUN))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words), pa.array(runs), pa.array(weight)], schema=WEIGHED)

    return run


def gumbel(id_col: Column, seed: int = SEED) -> Column:
    """Gumbel noise times 1000, rounded down, from the first 32 bits of a hash of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("long")


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", target_col: str = "text",
             percent: int = PERCENT, least_words: int = LEAST_WORDS, buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """Per row: (id, n_words, n_features, weight, score, rank); ``rank`` is NULL for those not drawn.

    Of the N rows with at least ``least_words`` words floor(percent * N / 100) are
    drawn, by descending score, then ascending id (rows without id first), from 1.
    Repeated rows have equal scores and ranks next to each other. NULL texts have
    no words; rows without words have weight 0. An empty target, or an empty
    table, has counts of 0. Other columns are not looked at.
    """
    spark = docs.sparkSession
    ship(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_of(text_col).alias("t"))
    table = bucket_gains(docs, target, text_col, target_col, buckets).toPandas()  # one row a bucket
    gain = np.zeros(buckets, dtype=np.int64)
    gain[table["bucket"].to_numpy()] = table["gain"].to_numpy()
    weighed = rows.mapInArrow(_weigh(spark.sparkContext.broadcast(gain), buckets), "id long, n_words long, n_features long, weight long")
    weighed = stage(weighed.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed)), "weighed")
    able = F.col("n_words") >= least_words
    drawn = weighed.filter(able).count() * percent // 100
    ranked = dense_key(weighed.filter(able), [F.desc("score"), F.asc("id")], "place", as_int=False)
    ranked = ranked.withColumn("rank", F.when(F.col("place") <= drawn, F.col("place"))).drop("place")
    return ranked.unionByName(weighed.filter(~able).withColumn("rank", F.lit(None).cast("long"))).select(
        "id", "n_words", "n_features", "weight", "score", "rank")


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's row per document."""
    found = resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(F.col("id").alias("doc_id"), "n_features", "weight", "score", "rank")


_WORDS = (f"regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),"
          r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")
_RUNS = " UNION ALL ".join(
    f"SELECT doc_id, kind, unnest(list_transform(generate_series(1, len(w) - {k - 1}), lambda i: array_to_string(w[i : i + {k - 1}], ' '))) AS f"
    f" FROM texts WHERE len(w) >= {k}" for k in range(1, RUN + 1))
ORACLE_SQL = f"""
WITH steps AS (
  SELECT list(list_reduce(list_concat([b], [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z:
    CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY b) AS t
  FROM (SELECT unnest(generate_series(0, 255))::BIGINT AS b)),
texts AS (
  SELECT doc_id, 'd' AS kind, {_WORDS} AS w FROM documents
  UNION ALL SELECT NULL, 'b', {_WORDS} FROM benchmark),
counted AS (SELECT doc_id, kind, f, count(*) AS n FROM ({_RUNS}) GROUP BY ALL),
hashed AS (
  SELECT f, xor(list_reduce(list_concat([4294967295], list_transform(generate_series(1, strlen(f)), lambda i:
    ('0x' || substr(hex(encode(f)), CAST(2 * i - 1 AS INT), 2))::BIGINT)),
    lambda c, x: xor(c >> 8, t[CAST(xor(c, x) & 255 AS INT) + 1])), 4294967295) % {BUCKETS} AS bucket
  FROM (SELECT DISTINCT f FROM counted), steps),
placed AS (SELECT doc_id, kind, bucket, n FROM counted JOIN hashed USING (f)),
bucket AS (
  SELECT bucket, coalesce(sum(n) FILTER (kind = 'd'), 0) AS s, coalesce(sum(n) FILTER (kind = 'b'), 0) AS t FROM placed GROUP BY bucket),
total AS (SELECT sum(s) AS all_s, sum(t) AS all_t FROM bucket),
gain AS (
  SELECT bucket, CAST(floor(1000 * ln(CAST((t + 1) AS DOUBLE) * CAST(all_s + {BUCKETS} AS DOUBLE) /
    (CAST((s + 1) AS DOUBLE) * CAST(all_t + {BUCKETS} AS DOUBLE)))) AS BIGINT) AS gain FROM bucket, total),
weight AS (SELECT doc_id, sum(n) AS n_features, sum(n * gain) AS weight FROM placed JOIN gain USING (bucket) WHERE kind = 'd' GROUP BY doc_id),
scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score
  FROM texts LEFT JOIN weight USING (doc_id) WHERE kind = 'd'),
ranked AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS able FROM scored WHERE n_words >= {LEAST_WORDS})
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
  CASE WHEN place <= {PERCENT} * able // 100 THEN place END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)
"""
