"""Importance resampling: CRCs and runs against plain Python, ranks against a sort, edge cases."""

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from regstar.llm import resampling as R


def plain_runs(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(w), Counter(zlib.crc32(" ".join(w[i:i + k]).encode()) % R.BUCKETS for k in (1, 2, 3) for i in range(len(w) - k + 1))


def plain(docs, target):
    counted = [(i, *plain_runs(t)) for i, t in docs]
    s, t = sum((c for _, _, c in counted), Counter()), sum((plain_runs(x)[1] for x in target), Counter())
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + R.BUCKETS) / ((s[b] + 1) * (all_t + R.BUCKETS))))
    rows = []
    for i, n, c in counted:
        weight = sum(k * gain(b) for b, k in c.items())
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, n, sum(c.values()), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], r[0] is not None, r[0] or 0))
    for k, r in enumerate(able[:5 * len(able) // 100]):
        r[5] = k + 1
    return sorted(map(tuple, rows), key=str)


def check(spark, docs, target):
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"id": F.lit("x"), "t": F.lit(1), "weight": F.lit(None)})
    b = spark.createDataFrame([(x,) for x in target], "text string")
    got = R.resample(d.repartition(3), b).collect()
    assert sorted(map(tuple, got), key=str) == plain(docs, target)


@given(st.lists(st.binary(min_size=5, max_size=5), min_size=1, max_size=20))
@settings(max_examples=50, deadline=None)
def test_crc_of_rows(rows):
    matrix = np.frombuffer(b"".join(rows), dtype=np.uint8).reshape(len(rows), 5)
    assert R.crc32_rows(matrix).tolist() == [zlib.crc32(r) for r in rows]


@given(st.lists(st.text(alphabet="aAbZ0 -_\né漢\x7f\x80", max_size=30), max_size=8), st.integers(1, 9))
@settings(max_examples=150, deadline=None)
def test_runs_of_a_batch(texts, at_once):
    before, R.WORDS_AT_ONCE = R.WORDS_AT_ONCE, at_once
    try:
        words, doc, found = R._batch_runs(pa.array(texts, pa.string()), R.BUCKETS)
        got = [Counter() for _ in texts]
        for word, bucket in found:
            for w, b in zip(doc[word].tolist(), bucket.tolist(), strict=True):
                got[w][b] += 1
    finally:
        R.WORDS_AT_ONCE = before
    assert [(n, c) for n, c in zip(words.tolist(), got, strict=True)] == [plain_runs(t) for t in texts]


def test_against_plain_python(spark):
    rng = np.random.default_rng(4)
    docs = [(k, " ".join(rng.choice([f"w{i}" for i in range(60)], size=rng.integers(0, 60)))) for k in range(300)]
    check(spark, docs + docs[:30], ["w1 w2 w3 w4", "W5 w6, w7", None])


def test_edges(spark):
    many = " ".join(f"W{k % 97}" for k in range(60_000))
    docs = [(1, None), (2, ""), (3, "one two"), (None, many), (5, many), (5, many), (6, "x" * 400_000)] + [(k, f"é漢{k} " * 25) for k in range(10, 40)]
    check(spark, docs, ["w1 w2"])
    check(spark, docs, [])
    check(spark, [], ["w1"])
