"""Near dedup against weighted Jaccard similarities worked out from words, and its parts against plain counts."""

import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings, strategies as st

from regstar.llm import near_dedup as N


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return Counter(tuple(w[i:i + 5]) for i in range(max(len(w) - 4, 1))) if w else Counter()


def weights(texts):
    each = [shingles(t) for t in texts]
    df, n = Counter(s for c in each for s in c), len(texts)
    return [{s: k * (0.5 + 0.5 * math.log((n + 1) / (df[s] + 1)) / math.log(n + 2)) for s, k in c.items()} for c in each]


def jaccard(a, b):
    both = sum(min(a[s], b[s]) for s in a.keys() & b.keys())
    every = sum(a.values()) + sum(b.values()) - both
    return both / every if every else 0.0


def similar_pairs(texts):
    """(i, j) of similarity 0.8 or more; only those that share a shingle are looked at."""
    w, having = weights(texts), {}
    for i, c in enumerate(w):
        for s in c:
            having.setdefault(s, []).append(i)
    pairs = {(i, j) for members in having.values() for i in members for j in members if j < i}
    return [(i, j) for i, j in pairs if jaccard(w[i], w[j]) >= 0.8]


@given(st.lists(st.integers(0, (1 << 64) - 1), max_size=50))
@settings(max_examples=60, deadline=None)
def test_squeezed_numbers_come_back(numbers):
    x = np.array(numbers, dtype=np.uint64)
    assert N._spread(N._squeeze(x), len(x)).tolist() == numbers


def test_frequencies_and_weights_are_exact(spark, monkeypatch):
    rng = random.Random(10)
    common = " ".join(f"all{i}" for i in range(20))
    texts = [f"{common if i % 3 else ''} " + " ".join(f"w{rng.randrange(40)}" for _ in range(300)) for i in range(400)]
    monkeypatch.setattr(N, "BUCKET_BYTES", 60_000)  # several buckets
    signed, n = N.sign_documents(spark.createDataFrame(list(enumerate(texts * 2)), "doc long, t string").repartition(3))
    rows = {r.doc: r for r in signed.collect()}  # every text is there twice, so all documents are signed
    assert n == 800 and len(rows) == 800
    df = Counter(s for t in texts for s in shingles(t))
    for i in (0, 1, 799):
        body = rows[i].body
        assert sorted(N._spread(bytes(body.df), body.n).tolist()) == sorted(2 * df[s] for s in shingles(texts[i % 400]))
        x = N.Weighted([body.asDict()], 800)
        assert np.isclose(x.total[0], sum(weights(texts * 2)[i].values()), rtol=1e-4)


def test_documents_without_enough_in_common_go_no_further(spark):
    rng = random.Random(1)
    own = lambda n: " ".join(f"w{rng.randrange(100_000)}" for _ in range(n))
    half = own(100)
    docs = [(1, f"{half} {own(100)}"), (2, f"{half} {own(100)}"), (3, own(50)), (4, f"{half} x"), (None, own(9)), (5, None), (6, "a b"), (7, "A b")]
    signed, n = N.sign_documents(spark.createDataFrame(docs, "doc long, t string"))
    assert n == 8 and sorted(r.doc for r in signed.collect()) == [4, 6, 7]


def test_links_are_those_of_exact_weights(spark):
    """Documents that share a template of their own group; similarities on both sides of the threshold."""
    rng = random.Random(11)
    own = lambda n: " ".join(f"w{rng.randrange(100_000)}" for _ in range(n))
    texts = []
    for g in range(12):
        template = own(300)
        texts += [f"{template} {own(10 + 5 * g)}" for _ in range(6)]
    texts += [own(200) for _ in range(100)] + [texts[0], texts[0] + " ", "", None]
    near = similar_pairs(texts)
    assert 20 < len(near) < 12 * 15 + 20
    want = list(range(len(texts)))
    for _ in texts:
        for i, j in near:
            want[i] = want[j] = min(want[i], want[j])
    got = dict(N.near_duplicate_classes(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect())
    assert [got[i] for i in range(len(texts))] == want


def test_rows_of_one_id_with_different_texts(spark):
    text = " ".join(f"w{i}" for i in range(60))
    other = " ".join(f"v{i}" for i in range(60))
    docs = [(1, text), (2, text), (2, other), (3, other + " end"), (4, "x")]
    got = dict(N.near_duplicate_classes(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert got == {1: 1, 2: 1, 3: 1, 4: 4}


def test_a_pack_takes_few_times_its_bytes():
    rng, words = np.random.default_rng(1), np.array([f"word{k}" for k in range(5000)])
    texts = [" ".join(rng.choice(words, 400)) for _ in range(1200)]
    b = pa.record_batch([pa.array(range(1200), pa.int64()), pa.array(texts)], names=["doc", "t"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, b.schema) as w:
        w.write_batch(b)
    blob, size = sink.getvalue().to_pybytes(), sum(map(len, texts))
    tracemalloc.start()
    try:
        h, n, first = N._pack_shingles(blob, 3)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 12 * size  # 28 times as it was, with words hashed 4 MB at once
    own, count = np.unique(np.concatenate([N._shingles(pa.array([t]))[1] for t in texts]), return_counts=True)
    order = np.argsort(own % np.uint64(3), kind="stable")
    assert (h == own[order]).all() and (n == count[order]).all() and first[-1] == len(h)
