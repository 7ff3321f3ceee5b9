"""Exact dedup: against a dictionary of whole texts, through overflow, on edge cases."""

import hashlib

import numpy as np
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from regstar.llm.exact_dedup import OpenTable, drop_exact_duplicates, exact_duplicates


def plain(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(t or "", []).append(i)
    out = []
    for i, t in rows:
        ids = groups[t or ""]
        known = [x for x in ids if x is not None]
        out.append((i, max(known) if known else None, len(ids), hashlib.sha256((t or "").encode()).hexdigest()))
    return sorted(out, key=str)


def check(spark, rows, **sizes):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = exact_duplicates(df, **sizes).collect()
    assert sorted([(r.id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == plain(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({t or "" for _, t in rows}) and all(r.id == r.keep_id for r in kept)


@given(st.lists(st.tuples(st.integers(0, 3), st.sampled_from([b"", b"a", b"b", b"cc", b"dd", b"e" * 9])), max_size=60), st.sampled_from([3, 8, 1000]))
@settings(max_examples=80, deadline=None)
def test_a_table_holds_a_text_from_its_first_row_on_or_never(rows, most):
    table, seen = OpenTable(most), {}
    for at in range(0, len(rows), 7):
        part = rows[at:at + 7]
        # colliding hashes: only the bytes tell texts apart
        place = table.place(np.array([len(t) for _, t in part], dtype=np.int64), [t for _, t in part])
        for (_, t), p in zip(part, place.tolist(), strict=True):
            assert seen.setdefault(t, p) == p
            assert p == -1 or table.texts[p] == t
    assert len(set(table.texts)) == len(table.texts)


def test_many_texts_grow_the_table():
    table = OpenTable()
    texts = [str(k % 5000).encode() for k in range(20_000)]
    place = table.place(np.array([hash(t) for t in texts], dtype=np.int64), texts)
    assert len(table) == 5000 and [table.texts[p] for p in place.tolist()] == texts


def test_overflow_gives_the_same_groups(spark):
    rows = [(k, f"text {k % 40} " * (k % 40)) for k in range(400)]
    check(spark, rows)
    check(spark, rows, bucket_bytes=4000, table_bytes=300)


def test_a_third_of_all_rows_is_one_text(spark):
    check(spark, [(k, "same" if k % 3 == 0 else f"own {k}") for k in range(3000)], bucket_bytes=2000, table_bytes=1000)


def test_edges(spark):
    check(spark, [(1, None), (2, ""), (None, "x"), (None, "x"), (7, "y"), (7, "y"), (None, "y"), (9, "z" * 2_000_000), (8, "z" * 2_000_000), (3, "Z"), (4, "z ")])
    check(spark, [])


def test_rows_that_stay_keep_all_columns(spark):
    df = spark.createDataFrame([(1, "a"), (2, "a"), (2, "a"), (None, "b"), (None, "b"), (5, None)], "doc_id long, text string")
    df = df.withColumns({"id": F.lit("i"), "row": F.lit(1), "sha": F.lit("s"), "kept": F.col("text")})
    out = drop_exact_duplicates(df)
    assert out.columns == df.columns
    assert sorted([(r.doc_id, r.text, r.id, r.kept) for r in out.collect()], key=str) == sorted(
        [(2, "a", "i", "a"), (None, "b", "i", "b"), (5, None, "i", None)], key=str)
