"""Windows that very many documents share: the same words go, and their rows are not dealt by the window."""

import random

import pytest

from regstar.llm import substring_dedup as S
from regstar.llm.common import stage


def plain(docs, window):
    """(words, removed words, kept text) of each (doc, text), by looking at every window."""
    first = {}
    for d, t in sorted(docs):
        w = t.split()
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i:i + window]), d)
    out = {}
    for d, t in docs:
        w, gone = t.split(), set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] < d:
                gone.update(range(i, i + window))
        out[d] = (len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))
    return out


@pytest.mark.parametrize("window", [50, 100])
def test_a_passage_of_a_third_of_all_documents(spark, window):
    rng = random.Random(window)
    shared = [f"s{i}" for i in range(130)]
    docs = []
    for d in range(300):
        own = [f"w{rng.randrange(10**6)}" for _ in range(rng.randrange(150))]
        if d % 3 == 0:
            at = rng.randrange(len(own) + 1)
            own[at:at] = shared if d % 2 else shared[:window + 5] + ["x"] + shared[20:]
        docs.append((d, " ".join(own)))
    got = S.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string"), window).collect()
    assert {r.row.doc_id: (r.cut.n_words, r.cut.n_removed, r.cut.kept) for r in got} == plain(docs, window)


def test_hot_windows_are_joined_where_they_lie(spark):
    found = stage(spark.range(30_000).selectExpr("if(id % 3 = 0, 7, 1000 + id % 4000) as h", "id as doc", "cast(id % 50 as int) as at"), "found")
    shared = S._shared(found, ["h"])
    want = found.join(found.groupBy("h").agg({"doc": "min"}).withColumnRenamed("min(doc)", "lo"), "h").select("h", "doc", "at", "lo")
    assert shared.select("h", "doc", "at", "lo").exceptAll(want).count() == 0 and shared.count() == want.count() == 30_000
    # rows as they come out: the hot window's lie in several partitions
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sizes = S._shared(found, ["h"]).selectExpr("h", "spark_partition_id() as p").filter("h = 7").groupBy("p").count().collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(sizes) == found.rdd.getNumPartitions() and sum(r["count"] for r in sizes) == 10_000
