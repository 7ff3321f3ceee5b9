"""Registered queries against their SQL or a brute-force version, at the smallest scale."""

import hashlib

import duckdb
import numpy as np
import pytest

from conftest import SF_SMALL
from regstar.llm.queries import ORACLES, QUERIES
from regstar.sources.tables import TABLES, read_table
from tools.check_oracles import digest


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(names) and len(got) == len(want)
    assert digest(df.columns, got)[0] == digest(names, want)[0]


def classes(ids, links):
    parent = {i: i for i in ids}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        p, q = root(a), root(b)
        parent[max(p, q)] = min(p, q)
    return {i: root(i) for i in ids}


def test_op1_equals_all_pairs(spark):
    e = read_table(spark, SF_SMALL, "embeddings").orderBy("vec_id").toPandas()
    ids, x = e.vec_id.tolist(), np.vstack(e.embedding.to_numpy()).astype(float)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    close = x @ x.T >= 0.9
    np.fill_diagonal(close, False)
    comp = classes(ids, [(ids[i], ids[j]) for i, j in zip(*np.nonzero(close), strict=True)])
    got = {r.vec_id: r for r in QUERIES["op1_embedding_near_dedup"](spark, SF_SMALL).collect()}
    for i, v in enumerate(ids):
        assert (got[v].n_links, got[v].component_id, got[v].kept) == (close[i].sum(), comp[v], comp[v] == v)


def test_op2_equals_the_library(spark):
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r.doc_id: r for r in QUERIES["op2_sentencepiece"](spark, SF_SMALL).collect()}
    for d in read_table(spark, SF_SMALL, "documents").collect():
        ids = sp.encode(d.text)
        r = got[d.doc_id]
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest() and r.n_differ == 0


def test_op4_finds_held_out_toxic_documents(spark):
    sf = SF_SMALL.replace("sf0.001", "sf0.01")
    x = QUERIES["op4_toxicity"](spark, sf).join(read_table(spark, sf, "labels"), "doc_id").filter("held_out").toPandas()
    assert len(x) == len(x.doc_id.unique())
    assert x[x.toxic == 0].predicted.mean() <= 0.05
    assert x[x.toxic == 1].predicted.mean() >= 0.5
    assert x.score.between(0, 1).all()


def test_op7_ranks_held_out_documents(spark):
    sf = SF_SMALL.replace("sf0.001", "sf0.01")
    x = QUERIES["op7_quality_classifier"](spark, sf).join(read_table(spark, sf, "labels"), "doc_id").filter("held_out").toPandas()
    assert x[x.quality == 1].predicted.mean() >= 0.9
    assert x[x.quality == 0].predicted.mean() <= 0.3
    assert x.score.between(0, 1).all()


def test_op10_equals_all_pairs(spark):
    import pyarrow as pa

    from test_near_dedup import similar_pairs

    d = read_table(spark, SF_SMALL, "documents").select("doc_id", "text").toPandas()
    ids = d.doc_id.tolist()
    links = [(ids[i], ids[j]) for i, j in similar_pairs(d.text.tolist())]
    want = classes(ids, links)
    got = {r.doc_id: (r.class_id, r.kept) for r in QUERIES["op10_minhash_near_dedup"](spark, SF_SMALL).collect()}
    assert got == {i: (c, c == i) for i, c in want.items()}
