"""NULLs, empty and long texts, ties, repeated rows, empty tables, and clashing names."""

import numpy as np
import pytest

from regstar.llm.common import stage
from regstar.llm.decontaminate import drop_contaminated, find_benchmark
from regstar.llm.embedding_dedup import link_vectors
from regstar.llm.near_dedup import drop_near_duplicates, near_duplicate_classes
from regstar.llm.quality import fit, score_documents
from regstar.llm.sentencepieces import encode_texts
from regstar.llm.substring_dedup import lengths, remove_repeats
from regstar.llm.toxicity import fit as fit_toxicity, score_documents as score_toxicity
from regstar.llm.warc import normalise, read_archives, write_archives

WORDS = [f"w{i}" for i in range(400)]
LONG = " ".join(WORDS)
DOCS = [
    (5, LONG, "a", 1, "r", 1), (3, LONG, None, None, None, None), (3, LONG, None, None, None, None), (7, "x " + LONG + " y", "b", 2, "s", 2),
    (1, None, None, None, None, None), (2, "", "", 0, "", 0), (None, LONG, "c", 3, "t", 3), (None, None, None, None, None, None),
    (9, "one two three", "d", 4, "u", 4), (11, "z" * 300_000, "e", 5, "v", 5), (12, "é 漢字 🙂 \x00 end", "f", 6, "w", 6),
]
SCHEMA = "doc_id long, text string, `t` string, `key` long, `row` string, `n_words` int"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, SCHEMA)


def test_substrings(spark, docs):
    got = sorted((str(r.row.doc_id), r.cut.n_words, r.cut.n_removed) for r in remove_repeats(docs).collect())
    want = sorted([("3", 400, 0), ("3", 400, 0), ("5", 400, 400), ("7", 402, 400), ("None", 400, 400), ("1", 0, 0), ("2", 0, 0),
                   ("None", 0, 0), ("9", 3, 0), ("11", 1, 0), ("12", 5, 0)])
    assert got == want
    assert remove_repeats(docs.limit(0)).count() == 0
    assert lengths(200) == [25, 50, 100, 200]


def test_substrings_at_several_levels_equal_a_plain_search(spark):
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(WORDS[:3], size=rng.integers(60, 500), p=[.9, .05, .05])) for _ in range(25)]
    window, first, want = 100, {}, {}
    for d, t in enumerate(texts):
        w = t.split()
        gone = set()
        for s in range(len(w) - window + 1):
            if first.setdefault(tuple(w[s:s + window]), d) < d:
                gone.update(range(s, s + window))
        want[d] = " ".join(x for i, x in enumerate(w) if i not in gone)
    got = remove_repeats(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), window)
    assert {r.row.doc_id: r.cut.kept for r in got.collect()} == want


def test_near_duplicates(spark, docs):
    got = {r.doc: r.class_id for r in near_duplicate_classes(docs).collect()}
    assert got == {1: 1, 2: 2, 3: 3, 5: 3, 7: 3, 9: 9, 11: 11, 12: 12}
    kept = stage(drop_near_duplicates(docs), "kept")
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "3", "3", "9", "11", "12", "None", "None"])
    assert near_duplicate_classes(docs.limit(0)).count() == 0


def test_decontamination(spark, docs):
    items = spark.createDataFrame([(1, " ".join(WORDS[50:70])), (2, "Two, THREE"), (2, None), (None, ""), (4, "end")], "item_id long, text string")
    got = {(r.row.doc_id, r.row.text): (r.n_words, sorted({i for h in r.hits for i in h["items"]})) for r in find_benchmark(docs, items).collect()}
    assert got[5, LONG] == (400, ["1"]) and got[7, "x " + LONG + " y"][1] == ["1"]
    assert got[9, "one two three"] == (3, ["2"]) and got[1, None] == (0, []) and got[12, DOCS[-1][1]][1] == ["4"]
    clean = drop_contaminated(docs, items)
    assert clean.columns == docs.columns and clean.count() == 4
    assert drop_contaminated(docs, items.limit(0)).count() == len(DOCS)
    assert find_benchmark(docs.limit(0), items).count() == 0


def test_near_phrases(spark):
    docs = spark.createDataFrame([(1, "alpha beta very gamma delta epsilon zeta eta theta iota kappa")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa")], "item_id long, text string")
    r = find_benchmark(docs, items, slop=2).first()
    assert not r.hits and len(r.near) == 1


def test_tokens(spark, docs):
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = encode_texts(docs, keep_ids=True, keep_decoded=True).collect()
    assert len(got) == len(DOCS)
    for r in got:
        ids = sp.encode(r.row.text or "")
        assert r.tokens.ids == ",".join(map(str, ids)) and r.tokens.decoded == sp.decode(ids) and r.tokens.n_differ == 0
    assert encode_texts(docs.limit(0)).count() == 0


def test_scores(spark, docs):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(20)] + [(None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    for model in (fit(docs, labels), None):
        got = score_documents(docs, model).collect()
        assert len(got) == len(DOCS) and all(0 <= r.score <= 1 for r in got)
    assert fit(docs, labels.limit(0)) is None and fit(docs.limit(0), labels) is None
    for chain in (fit_toxicity(docs, labels), fit_toxicity(docs.limit(0), labels.limit(0))):
        got = score_toxicity(docs, chain).collect()
        assert len(got) == len(DOCS) and all(0 <= v <= 1 for r in got for v in r.p)


def test_vectors(spark):
    rows = [(1, [1.0, 0.0]), (2, [2.0, 0.1]), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [float("nan"), 1.0]), (7, [float("inf"), 1.0]),
            (8, [None, 1.0]), (9, []), (None, [1.0, 0.0]), (10, [1.0, 0.0]), (10, [1.0, 0.0]), (11, [1.0, 0.0, 0.0]), (12, [3.0, 0.0, 0.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumnRenamed("x", "id")
    got = sorted((str(r.id), r.n_links, str(r.component_id)) for r in link_vectors(v).collect())
    assert got == sorted([("1", 3, "1"), ("2", 3, "1"), ("10", 3, "1"), ("10", 3, "1"), ("3", 0, "3"), ("4", 0, "4"), ("5", 0, "5"), ("6", 0, "6"),
                          ("7", 0, "7"), ("8", 0, "8"), ("9", 0, "9"), ("None", 0, "None"), ("11", 1, "11"), ("12", 1, "11")])
    assert link_vectors(v.limit(0)).count() == 0


def test_archives(spark, tmp_path):
    rows = [(3, "http://a\r\nb", "x\r\n\r\ny" * 3), (1, None, None), (2, "u", "x\r\n\r\ny" * 3), (2, "u", "x\r\n\r\ny" * 3), (None, "v", "x\r\n\r\ny" * 3),
            (4, "w", ""), (5, "big", "é\r\n" * 200_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    raw, target = str(tmp_path / "raw"), str(tmp_path / "warc")
    write_archives(pages, raw)
    index = normalise(spark, raw, target)
    got = sorted((str(r.record_id), r.warc_type, str(r.refers_to), r.declared_bytes, r.block_bytes) for r in read_archives(spark, target).collect())
    n = len(rows[0][2])
    assert got == sorted([("1", "response", "None", 0, 0), ("2", "response", "None", n, n), ("2", "response", "None", n, n), ("3", "revisit", "2", n, 0),
                          ("None", "revisit", "2", n, 0), ("4", "revisit", "1", 0, 0), ("5", "response", "None", 800_000, 800_000)])
    import glob
    import gzip
    import zlib

    for r in index.collect():  # each record can be read on its own from the file
        data = b"".join(open(f, "rb").read() for f in sorted(glob.glob(f"{target}/archive={r.archive}/part-*")))
        assert zlib.decompress(data[r.offset:r.offset + r.length], 31).startswith(b"WARC/1.1\r\nWARC-Type: " + r.warc_type.encode())
        assert gzip.decompress(data).count(b"WARC/1.1\r\n") >= 1
    write_archives(pages.limit(0), raw + "0")
    assert normalise(spark, raw + "0", target + "0").count() == 0
