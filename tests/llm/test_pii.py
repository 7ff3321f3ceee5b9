"""Personal data against plain regular expressions, and disclosing terms on a small corpus."""

import random
import re

import pytest
from pyspark.sql import functions as F

from regstar.llm.pii import KINDS, base_spans, find_pii, luhn

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
PIECES = ["a", "b.c", "@", "@@", "x@y.z", ".", "..", "1", "12", "255", "256", "10.0.0.1", "4111 1111 1111 1111", "4111-1111-1111-1111", "+1 (202) 555-0143",
          "+", "-", " ", "(", "\n", "é", "🙂", "_%+", "00000", "1.2.3.4.5.6.7.8", "a@b", "@c.d"]


def plain(t):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(t) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(t):
        d = re.sub("[^0-9]", "", m.group())
        if 12 <= len(d) <= 19 and luhn(d):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(t) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return sorted(out)


def test_base_spans_equal_plain_searches():
    rng = random.Random(8)
    for _ in range(5000):
        t = "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14)))
        assert base_spans(t) == plain(t), t


def test_long_runs_take_no_time():
    assert base_spans("a" * 300_000 + " " + "1" * 300_000 + "x") == []


def test_terms_that_give_an_entity_away(spark):
    rng = random.Random(1)
    filler = [f"word{i}" for i in range(60)]
    noise = lambda n: " ".join(rng.choice(filler) for _ in range(n))
    rows = [(i, f"{noise(12)} Zebulon wrote {noise(2)} zeb@example.org {noise(12)}") for i in range(6)]
    rows += [(i, noise(30)) for i in range(6, 200)]
    rows += [(200, None), (201, ""), (None, "call zeb@example.org zebulon"), (3, rows[3][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = find_pii(docs, keep_clean=True).select("row.doc_id", "row.text", "pii.*").collect()
    assert len(got) == len(rows)
    for r in got:
        base = plain(r.text or "")
        assert r.base == ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in base)
        assert list(r.counts) == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert set(r.base.split(",")) <= set(r.spans.split(","))
        if base:
            assert "zeb" not in r.clean.lower() and "[EMAIL]" in r.clean
        else:
            assert r.clean == (r.text or "") and not r.spans
    assert find_pii(docs.limit(0)).count() == 0


def test_terms_of_an_entity_that_stands_once(spark):
    rng = random.Random(2)
    noise = lambda n: " ".join(f"word{rng.randrange(60)}" for _ in range(n))
    rows = [(0, f"Zebulon {noise(40)} zeb@example.org {noise(3)} Qi {noise(40)}"), (1, f"Yolanda {noise(30)}")]
    rows += [(i, noise(40)) for i in range(2, 300)]
    # all copies of one passage: the entity has one context
    rows += [(i, f"Xenia word1 +1 (202) 555-0143 word2") for i in range(300, 304)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in find_pii(docs, keep_clean=True).select("row.doc_id", "row.text", "pii.*").collect()}
    assert got[0].clean == re.sub("Zebulon|Qi", "", got[0].text.replace("zeb@example.org", "[EMAIL]"))
    assert all(got[i].clean == " word1 [PHONE] word2" for i in range(300, 304))
    assert got[1].clean == got[1].text and not got[1].spans


def test_usual_rare_words_stay(spark):
    """Every document has rare words of its own; only a name that follows its entity through other texts gives it away."""
    rng = random.Random(3)
    noise = lambda i, n: " ".join([f"word{rng.randrange(60)}" for _ in range(n)] + [f"rare{i}x{k}" for k in range(4)])
    rows = [(i, f"{noise(i, 20)} Zebulon {noise(-i, 5)} zeb@example.org {noise(1000 + i, 9)}") for i in range(1, 7)]
    rows += [(7, f"Yolanda {noise(7, 20)} yo@example.org {noise(1007, 9)}")]
    rows += [(i, f"{noise(i, 20)} {noise(-i, 5)} {noise(1000 + i, 9)}") for i in range(8, 300)]
    # near copies: their common rare words have one context
    rows += [(400 + i, f"word{i} quaint old words {rows[20][1]} call +1 (202) 555-0143 now and then") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for r in find_pii(docs).select("row.doc_id", "row.text", "pii.spans").collect():
        terms = [r.text[int(s):int(e)] for k, s, e in (x.split(":") for x in r.spans.split(",") if x) if k == "term"]
        assert terms == ["Zebulon"] * (1 <= r.doc_id <= 6), (r.doc_id, terms)


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_few_words_of_documents_with_entities_are_touched(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet").select("doc_id", "text")
    words = F.size(F.split("row.text", r"\W+"))
    terms = F.size(F.filter(F.split("pii.spans", ","), lambda x: x.startswith("term:")))
    touched, of = find_pii(docs).filter("pii.base <> ''").select(terms.alias("t"), words.alias("w")).agg(F.sum("t"), F.sum("w")).first()
    assert touched <= 0.05 * of, (touched, of)
