"""The classifier chain: what it learns must not depend on how many rows are drawn."""

import math
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from conftest import SF_SMALL
from regstar.llm import toxicity
from regstar.sources.tables import read_table


def test_lowered_caps_leave_predictions_about_the_same(spark, monkeypatch):
    rng = random.Random(4)
    words = [f"word{i}" for i in range(40)]

    def text(toxic):
        # "grim" stands in most toxic and some other rows, so it decides nothing alone
        has = rng.random() < (0.7 if toxic else 0.1)
        return " ".join([rng.choice(words) for _ in range(8)] + ["grim"] * has)

    marks = [int(rng.random() < 0.08) for _ in range(6000)]
    docs = spark.createDataFrame([(i, text(m)) for i, m in enumerate(marks)], "doc_id long, text string")
    labels = spark.createDataFrame(list(enumerate(marks)), "doc_id long, toxic int")

    def scores():
        p = toxicity.score_documents(docs, toxicity.fit(docs, labels)).filter(toxicity.held_out(F.col("row.doc_id")))
        return p.agg(F.avg("p.toxic"), F.avg((F.col("p.toxic") >= toxicity.THRESHOLD).cast("int"))).first()

    mean, marked = scores()
    monkeypatch.setattr(toxicity, "MOST_TOXIC", 300)
    monkeypatch.setattr(toxicity, "MOST_OTHER", 300)
    lowered_mean, lowered_marked = scores()
    assert abs(mean - 0.08) < 0.03
    assert abs(lowered_mean - mean) < 0.04 and abs(lowered_marked - marked) < 0.08, (mean, marked, lowered_mean, lowered_marked)


def test_kinds_are_the_groups_of_words_that_stand_together(spark, monkeypatch):
    seen = []
    plain = toxicity.fit_chain
    monkeypatch.setattr(toxicity, "fit_chain", lambda doc, slot, y, *rest: (seen.append(y.sum(axis=0).tolist()), plain(doc, slot, y, *rest))[1])
    rng = random.Random(6)
    groups = [["vile", "rotten", "crude"], ["strike", "punch"], ["sneer", "mock"]]

    def text(i):
        words = [rng.choice(["plain", "quiet", "window", "garden", "letter"]) for _ in range(8)]
        if i < 180:  # marked: of the first kind 90, of the second 60, of the third 30
            words += groups[0 if i < 90 else 1 if i < 150 else 2]
        return " ".join(words)

    docs = spark.createDataFrame([(i, text(i)) for i in range(900)], "doc_id long, text string")
    labels = docs.selectExpr("doc_id", "cast(doc_id < 180 as int) as toxic")
    kept = [r.doc_id for r in labels.filter(~toxicity.held_out(F.col("doc_id")) & F.col("toxic").eqNullSafe(1)).collect()]
    chain = toxicity.fit(docs, labels)
    assert seen == [[sum(i < 90 for i in kept), sum(90 <= i < 150 for i in kept), sum(i >= 150 for i in kept), len(kept)]]
    for r in toxicity.score_documents(docs, chain).filter(toxicity.held_out(F.col("row.doc_id"))).collect():
        i, p = r.row.doc_id, r.p
        assert [p.kind_1 > 0.5, p.kind_2 > 0.5, p.kind_3 > 0.5, p.toxic > 0.5] == [i < 90, 90 <= i < 150, 150 <= i < 180, i < 180]


def made_rows(n, words, seed):
    """Rows with one of many words of two sides; the first label is the side, the second a part of it, with errors."""
    rng = np.random.default_rng(seed)
    side = rng.random(n) < 0.5
    slot = np.where(side, rng.integers(0, words, n), words + rng.integers(0, words, n))
    flip = rng.random(n) < 0.35
    return np.arange(n), slot.astype(np.int64), np.stack([side, np.where(flip, rng.random(n) < 0.5, side)], axis=1)


def log_loss(p, y):
    return -np.mean(np.log(np.where(y, p, 1 - p)))


def conjunctions(n, seed):
    """Rows with none, one or many of 40 words (the first label: any), which are marked if they have another word too."""
    rng = np.random.default_rng(seed)
    many = rng.choice([0, 1, 14], n, p=[0.5, 0.25, 0.25])
    with_b = rng.random(n) < 0.5
    pairs = [(i, w) for i in range(n) for w in [*sorted(rng.choice(40, many[i], replace=False).tolist()), *([99] if with_b[i] else [])]]
    doc, slot = np.array(pairs, dtype=np.int64).T
    return doc, slot, np.stack([many > 0, (many > 0) & with_b], axis=1)


def test_chain_beats_a_link_without_earlier_links_on_held_out_rows():
    doc, slot, y = conjunctions(1200, 1)
    fold, weight = np.arange(len(y)) % toxicity.FOLDS, np.ones(len(y))
    chain = toxicity.fit_chain(doc, slot, y, fold, weight)
    alone = toxicity.fit_link(doc, slot, np.ones(len(y), bool), np.zeros((len(y), 0)), y[:, 1], weight)
    doc, slot, y = conjunctions(3000, 2)
    first = toxicity.predict(chain[0], doc, slot, len(y), np.zeros((len(y), 0)))
    chained = toxicity.predict(chain[1], doc, slot, len(y), toxicity._logit(first)[:, None])
    without = toxicity.predict(alone, doc, slot, len(y), np.zeros((len(y), 0)))
    assert log_loss(chained, y[:, 1]) < 0.8 * log_loss(without, y[:, 1])


def test_a_link_is_near_the_optimum_that_newton_steps_find():
    doc, slot, y = made_rows(800, 10, 3)
    weight = np.where(y[:, 1], 3.0, 1.0)
    link = toxicity.fit_link(doc, slot, np.ones(len(y), bool), np.zeros((len(y), 0)), y[:, 1], weight)
    x = np.hstack([slot[:, None] == np.arange(20), np.ones((len(y), 1))]).astype(float)
    share, w = weight / weight.sum(), np.zeros(21)
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ w))
        w -= np.linalg.solve((x.T * (share * p * (1 - p))) @ x + 1e-4 * np.eye(21), x.T @ (share * (p - y[:, 1])) + 1e-4 * w)
    best = -np.sum(share * np.log(np.where(y[:, 1], 1 / (1 + np.exp(-x @ w)), 1 / (1 + np.exp(x @ w)))))
    p = toxicity.predict(link, doc, slot, len(y), np.zeros((len(y), 0)))
    assert -np.sum(share * np.log(np.where(y[:, 1], p, 1 - p))) < best + 0.005


def test_query_equals_a_plain_loop_over_words(spark):
    """op4's probabilities, from the fitted weights and a loop over each document's words."""
    docs, labels = (read_table(spark, SF_SMALL, t) for t in ("documents", "labels"))
    chain = toxicity.fit(docs, labels)
    weights = [dict(zip(link.slots.tolist(), link.weights.tolist(), strict=True)) for link in chain]
    slots = {}

    def slots_of(word):
        if word not in slots:
            slots[word] = set(toxicity.word_slots(pa.array([word]))[1].tolist())
        return slots[word]

    got = {r.doc_id: r for r in toxicity.op4_toxicity(spark, SF_SMALL).collect()}
    assert len(got) == docs.count()
    for d in docs.collect():
        has = set().union(*map(slots_of, set(re.findall("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", d.text or ""))))
        odds = []
        for link, w in zip(chain, weights, strict=True):
            z = link.bias + sum(w.get(s, 0.0) for s in has) + sum(a * b for a, b in zip(odds, link.earlier, strict=True))
            p = 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
            q = min(max(p, 1e-3), 1 - 1e-3)
            odds.append(math.log(q / (1 - q)))
        assert abs(got[d.doc_id].score - p) < 1e-6 and got[d.doc_id].predicted == (p >= toxicity.THRESHOLD)
