"""Toxicity categories by a chain of linear classifiers.

The chain's links are categories in order; each is a logistic model over words
of the text, their beginnings, and the probabilities of the categories before it. Those
probabilities are out-of-fold in training: a row's earlier probability comes
from a model that did not see the row, as it will be for new documents.

``labels.toxic`` marks documents and gives no categories, so these come from the
data: words that stand in marked rows far more often than in the others are
grouped by the rows that they share (spherical k-means), and a marked row is of a
kind if it has a word of that group. Rows may be of several kinds. The models see
every word, and the last link predicts the mark itself.
Training runs on the driver over bounded samples, whose rows weigh as many
labelled rows as they stand for, so the base rates are those of all labels; scoring is one pass over every
whole text in Arrow batches.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from regstar.llm import wordhash as wh
from regstar.llm.common import ship, text_of
from regstar.llm.quality import held_out
from regstar.sources.tables import read_table

#: Groups of telling words, the largest first, and the mark itself.
KINDS = ("kind_1", "kind_2", "kind_3")
CATEGORIES = (*KINDS, "toxic")
#: Words that are grouped at most, and how many standard errors their log odds are from 0 at least.
TELLING, LEAST_Z = 96, 3.5
GROUPING_ROUNDS = 20
THRESHOLD = 0.25
#: Labelled rows that the chain is fitted on, at most, by label.
MOST_TOXIC, MOST_OTHER = 5_000, 7_000
FOLDS = 4
#: Words that a link looks at, and how many training rows must have one.
WORDS, LEAST_ROWS = 768, 5
WORD_BITS = 22
#: Bytes of the beginnings of words that are features too: inflected and compound forms share them.
BEGINNINGS = (4, 5, 6)
STEPS, RATE, WEIGHT_DECAY = 250, 0.1, 1e-4


def word_slots(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(text, hashed word or beginning of a word) pairs of a string array, each once, in order."""
    w = wh.words_of(text, wh.NOT_ALNUM, wh.LOWER)
    doc = np.repeat(np.arange(len(text)), w.counts)
    docs, hashes = [doc], [w.hash]
    for most in BEGINNINGS:
        at, h = wh.beginnings(w, most, wh.LOWER, seed=100 + most)
        docs.append(doc[at])
        hashes.append(h)
    pairs = np.unique((np.concatenate(docs) << WORD_BITS) | (np.concatenate(hashes) >> np.uint64(64 - WORD_BITS)).astype(np.int64))
    return pairs >> WORD_BITS, pairs & ((1 << WORD_BITS) - 1)


@dataclass
class Link:
    slots: np.ndarray  # hashed words it looks at
    weights: np.ndarray
    earlier: np.ndarray  # weights of the earlier categories' log odds
    bias: float


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _logit(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-3, 1 - 1e-3)
    return np.log(p / (1 - p))


def _matrix(doc: np.ndarray, slot: np.ndarray, rows: int, slots: np.ndarray) -> np.ndarray:
    at = np.searchsorted(slots, slot)
    at[at == len(slots)] = 0
    hit = slots[at] == slot if len(slots) else np.zeros(len(slot), bool)
    x = np.zeros((rows, len(slots)), dtype=np.float32)
    x[doc[hit], at[hit]] = 1
    return x


def _rows_with(doc: np.ndarray, slot: np.ndarray, rows: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a mask that have each slot, and the sum of their weights."""
    n, total = np.zeros(1 << WORD_BITS, np.int32), np.zeros(1 << WORD_BITS)
    for v in np.unique(weight[rows]):  # one value per label
        part = np.bincount(slot[(rows & (weight == v))[doc]], minlength=1 << WORD_BITS)
        n += part
        total += v * part
    return n, total


def log_odds_z(doc: np.ndarray, slot: np.ndarray, rows: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Log odds of each slot between the rows of a mask with and without ``y``, in
    standard errors; 0 where too few rows have it."""
    weight = weight / weight[rows].mean()
    n1, n0 = weight[rows & y].sum(), weight[rows & ~y].sum()
    with_1, sum_1 = _rows_with(doc, slot, rows & y, weight)
    with_0, sum_0 = _rows_with(doc, slot, rows & ~y, weight)
    odds = np.log((sum_1 + 0.5) / (n1 + 1)) - np.log((sum_0 + 0.5) / (n0 + 1))
    z = odds / np.sqrt(1 / (with_1 + 0.5) + 1 / (with_0 + 0.5))
    z[with_1 + with_0 < LEAST_ROWS] = 0
    return z


def kinds_of(doc: np.ndarray, slot: np.ndarray, marked: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """(row, kind) marks: the marked rows that have a word of each group of telling words.

    Words that stand in the same marked rows are of one group. Kinds stand in the
    order of their rows, most first; with fewer words than kinds the last have no rows.
    """
    y = np.zeros((len(marked), len(KINDS)), dtype=bool)
    if not marked.any() or marked.all():
        return y
    z = log_odds_z(doc, slot, np.ones(len(marked), bool), marked, weight)
    words = np.argsort(-z, kind="stable")[:TELLING]
    words = np.sort(words[z[words] >= LEAST_Z])
    if not len(words):
        return y
    has = _matrix(doc, slot, len(marked), words)
    at = has[marked].T
    at = at / np.linalg.norm(at, axis=1, keepdims=True)
    # the word of most rows begins, then the word least like those chosen
    chosen = [int(np.argmax(has[marked].sum(axis=0)))]
    while len(chosen) < min(len(KINDS), len(words)):
        chosen.append(int(np.argmin((at @ at[chosen].T).max(axis=1))))
    centres = at[chosen]
    for _ in range(GROUPING_ROUNDS):
        group = np.argmax(at @ centres.T, axis=1)
        sums = np.stack([at[group == k].sum(axis=0) if (group == k).any() else centres[k] for k in range(len(centres))])
        centres = sums / np.linalg.norm(sums, axis=1, keepdims=True)
    for k in range(len(centres)):
        y[:, k] = marked & (has[:, group == k].sum(axis=1) > 0)
    return y[:, np.argsort(-y.sum(axis=0), kind="stable")]


def fit_link(doc: np.ndarray, slot: np.ndarray, rows: np.ndarray, earlier: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Link:
    """A logistic model from the weighted rows of a mask; words are chosen by their log odds among them."""
    z = np.abs(log_odds_z(doc, slot, rows, y, weight))
    slots = np.sort(np.argsort(-z, kind="stable")[:WORDS])
    slots = slots[z[slots] > 0]
    x = np.hstack([_matrix(doc, slot, len(y), slots)[rows], earlier[rows].astype(np.float32), np.ones((int(rows.sum()), 1), np.float32)])
    target, share = y[rows].astype(np.float32), (weight[rows] / weight[rows].sum()).astype(np.float32)
    w, m, v = (np.zeros(x.shape[1], np.float32) for _ in range(3))
    for step in range(1, STEPS + 1):
        g = x.T @ ((_sigmoid(x @ w) - target) * share) + WEIGHT_DECAY * w
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w = w - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    k = len(slots)
    return Link(slots, w[:k], w[k:-1], float(w[-1]))


def predict(link: Link, doc: np.ndarray, slot: np.ndarray, rows: int, earlier: np.ndarray) -> np.ndarray:
    z = np.full(rows, link.bias)
    if len(link.slots):
        at = np.searchsorted(link.slots, slot)
        at[at == len(link.slots)] = 0
        hit = link.slots[at] == slot
        z += np.bincount(doc[hit], weights=link.weights[at[hit]], minlength=rows)
    return _sigmoid(z + earlier @ link.earlier)


def fit_chain(doc: np.ndarray, slot: np.ndarray, y: np.ndarray, fold: np.ndarray, weight: np.ndarray) -> list[Link]:
    """One link per column of ``y``. A category without both kinds of rows keeps
    the constant probability of its rows."""
    links, earlier = [], np.zeros((len(y), 0))
    for k in range(y.shape[1]):
        target = y[:, k]
        if not target.any() or target.all():
            links.append(Link(np.zeros(0, np.int64), np.zeros(0), np.zeros(earlier.shape[1]), 30.0 if len(y) and target.all() else -30.0))
            out_of_fold = np.full(len(y), float(target.all()))
        else:
            links.append(fit_link(doc, slot, np.ones(len(y), bool), earlier, target, weight))
            out_of_fold = np.zeros(len(y))
            for f in range(FOLDS):
                rest = fold != f
                if target[rest].any() and not target[rest].all() and (~rest).any():
                    part = predict(fit_link(doc, slot, rest, earlier, target, weight), doc, slot, len(y), earlier)
                    out_of_fold[~rest] = part[~rest]
        earlier = np.hstack([earlier, _logit(out_of_fold)[:, None]])
    return links


def fit(docs: DataFrame, labels: DataFrame) -> list[Link]:
    """The chain from labelled rows that are not held out, at most the bounds above,
    chosen by a hash of the id, each weighing its label's rows over those drawn;
    without any, every probability is 0."""
    ship(docs.sparkSession)
    rest = labels.select(F.col("doc_id").alias("id"), "toxic").filter(
        F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("id"))).groupBy("id").agg(F.max("toxic").alias("toxic"))
    labelled = dict(rest.groupBy("toxic").count().collect())
    order = F.xxhash64("id")
    drawn = rest.filter("toxic = 1").orderBy(order).limit(MOST_TOXIC).unionByName(
        rest.filter("toxic = 0").orderBy(order).limit(MOST_OTHER))
    base = docs.select(F.col("doc_id").alias("id"), text_of("text").alias("t")).join(F.broadcast(drawn), "id")
    schema = pa.schema([("id", pa.int64()), ("toxic", pa.int32()), ("slots", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in wh.slices(big, 2):
                doc, slot = word_slots(b.column(2))
                lists = pa.ListArray.from_arrays(np.searchsorted(doc, np.arange(len(b) + 1)).astype(np.int32), pa.array(slot.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), lists], schema=schema)

    t = (base.select("id", F.col("toxic").cast("int").alias("toxic"), "t").mapInArrow(run, "id long, toxic int, slots array<int>")
         .dropDuplicates(["id"]).toArrow().sort_by("id").combine_chunks())
    n = len(t)
    if not n:
        return fit_chain(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, len(CATEGORIES)), bool), np.zeros(0, np.int64), np.zeros(0))
    lists = t["slots"].combine_chunks()
    size = np.diff(lists.offsets.to_numpy())
    doc, slot = np.repeat(np.arange(n, dtype=np.int32), size), lists.flatten().to_numpy()
    toxic = t["toxic"].to_numpy() == 1
    common = np.bincount(slot, minlength=1 << WORD_BITS)[slot] >= LEAST_ROWS  # the others can't be chosen
    doc, slot = doc[common], slot[common]
    fold = (wh.mix(t["id"].to_numpy().astype(np.int64).view(np.uint64)) % np.uint64(FOLDS)).astype(np.int64)
    of_toxic, of_other = (max(1.0, labelled.get(k, 0) / most) for k, most in ((1, MOST_TOXIC), (0, MOST_OTHER)))
    weight = np.where(toxic, of_toxic, of_other)
    y = np.hstack([kinds_of(doc, slot, toxic, weight), toxic[:, None]])
    return fit_chain(doc, slot, y, fold, weight)


def score_documents(docs: DataFrame, chain: list[Link], text_col: str = "text") -> DataFrame:
    """Each row as ``row`` with ``p``: a probability per category.

    NULL counts as the empty text, which gets the chain's biases. Repeated rows
    get equal results; extra columns of any name are carried in ``row``.
    """
    ship(docs.sparkSession)
    names = list(CATEGORIES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in wh.slices(big, 1):
                doc, slot = word_slots(b.column(1))
                earlier = np.zeros((len(b), 0))
                out = []
                for link in chain:
                    p = predict(link, doc, slot, len(b), earlier)
                    out.append(pa.array(p))
                    earlier = np.hstack([earlier, _logit(p)[:, None]])
                yield pa.RecordBatch.from_arrays([b.column(0), pa.StructArray.from_arrays(out, names=names)], names=["row", "p"])

    base = docs.select(F.struct("*").alias("row"), text_of(text_col).alias("t"))
    return base.mapInArrow(run, f"row {base.schema['row'].dataType.simpleString()}, p struct<{','.join(f'{c}:double' for c in names)}>")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document the probability of each category and whether it is toxic."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    s = score_documents(docs.select("doc_id", "text"), fit(docs, labels))
    return s.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"),
                    *[F.col(f"p.{c}").alias(f"p_{c}") for c in KINDS], F.col("p.toxic").alias("score"),
                    (F.col("p.toxic") >= THRESHOLD).cast("int").alias("predicted"))
