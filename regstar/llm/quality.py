"""Quality classifier learnt from positive and unlabelled documents.

Trusted positives are documents labelled 1. Everything else is read as
unlabelled web text; label 0 is never used. The class prior (share of positives
in the unlabelled text) is estimated from the data, and a linear model over
hinge functions of surface features minimises the non-negative unbiased risk

    prior * E_p[l(g)] + max(0, E_u[l(-g)] - prior * E_p[l(-g)])

with the logistic loss, so that sigmoid(g) is a probability. Training runs on
the driver over bounded samples (``MOST_POSITIVES``, ``MOST_UNLABELLED`` rows of
``len(FEATURES)`` numbers); features and scores are DataFrame expressions over
every whole text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from regstar.llm.common import text_of
from regstar.sources.tables import read_table

#: Rows that the model is fitted on, at most (chosen by a hash of the id).
MOST_POSITIVES, MOST_UNLABELLED = 20_000, 40_000
THRESHOLD = 0.7
#: Quantiles of the unlabelled features at which a hinge bends.
KNOTS = (0.0, 0.05, 0.15, 0.3, 0.5, 0.7, 0.85, 0.95)
STEPS, RATE = 1500, 0.05
#: Weight decay is this over the number of positives: fewer rows, a stiffer model.
DECAY = 0.3
FOLDS = 3
#: Standard errors that are added to the bound of the class prior.
MARGIN = 0.25

#: Numbers of matches per word.
PATTERNS = {
    "capital_words": r"[A-Z]{2,}",
    "symbol_runs": r"[!#$%&*+/<=>@^_`|~{}\[\]\\]+",
    "short_words": r"(?<![^ \t-\r])[^ \t-\r]{1,3}(?![^ \t-\r])",
    "sentence_ends": r"[.?](?![^ \t-\r])",
    "digit_runs": r"[0-9]+",
    "lines": r"\n",
}
FEATURES = (*PATTERNS, "chars", "repeats", "stutter", "repeat_trend", "log_words")


def features(text: Column) -> Column:
    """An array of one struct of surface features; an empty text has zeros.

    One-element arrays with ``transform`` bind a value to a name: the words and
    the features are computed once, however often they are used.
    """
    w = F.array_remove(F.split(text, r"[ \t-\r]+", -1), "")
    return F.transform(F.array(F.struct(text.alias("t"), w.alias("w"))), _of)


def _of(b: Column) -> Column:
    t, w = b["t"], b["w"]
    n = F.greatest(F.size(w), F.lit(1)).cast("double")
    repeats = 1.0 - F.size(F.array_distinct(w)) / n
    stutter = F.size(F.filter(w, lambda x, i: x == F.get(w, i + 1))) / n
    out = {k: F.regexp_count(t, F.lit(p)) / n for k, p in PATTERNS.items()}
    out |= {"chars": F.least(F.length(t) / n, F.lit(40.0)), "repeats": repeats, "stutter": stutter,
            "repeat_trend": repeats / F.log(n + 2.0), "log_words": F.log(n)}
    return F.struct(*[out[k].cast("double").alias(k) for k in FEATURES])


@dataclass(frozen=True)
class Model:
    knots: np.ndarray  # (features, knots)
    scale: np.ndarray  # (features, knots)
    weights: np.ndarray  # (features, knots)
    bias: float
    prior: float

    def score(self, x: Column) -> Column:
        """Probability of label 1 from a struct of features."""
        g = F.lit(float(self.bias))
        for i, name in enumerate(FEATURES):
            for knot, weight, scale in zip(self.knots[i], self.weights[i], self.scale[i], strict=True):
                if weight:
                    g = g + F.greatest(x[name] - float(knot), F.lit(0.0)) * float(weight / scale)
        return 1.0 / (1.0 + F.exp(-F.greatest(F.least(g, F.lit(60.0)), F.lit(-60.0))))


def _design(x: np.ndarray, knots: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return (np.maximum(x[:, :, None] - knots[None], 0) / scale[None]).reshape(len(x), -1)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _descend(size: int, gradient) -> np.ndarray:
    """Adam from zero."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for step in range(1, STEPS + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def class_prior(p: np.ndarray, u: np.ndarray) -> float:
    """Share of positives among the unlabelled, from scores of both.

    For any threshold the unlabelled mass above it is at least prior times the
    positive mass above it, so the least ratio of the two bounds the prior from
    above; each mass gets a margin for its sample size.
    """
    cuts = np.quantile(p, np.linspace(0.02, 0.6, 40))
    above_p = np.array([(p >= c).mean() for c in cuts])
    above_u = np.array([(u >= c).mean() for c in cuts])
    margin_p, margin_u = MARGIN / np.sqrt(len(p)), MARGIN / np.sqrt(len(u))
    ratio = (above_u + margin_u * np.sqrt(above_u)) / np.maximum(above_p - margin_p * np.sqrt(above_p * (1 - above_p)), 1e-3)
    return float(np.clip(ratio.min(), 0.02, 0.98))


def train(p: np.ndarray, u: np.ndarray) -> Model:
    """The model for positive and unlabelled feature rows."""
    knots = np.quantile(u, KNOTS, axis=0).T
    scale = np.maximum(np.maximum(u.T[:, None, :] - knots[:, :, None], 0).std(axis=2), 1e-3)
    dp, du = _design(p, knots, scale), _design(u, knots, scale)
    dp, du = np.hstack([dp, np.ones((len(dp), 1))]), np.hstack([du, np.ones((len(du), 1))])

    decay = DECAY / len(dp)
    # Positives against unlabelled, for the prior only; scored out of fold, as a
    # model favours the positives it has seen.
    in_p, in_u = np.arange(len(dp)) % FOLDS, np.arange(len(du)) % FOLDS
    score_p, score_u = np.zeros(len(dp)), np.zeros(len(du))
    for fold in range(FOLDS if len(dp) >= FOLDS and len(du) >= FOLDS else 0):
        a, b = dp[in_p != fold], du[in_u != fold]
        w = _descend(dp.shape[1], lambda w, a=a, b=b: (b.T @ _sigmoid(b @ w)) / len(b) - (a.T @ _sigmoid(-(a @ w))) / len(a) + decay * w)
        score_p[in_p == fold], score_u[in_u == fold] = dp[in_p == fold] @ w, du[in_u == fold] @ w
    prior = class_prior(score_p, score_u)

    def risk(w: np.ndarray) -> np.ndarray:
        gp, gu = dp @ w, du @ w
        negative = np.logaddexp(0, gu).mean() - prior * np.logaddexp(0, gp).mean()
        pull_p = -(dp.T @ _sigmoid(-gp)) / len(dp)
        pull_n = (du.T @ _sigmoid(gu)) / len(du) - prior * (dp.T @ _sigmoid(gp)) / len(dp)
        if negative < 0:  # overfitted: step back along the negative part alone
            return -pull_n + decay * w
        return prior * pull_p + pull_n + decay * w

    w = _descend(dp.shape[1], risk)
    return Model(knots, scale, w[:-1].reshape(knots.shape), float(w[-1]), prior)


def held_out(id_col: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))), F.lit(4)) == 2


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """Model from bounded samples; None without labelled positives.

    Held-out rows take no part, as positives or as unlabelled text. The samples
    are the rows with the smallest hashes of their ids, so they do not depend on
    the order or the partitions of the tables.
    """
    rest = labels.select(F.col("doc_id").alias("id"), "quality").filter(F.col("id").isNotNull() & ~held_out(F.col("id")))
    positives = (rest.filter("quality = 1").select("id").distinct()
                 .orderBy(F.xxhash64("id")).limit(MOST_POSITIVES).withColumn("positive", F.lit(True)))
    d = docs.select(F.col("doc_id").alias("id"), text_of("text").alias("t"))
    share = min(1.0, MOST_UNLABELLED / max(1, d.count()))
    drawn = (F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 30)) < int(share * (1 << 30))) & ~held_out(F.col("id"))
    x = (d.join(F.broadcast(positives), "id", "left").filter(F.coalesce("positive", F.lit(False)) | drawn)
         .select("id", F.coalesce("positive", F.lit(False)).alias("positive"), drawn.alias("drawn"), F.inline(features(F.col("t"))))
         .toPandas())
    x = x.sort_values(["id", *FEATURES])
    values = x[list(FEATURES)].to_numpy(dtype=float)
    p, u = values[x.positive.to_numpy(dtype=bool)], values[x.drawn.fillna(False).to_numpy(dtype=bool)]
    return train(p, u) if len(p) and len(u) else None


def score_documents(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """Each row as ``row`` with its ``score``.

    The score is a function of the text alone. NULL counts as the empty text,
    which is scored like any other; without a model each score is 0.5. Repeated
    rows get equal scores; extra columns of any name are carried in ``row``.
    """
    base = docs.select(F.struct("*").alias("row"), text_of(text_col).alias("t"))
    if model is None:
        return base.select("row", F.lit(0.5).alias("score"))
    return base.select("row", F.transform(features(F.col("t")), model.score)[0].alias("score"))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract's row per document."""
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    s = score_documents(docs.select("doc_id", "text"), fit(docs, labels))
    return s.select("row.doc_id", held_out(F.col("row.doc_id")).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
