"""A corpus pipeline: documents in, filtered, deduplicated, decontaminated, redacted and tokenised documents out.

``documents`` needs doc_id and text; other columns of any name and type are
carried along. NULL texts count as empty. Rows without id are documents of their
own; repeated rows stay together or go together. An empty table gives an empty
table in every stage. Texts may be of any length and are worked on whole.

Each stage takes (spark, docs, sf_dir), works on all documents that the stage
before kept, and returns a DataFrame; ``run`` stores each stage's result as
Parquet in the shared folder and hands the stored table to the next stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from regstar.llm import decontaminate, near_dedup, quality, secrets, sentencepieces
from regstar.llm.common import stage
from regstar.sources.tables import read_table

#: SQL can't express the trained classifier, the sampled signatures or the tokeniser.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; the rejected ones go.

    Rows of equal text get equal scores. Without a labelled positive nothing goes.
    """
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    if model is None:  # nothing to learn from: nothing is rejected
        return docs
    return quality.score_documents(docs, model).filter(F.col("score") >= quality.THRESHOLD).select("row.*")


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the smallest id, with all its rows.

    Rows without id, and texts without words, stay.
    """
    return near_dedup.drop_near_duplicates(docs)


def not_in_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs; those without words stay."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with secrets replaced in its text and ``n_chars`` counted again."""
    return secrets.redact(secrets.find_secrets(docs))


def tokenised(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with its ids, whose decoded text is checked by its digest.

    ``n_differ`` is the number of parts whose ids differ from the library's. A
    new column whose name a column of the documents has, in any case, gets ``_``
    behind it. The empty text has no ids.
    """
    t = sentencepieces.encode_texts(docs, keep_ids=True)
    ids = F.filter(F.split("tokens.ids", ","), lambda x: x != "")
    new = {"n_tokens": F.col("tokens.n_tokens"), "token_ids": F.transform(ids, lambda x: x.cast("int")), "ids_sha256": F.col("tokens.ids_sha256"),
           "decoded_sha256": F.col("tokens.decoded_sha256"), "n_differ": F.col("tokens.n_differ")}
    taken, named = {c.lower() for c in docs.columns}, []
    for name, value in new.items():
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        named.append(value.alias(name))
    return t.select("row.*", *named)


STAGES = [
    ("quality classifier", good_quality),
    ("near dedup", one_of_each_class),
    ("benchmark decontamination", not_in_benchmark),
    ("secret scan", without_secrets),
    ("sentencepiece", tokenised),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
