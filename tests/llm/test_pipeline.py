"""The pipeline stage by stage against what each operator's plain version keeps."""

import pytest

import corpus_pipeline
from conftest import SF_SMALL
from regstar.sources.tables import read_table


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = read_table(spark, SF_SMALL, "documents"), []
    for name, step in corpus_pipeline.STAGES:
        done = corpus_pipeline.stage(step(spark, docs, SF_SMALL), "test-stage")
        out.append((name, docs, done))
        docs = done
    return out


def test_every_stage_but_the_last_keeps_the_columns(stages):
    for _, before, after in stages[:-1]:
        assert after.dtypes == before.dtypes
    assert stages[-1][2].columns[:5] == stages[-1][1].columns


def test_rows_only_leave(stages):
    for _, before, after in stages:
        a, b = {r.doc_id for r in after.select("doc_id").collect()}, {r.doc_id for r in before.select("doc_id").collect()}
        assert a <= b and a
    for _, before, after in stages[3:]:
        assert before.count() == after.count()


def test_tokens_are_the_library_s(stages):
    import public_tokenizers
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for r in stages[-1][2].collect():
        assert r.token_ids == sp.encode(r.text)


def test_secrets_are_gone(stages):
    from regstar.llm.secrets import RULES, find_secrets

    assert find_secrets(stages[3][2], RULES).filter("size(spans) > 0").count() == 0
    assert stages[3][2].filter("n_chars <> length(text)").count() == 0


def test_odd_documents_pass_all_stages(spark):
    """Clashing names, NULLs, empty and very long texts, repeated rows, no rows."""
    prose = " ".join(f"The word{i} is here." for i in range(80))
    rows = [(1, prose), (2, prose + " and more"), (3, None), (4, ""), (5, None), (None, prose), (None, None), (6, "z" * 1_000_000 + " see http://x"),
            (7, "secret: " + "k" * 30 + " é漢 " + " ".join(f"w{i}" for i in range(99))), (7, "secret: " + "k" * 30 + " é漢 " + " ".join(f"w{i}" for i in range(99)))]
    names = ["n_tokens", "TOKEN_IDS", "ids_sha256", "decoded_sha256", "n_tokens_", "row", "t", "key", "doc", "score", "spans", "hits", "h", "ta", "bands"]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr(
        "*", "'en' AS lang", "'s' AS source", "length(text) AS n_chars", *[f"'{n}' AS `{n}`" for n in names])
    for step in (docs, docs.limit(0)):
        empty = step is not docs
        for name, fn in corpus_pipeline.STAGES:
            before = step
            step = corpus_pipeline.stage(fn(spark, step, SF_SMALL), "odd")
            if name != "sentencepiece":
                assert step.dtypes == before.dtypes, name
        assert step.columns == [*docs.columns, "n_tokens__", "token_ids_", "ids_sha256_", "decoded_sha256_", "n_differ"]
        assert empty == (step.count() == 0)
        assert step.filter("n_tokens <> 'n_tokens' or n_differ <> 0").count() == 0
