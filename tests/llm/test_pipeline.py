"""The pipeline's stages on their own inputs, against brute force where it says what must happen."""

import pytest
from pyspark.sql import functions as F
from conftest import AWKWARD, SF_SMALL

corpus_pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = [("input", docs)]
    for name, stage in corpus_pipeline.STAGES:
        from sitelens.llm.textops import staged

        docs = staged(stage(spark, docs, SF_SMALL), name)
        out.append((name, docs))
    return out


def test_columns(steps):
    assert all(d.columns == steps[0][1].columns for _, d in steps[:-1])
    assert [n for n, _ in steps[1:]] == ["language", "lines", "near_duplicates", "mix", "tokens"]


def test_language_keeps_clean_documents(steps):
    assert steps[1][1].count() == steps[0][1].count()


def test_one_document_of_each_group_stays(steps):
    from test_jaccard import expected

    rows = [(r["doc_id"], r["text"]) for r in steps[2][1].collect()]
    groups = {c for _, _, c in expected(rows, 5, 80)}
    assert {str(r["doc_id"]) for r in steps[3][1].collect()} == groups


def test_mix_repeats_whole_rows(steps):
    before = {tuple(r) for r in steps[3][1].collect()}
    after = [tuple(r) for r in steps[4][1].collect()]
    assert set(after) <= before and max(after.count(r) for r in set(after)) <= 3


def test_tokens(steps):
    import hashlib

    texts = {r["doc_id"]: r["text"] for r in steps[4][1].collect()}
    rows = steps[5][1].collect()
    assert len(rows) == steps[4][1].count()
    assert all(r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest() for r in rows)


def test_other_columns_keep_names_and_values(spark):
    names = ["lang_pred", "lang_score", "n_lines", "n_dropped", "size", "taken", "uses", "position", "words", "pass", "target", "_id",
             "_hash", "_text", "row", "component", "a.b"]
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").limit(40).select("*", *[F.concat(F.lit(n), F.col("doc_id")).alias(n) for n in names])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == docs.columns
        wrong = [f"`{n}` <> concat('{n}', doc_id)" for n in names]
        assert out.filter(" OR ".join(wrong)).isEmpty()


def test_awkward_rows_pass_every_stage(spark):
    rows = [(i, t, "aa" if n % 2 else "bb", "s" if n % 3 else None, len(t or "")) for n, (i, t) in enumerate(AWKWARD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").count() >= 0
        assert stage(spark, docs.limit(0), "").count() == 0
