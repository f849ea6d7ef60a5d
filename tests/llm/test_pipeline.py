"""The pipeline's stages in order, each against what the operators decide."""

import hashlib

import helpers
import pytest

import __spark_entry__
import corpus_pipeline
from lakebank.llm import pii, quality, tokens


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    return helpers.folder(spark, tmp_path_factory.mktemp("pipeline"))


def test_stages_take_effect(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality rules", "MinHash near-dedup", "PII", "mixing sources to target weights", "byte-level BPE encoding and decoding"]
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = spark.createDataFrame(stage(spark, before, sf).collect(), docs.schema)
        assert after.columns == docs.columns
        if name == "quality rules":
            kept = {r.doc_id for r in quality.op1_line_quality(spark, sf).where("kept").collect()}
            assert {r.doc_id for r in after.collect()} == kept
        if name == "MinHash near-dedup":
            ids = [r.doc_id for r in after.collect() if r.doc_id is not None]
            assert len(ids) == len(set(ids)) < before.count()
        if name == "PII":
            assert pii.find(after).selectExpr("sum(n_email + n_ip + n_card + n_phone)").head()[0] in (0, None)
        before = after
    out = tokens.stage_tokens(spark, before, sf)
    texts = sorted(hashlib.sha256((r.text or "").encode()).hexdigest() for r in before.collect())
    assert sorted(r.decoded_sha256 for r in out.collect()) == texts
    assert all(len(r.ids) == r.n_tokens for r in out.collect())


def test_run_and_registration(spark, tmp_path):
    assert corpus_pipeline.run(spark, helpers.folder(spark, tmp_path / "none", [])).collect() == []
    names = __spark_entry__.queries()
    assert "pipeline" in names and all(any(q.startswith(f"op{n}_") for q in names) for n in range(1, 11))
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in __spark_entry__.oracle_sql()
