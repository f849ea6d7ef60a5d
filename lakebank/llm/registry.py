"""Queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from lakebank.llm import langid, licenses, manifest, mixing, neardup, pagetext, phrases, pii, quality, search, sharding, tokens, urls


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_line_quality": quality.op1_line_quality,
    "op2_context_pii": pii.op2_context_pii,
    "op3_bpe": tokens.op3_bpe,
    "op4_impact_topk": search.op4_impact_topk,
    "op5_url_aliases": urls.op5_url_aliases,
    "op6_license_signatures": licenses.op6_license_signatures,
    "op7_mix_sources": mixing.op7_mix_sources,
    "op8_superminhash": neardup.op8_superminhash,
    "op9_kd_shards": sharding.op9_kd_shards,
    "op10_block_lstm": pagetext.op10_block_lstm,
    "op11_ppm_language": langid.op11_ppm_language,
    "op12_collocations": phrases.op12_collocations,
    "op13_merkle_manifest": manifest.op13_merkle_manifest,
    "pipeline": pipeline,
}

ORACLE = {
    "op4_impact_topk": search.ORACLE,
    "op5_url_aliases": urls.ORACLE,
    "op7_mix_sources": mixing.ORACLE,
    "op8_superminhash": neardup.ORACLE,
    "op12_collocations": phrases.ORACLE,
    "op13_merkle_manifest": manifest.ORACLE,
}
