"""Corpus pipeline: the training-data operators in order, each stage written and read again.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it
kept; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakebank.llm import mixing, neardup, pii, quality, tokens
from lakebank.llm.common import stored, table

STAGES = [
    ("quality rules", quality.stage_quality),
    ("MinHash near-dedup", neardup.stage_dedup),
    ("PII", pii.stage_pii),
    ("mixing sources to target weights", mixing.stage_mix),
    ("byte-level BPE encoding and decoding", tokens.stage_tokens),
]

#: Labelling, iterative pattern scoring and tokenising are beyond SQL: tests/llm compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "stage")
    return STAGES[-1][1](spark, docs, sf_dir)
