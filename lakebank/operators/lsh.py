"""Approximate k-NN by bucketed random projections with multi-probe and exact rescoring (J3, large corpora)."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakebank.operators.retrieval import TOP_K, _tile_topk, top_per_query
from lakebank.sources.sinks import checkpoint_table

#: Hash tables, buckets probed per table and query, and rows of a bucket that one task scores.
TABLES, PROBES, BLOCK_ROWS = 16, 24, 8192


def planes(dim: int, tables: int, bits: int, seed: int):
    """Normals of the hyperplanes, (tables, bits, dim): the same for every run of a seed."""
    return np.random.default_rng(seed).standard_normal((tables, bits, dim))


def probe_masks(margins, probes: int):
    """Per row the ``probes`` sets of bits (as masks, none first) whose flipping crosses the nearest hyperplanes."""
    bits = margins.shape[1]
    sets = (np.arange(1 << bits)[:, None] >> np.arange(bits)) & 1
    return np.argsort(margins**2 @ sets.T, axis=1, kind="stable")[:, :probes]


def bucket_keys(df: DataFrame, key: str, vec: str, tables: int, bits: int, probes: int, seed: int) -> DataFrame:
    """(key, vec, table, bucket): ``probes`` buckets per table of every vector (1: its own alone). Null vectors have none."""
    types = df.select(key, vec).schema
    schema = T.StructType([T.StructField(key, types[key].dataType), T.StructField("vec", types[vec].dataType),
                           T.StructField("table", T.IntegerType()), T.StructField("bucket", T.IntegerType())])

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                x = np.array(part.column(1).to_pylist(), np.float64)
                normals = planes(x.shape[1], tables, bits, seed)
                row = np.repeat(np.arange(len(x)), probes)
                for t in range(tables):
                    margin = x @ normals[t].T
                    own = (margin > 0) @ (1 << np.arange(bits))
                    near = own[:, None] ^ probe_masks(margin, probes) if probes > 1 else own[:, None]
                    yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row)), part.column(1).take(pa.array(row)),
                                                      pa.array(np.full(len(row), t, np.int32)), pa.array(near.ravel().astype(np.int32))], names=schema.names)

    return df.where(F.col(vec).isNotNull()).select(key, vec).mapInArrow(run, schema)


def knn_lsh(corpus: DataFrame, queries: DataFrame, k: int = TOP_K, id_col: str = "id", vec_col: str = "content_vector",
            qid_col: str = "query_id", qvec_col: str = "query_vector", tables: int = TABLES, bits: int | None = None,
            probes: int = PROBES, seed: int = 17) -> DataFrame:
    """Nearly the k nearest vectors per query by dot product: query_id, rank, id, score. Scores are exact.

    Every corpus vector lies in one bucket of each table, the signs of its
    products with random vectors; a query looks into the ``probes`` buckets of
    each table that it lies in or nearest to. Queries meet corpus rows by
    (table, bucket); what meets is scored exactly and sends on k rows per query.
    Recall grows with ``tables`` and ``probes``, the share of the corpus that is
    scored falls with ``bits``: by default as many as leave about eight rows a
    bucket (from the corpus' count), between 4 and 14.

    Equal vectors tie, so only the k smallest ids of each go on: a group of
    copies, however large, is one small bucket entry. A bucket of many different
    vectors is split into blocks of about BLOCK_ROWS rows, which its queries
    visit one by one; nothing is left out.
    """
    bits = bits or max(4, min(14, corpus.count().bit_length() - 4))
    probes = min(probes, 1 << bits)
    same = Window.partitionBy("vec").orderBy("id")
    rows = corpus.select(F.col(id_col).cast("string").alias("id"), F.col(vec_col).alias("vec")).where("vec is not null")
    rows = rows.withColumn("copy", F.row_number().over(same)).where(F.col("copy") <= k).select("id", "vec")
    held = checkpoint_table(bucket_keys(rows, "id", "vec", tables, bits, 1, seed), "lsh_rows")
    probed = bucket_keys(queries.select(F.col(qid_col).alias("query_id"), F.col(qvec_col).alias("qvec")), "query_id", "qvec", tables, bits, probes, seed)
    # at most tables * 2^bits rows, whatever the corpus
    blocks = checkpoint_table(held.groupBy("table", "bucket").agg(F.ceil(F.count("*") / F.lit(BLOCK_ROWS)).alias("blocks")), "lsh_buckets")
    c = held.join(blocks, ["table", "bucket"]).select("table", "bucket", F.pmod(F.xxhash64("id"), "blocks").alias("block"), "id", "vec")
    q = probed.join(blocks, ["table", "bucket"]).select(F.col("table").alias("t"), F.col("bucket").alias("b"),
                                                       F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("o"), "query_id", F.col("vec"))
    schema = T.StructType([T.StructField("query_id", queries.schema[qid_col].dataType), T.StructField("id", T.StringType()), T.StructField("score", T.DoubleType())])
    best = c.groupBy("table", "bucket", "block").cogroup(q.groupBy("t", "b", "o")).applyInArrow(_tile_topk(k), schema)
    # a pair found in several tables has one score up to float order
    once = best.groupBy("query_id", "id").agg(F.max("score").alias("score"))
    return top_per_query(once, "score", k)
