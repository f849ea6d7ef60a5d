"""Search indexes against the exact forms: block index, rank by counting, bounded fusion, hashed k-NN."""
import random

import numpy as np
import pytest
from paths import SF_MID
from pyspark.sql import functions as F

from lakebank.operators import keyword_index, lsh, retrieval
from lakebank.sources import fixtures as FX


def rounded(df, *cols):
    return sorted(tuple(round(v, 7) if isinstance(v, float) else v for v in r) for r in df.select(*cols).collect())


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(40)]
    rows = [(i, " ".join(rng.choices(vocab, [1 / (j + 1) for j in range(40)], k=rng.randint(0, 30)))) for i in range(400)]
    rows += [(1000 + i, rows[7][1]) for i in range(60)] + [(2000, None), (2001, ""), (2002, " ,. ")]
    return spark.createDataFrame(rows, "id long, content string").repartition(3)


@pytest.fixture(scope="module")
def queries(spark):
    return spark.createDataFrame([(1, "w0 w3 w9"), (2, "W0, w0"), (3, "nothing here"), (4, None), (5, " ".join(f"w{i}" for i in range(40)))], "query_id long, query_text string")


@pytest.mark.parametrize("block_docs, k", [(7, 3), (50, 10), (1024, 1000)])
def test_block_index_gives_the_rows_of_the_whole_list(spark, corpus, queries, block_docs, k):
    search = keyword_index.Search(spark, keyword_index.build(corpus, block_docs=block_docs), queries)
    want = retrieval.keyword_topk(corpus, queries, k)
    assert rounded(search.topk(k), "query_id", "id", "rank", "score") == rounded(want, "query_id", "id", "rank", "score")


def test_blocks_below_the_floor_are_left_out(spark):
    rows = [(i, "common " * 3 + ("rare " * 5 if i < 10 else "filler " * 20)) for i in range(500)]
    docs = spark.createDataFrame(rows, "id long, content string").coalesce(1)
    asked = spark.createDataFrame([(1, "rare common")], "query_id long, query_text string")
    search = keyword_index.Search(spark, keyword_index.build(docs, block_docs=10), asked)
    kept = search.bounds.join(search.floors(3), "query_id").where("bound >= floor").count()
    assert kept < search.bounds.count() // 4
    assert [r.id for r in search.topk(3).orderBy("rank").collect()] == ["0", "1", "2"]


def test_ranks_are_those_of_the_whole_list(spark, corpus, queries):
    search = keyword_index.Search(spark, keyword_index.build(corpus, block_docs=20), queries)
    whole = {(r.query_id, r.id): r["rank"] for r in retrieval.keyword_topk(corpus, queries, None).collect()}
    hits = [(q, str(i)) for q in (1, 2, 3, 5) for i in (*range(0, 400, 9), 1003, 1059, 2000, 2001, 77777)]
    got = {(r.query_id, r.id): r["rank"] for r in search.ranks(spark.createDataFrame(hits, "query_id long, id string")).collect()}
    assert got == {h: whole[h] for h in hits if h in whole} and len(got) > 50


@pytest.mark.parametrize("k", [1, 3, 8])
def test_bounded_fusion_gives_the_rows_of_whole_lists(spark, corpus, queries, k):
    rng = random.Random(k)
    hits = [(q, str(i), r, 1.0 / r) for q in (1, 2, 3, 4) for r, i in enumerate(rng.sample(range(400), k), 1)]
    vector = spark.createDataFrame(hits, "query_id long, id string, rank long, score double")
    search = keyword_index.Search(spark, keyword_index.build(corpus, block_docs=20), queries)
    cols = ["query_id", "id", "rank", "vector_rank", "keyword_rank", "rrf_score"]
    want = retrieval.hybrid_topk(vector, retrieval.keyword_topk(corpus, queries, None), k, vector_depth=k)
    assert sorted(map(str, rounded(keyword_index.hybrid_topk(vector, search, k), *cols))) == sorted(map(str, rounded(want, *cols)))


def test_index_of_an_empty_corpus(spark, queries):
    empty = spark.createDataFrame([], "id long, content string")
    assert keyword_index.keyword_topk(empty, queries).collect() == []


def test_hashed_knn_recall(spark):
    docs, asked = FX.documents_index(spark, SF_MID), FX.search_queries(spark, SF_MID)
    want = {(r.query_id, r.id): r.score for r in retrieval.knn_topk(docs, asked, 10).collect()}
    got = {(r.query_id, r.id): r.score for r in lsh.knn_lsh(docs, asked, 10).collect()}
    assert len(set(want) & set(got)) >= 0.9 * len(want)
    assert all(got[p] == pytest.approx(want[p]) for p in set(want) & set(got))


def test_hashed_knn_with_copies_nulls_and_split_buckets(spark, monkeypatch):
    monkeypatch.setattr(lsh, "BLOCK_ROWS", 5)
    rng = np.random.default_rng(2)
    vecs = [(i, rng.standard_normal(8).tolist()) for i in range(200)]
    vecs += [(1000 + i, vecs[3][1]) for i in range(50)] + [(5000, None)]
    docs = spark.createDataFrame(vecs, "id long, content_vector array<double>")
    asked = spark.createDataFrame([(1, vecs[3][1]), (2, vecs[9][1]), (3, None)], "query_id long, query_vector array<double>")
    want = {(r.query_id, r["rank"]): r.id for r in retrieval.knn_topk(docs, asked, 4).collect()}
    # all buckets of each table probed: nothing can be missed
    got = {(r.query_id, r["rank"]): r.id for r in lsh.knn_lsh(docs, asked, 4, tables=2, bits=3, probes=8).collect()}
    assert got == want and len(got) == 8


def test_fusion_reads_all_blocks_once(spark, corpus, queries, monkeypatch):
    """The first pass asks for the hits' blocks alone; the second gives the top-k and the ranks together."""
    calls, score = [], keyword_index.Search.score
    monkeypatch.setattr(keyword_index.Search, "score", lambda self, asked, k: calls.append((asked.count(), k)) or score(self, asked, k))
    vector = spark.createDataFrame([(1, "5", 1, 0.9), (2, "9", 1, 0.8)], "query_id long, id string, rank long, score double")
    path = keyword_index.build(corpus, block_docs=20)
    search = keyword_index.Search(spark, path, queries)
    keyword_index.hybrid_topk(vector, search, 1).collect()
    assert len(calls) == 2 and calls[0] == (2, 0) and calls[1][1] == 2
    # lengths stand once per document, not once per posting
    assert spark.read.parquet(path).where("term is not null and size(dl) > 0").count() == 0


def test_documents_of_given_ids(spark):
    ids = spark.createDataFrame([("3",), ("7",), ("7",), ("no",)], "id string")
    whole = FX.documents_index(spark, SF_MID).where("id in ('3', '7')")
    assert sorted(map(str, FX.documents_index(spark, SF_MID, ids).collect())) == sorted(map(str, whole.collect()))
