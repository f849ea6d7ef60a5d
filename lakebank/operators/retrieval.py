"""Hybrid retrieval as Spark jobs: exact k-NN, BM25 keyword search, reciprocal
rank fusion, score fallback filter, context text and document upsert
(J3-J5, P18, G7, W5, W6, A11).

The reference calls a hosted search index one query at a time. Here a whole
query set is answered in one job:

* **k-NN (J3)**: corpus and queries are dealt into tiles; each pair of tiles is
  one co-group, scored with matrix products, and sends on k rows per query --
  no cross join, no all-pairs output, nothing collected or broadcast. A final
  ``row_number`` keeps k per query. ``lsh.knn_lsh`` is the approximate form.
* **BM25 (J4)**, in one pass for whole match lists (``keyword_index`` answers
  top-k queries and fuses by counting): documents are tokenised with built-in ``split``/``explode``;
  tokens are pruned to the query vocabulary (semi-join) before the term-frequency aggregate; document frequencies
  come from the same aggregate; query terms join postings on the term.
* **Fusion (J5)**: reciprocal rank fusion (Cormack, Clarke, Buettcher 2009),
  constant 60, over the vector list cut at ``top_k`` and the whole keyword list.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakebank.sources.tables import spread

# Fixed values from the reference.
TOP_K = 3
MIN_SCORE = 0.6
CONTEXT_HEADER = "--- Información de la base de conocimiento del banco ---"
CONTEXT_FOOTER = "--- Fin del contexto ---"
CONTEXT_ITEM = "\n[Fuente {i} | Relevancia: {score}]\n{content}"
# Published constants.
RRF_K = 60
BM25_K1, BM25_B = 1.2, 0.75
#: Rows of the tiles that meet in one task of the exact k-NN.
CORPUS_TILE, QUERY_TILE = 2048, 4096
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"


def _tile_topk(k: int, step: int = 256):
    """Co-group body: k best corpus rows of a tile for each of its queries, ``step`` queries at a time."""
    def run(corpus, queries):
        import pyarrow as pa

        out: list = [[], [], []]
        if corpus.num_rows and queries.num_rows:
            matrix = lambda t: np.array(t["vec"].to_pylist(), np.float64)
            ids = np.array(corpus["id"].to_pylist(), dtype=object)
            rank = np.empty(len(ids), np.int64)
            rank[np.argsort(ids, kind="stable")] = np.arange(len(ids))       # ties go by id, ranked once
            c, q, qids = matrix(corpus), matrix(queries), queries["query_id"].to_pylist()
            for a in range(0, len(q), step):
                scores = q[a:a + step] @ c.T
                keep = min(k, len(ids))
                least = -np.partition(-scores, keep - 1, axis=1)[:, keep - 1]
                for i, row in enumerate(scores):
                    near = np.flatnonzero(row >= least[i])
                    near = near[np.lexsort((rank[near], -row[near]))[:keep]]
                    out[0] += [qids[a + i]] * len(near)
                    out[1] += ids[near].tolist()
                    out[2] += row[near].tolist()
        return pa.Table.from_arrays([pa.array(out[0], queries.schema.field("query_id").type), pa.array(out[1], pa.string()),
                                     pa.array(out[2], pa.float64())], names=["query_id", "id", "score"])
    return run


def knn_topk(corpus: DataFrame, queries: DataFrame, k: int = TOP_K, id_col: str = "id",
             vec_col: str = "content_vector", qid_col: str = "query_id", qvec_col: str = "query_vector",
             corpus_tiles: int | None = None, query_tiles: int | None = None) -> DataFrame:
    """Exact k nearest corpus vectors per query by dot product (cosine on
    unit vectors). Output: query_id, rank, id, score.

    A task holds one corpus tile and one query tile: about CORPUS_TILE and
    QUERY_TILE rows by default, whatever the tables' sizes (two counts run).
    Queries are shuffled once per corpus tile, corpus rows once per query tile.
    """
    tiles = corpus_tiles or max(1, -(-corpus.count() // CORPUS_TILE))
    query_tiles = query_tiles or max(1, -(-queries.count() // QUERY_TILE))
    deal = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    c = corpus.filter(F.col(vec_col).isNotNull()).select(
        deal(F.col(id_col), tiles).alias("t"), each(query_tiles).alias("u"), F.col(id_col).cast("string").alias("id"), F.col(vec_col).alias("vec"))
    q = queries.filter(F.col(qvec_col).isNotNull()).select(
        each(tiles).alias("t"), deal(F.col(qid_col), query_tiles).alias("u"), F.col(qid_col).alias("query_id"), F.col(qvec_col).alias("vec"))
    schema = T.StructType([T.StructField("query_id", queries.schema[qid_col].dataType),
                           T.StructField("id", T.StringType()), T.StructField("score", T.DoubleType())])
    best = c.groupBy("t", "u").cogroup(q.groupBy("t", "u")).applyInArrow(_tile_topk(k), schema)
    return top_per_query(best, "score", k)


def top_per_query(df: DataFrame, score: str, k: int | None, qid: str = "query_id", id_col: str = "id") -> DataFrame:
    """Keep k rows per query by ``score`` desc, ``id`` asc; ``rank`` 1..k.

    ``row_number() <= k`` plans as WindowGroupLimit, partial before the
    shuffle, so a query matching every document ships k rows per map task."""
    w = Window.partitionBy(qid).orderBy(F.desc(score), F.asc(id_col))
    ranked = df.withColumn("__rn", F.row_number().over(w))
    return ((ranked if k is None else ranked.filter(F.col("__rn") <= k))
            .withColumn("rank", F.col("__rn").cast("long")).drop("__rn"))


def tokens(text: str) -> F.Column:
    """Lower-cased letter/digit runs of ``text`` (whole text, no prefix)."""
    return F.filter(F.split(F.lower(F.col(text)), TOKEN_SPLIT), lambda t: F.length(t) > 0)


def keyword_topk(corpus: DataFrame, queries: DataFrame, k: int | None = TOP_K, id_col: str = "id",
                 text_col: str = "content", qid_col: str = "query_id", qtext_col: str = "query_text",
                 k1: float = BM25_K1, b: float = BM25_B) -> DataFrame:
    """BM25 top-k documents per query (``k`` None: all that match). Output: query_id, rank, id, score, raw_score.

    One tokenising pass: ``split`` + ``explode`` with a codegen'd empty-token
    filter; the document length comes from the same split array. Tokens are
    pruned to the query vocabulary (broadcast semi-join) before the
    (doc, term) aggregate; document frequency is aggregated from the same
    postings (the postings exchange is reused, not recomputed).
    """
    qt = (queries.select(F.col(qid_col).alias("query_id"), F.explode(tokens(qtext_col)).alias("term"))
          .distinct())
    # broadcast or shuffled as the planner measures it
    vocab_side = qt.select("term").distinct()
    # ids keep their stored type through explode / join / aggregate (cheap
    # hashing of bigint ids); they become strings only for the final ranking
    docs = spread(corpus.select(F.col(id_col).alias("id"), F.col(text_col).alias("t0"))).select(
        "id", F.lower("t0").alias("t"))
    # token count from the split array itself: with limit -1, empty strings
    # only appear first (leading separator) and last (trailing separator)
    toks = F.split("t", TOKEN_SPLIT)
    n_tok = (F.size("toks") - F.when(F.get("toks", 0) == "", 1).otherwise(0)
             - F.when((F.size("toks") > 1) & (F.element_at("toks", -1) == ""), 1).otherwise(0))
    per_doc = docs.select("id", toks.alias("toks")).select("id", "toks", n_tok.alias("dl"))
    stats = per_doc.agg(F.count(F.lit(1)).alias("n"), F.avg("dl").alias("avgdl"))
    n_docs, avgdl = stats.select("n").scalar(), stats.select("avgdl").scalar()
    # explode_outer: plain explode makes Catalyst infer size(split(..)) > 0 and
    # push it below the repartition into the scan, re-tokenising on one task
    post = (per_doc.select("id", "dl", F.explode_outer("toks").alias("term"))
            .filter(F.col("term") != "")
            .join(vocab_side, "term", "left_semi")                  # prune to query vocabulary
            .groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf"), F.max("dl").alias("dl")))
    # counts (id, term) rows; the predicate keeps tf and dl in this branch so
    # both branches share one postings aggregate (exchange reuse)
    dfreq = post.groupBy("term").agg(
        F.count(F.when((F.col("tf") > 0) & (F.col("dl") >= 0), F.lit(1))).alias("df"))
    idf = F.log(F.lit(1.0) + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    tf = F.col("tf").cast("double")
    norm = tf + k1 * (1 - b + b * F.col("dl") / avgdl)
    scored = (post.join(dfreq, "term").join(qt, "term")
              .withColumn("s", idf * tf * (k1 + 1) / norm)
              .groupBy("query_id", "id").agg(F.sum("s").alias("raw_score"))
              .withColumn("id", F.col("id").cast("string"))
              # rank on 9 decimals: exact copies of a document tie despite float summation order
              .withColumn("score", F.round("raw_score", 9)))
    return top_per_query(scored, "score", k)


def hybrid_topk(vector_hits: DataFrame, keyword_hits: DataFrame, k: int = TOP_K,
                rrf_k: int = RRF_K, vector_depth: int | None = TOP_K, keyword_depth: int | None = None) -> DataFrame:
    """Reciprocal rank fusion of two ranked lists, full outer join on
    (query, id), top-k by fused score. The vector list counts to
    ``vector_depth`` (the search asks for k neighbours), the keyword list to
    ``keyword_depth`` (None: to its end)."""
    vector_hits = vector_hits if vector_depth is None else vector_hits.filter(F.col("rank") <= vector_depth)
    keyword_hits = keyword_hits if keyword_depth is None else keyword_hits.filter(F.col("rank") <= keyword_depth)
    v = vector_hits.select("query_id", "id", F.col("rank").alias("vector_rank"),
                           F.col("score").alias("vector_score"))
    kw = keyword_hits.select("query_id", "id", F.col("rank").alias("keyword_rank"),
                             F.col("score").alias("keyword_score"))
    j = v.join(kw, ["query_id", "id"], "full_outer")
    rrf = (F.coalesce(1.0 / (rrf_k + F.col("vector_rank")), F.lit(0.0))
           + F.coalesce(1.0 / (rrf_k + F.col("keyword_rank")), F.lit(0.0)))
    return top_per_query(j.withColumn("rrf_score", rrf), "rrf_score", k)


def score_fallback_filter(hits: DataFrame, rerank: str = "reranker_score", base: str = "search_score",
                          min_score: float = MIN_SCORE) -> DataFrame:
    """score = reranker score, or the base score when that is null or 0;
    keep hits with score >= min_score."""
    s = F.coalesce(F.nullif(F.col(rerank), F.lit(0.0)), F.col(base), F.lit(0.0))
    return hits.withColumn("score", s).filter(F.col("score") >= min_score)


def rag_context(hits: DataFrame, queries: DataFrame, content: str = "content", qid: str = "query_id") -> DataFrame:
    """Per query, number the kept hits 1..n in rank order, print the score
    with two decimals, wrap in header and footer; empty text without hits.
    Each query collects at most top-k hits (bounded)."""
    w = Window.partitionBy(qid).orderBy("rank")
    h = hits.withColumn("pos", F.row_number().over(w))
    body = F.regexp_replace(F.col(content), r"^\s+|\s+$", "")
    fmt = CONTEXT_ITEM.replace("{i}", "%d").replace("{score}", "%s").replace("{content}", "%s")
    item = F.format_string(fmt, F.col("pos"), F.format_number(F.col("score"), 2), body)
    g = (h.groupBy(qid).agg(F.sort_array(F.collect_list(F.struct("pos", item.alias("t")))).alias("items")))
    text = F.concat_ws("\n", F.lit(CONTEXT_HEADER), F.concat_ws("\n", F.transform("items", lambda x: x["t"])),
                       F.lit(CONTEXT_FOOTER))
    return (queries.select(qid).distinct().join(g, qid, "left")
            .select(qid, F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_hits"),
                    F.when(F.col("items").isNull(), F.lit("")).otherwise(text).alias("context")))


def doc_upsert(target: DataFrame, batch: DataFrame, key: str = "id", seq: str = "_seq") -> DataFrame:
    """Insert or replace documents by id; duplicate ids within the batch
    resolve to the highest ``seq`` (latest wins); ``chunk_id`` = id.

    The batch is reduced with ``max_by`` (map-side partial), then the target
    is anti-joined against it -- AQE broadcasts the batch when its measured
    size is small, so the large target is not shuffled -- and unioned.
    """
    cols = [c for c in target.columns]
    payload = [c for c in cols if c != key]
    latest = (batch.groupBy(key).agg(F.max_by(F.struct(*[c for c in batch.columns if c not in (key, seq)]),
                                              F.col(seq)).alias("__r"))
              .select(key, "__r.*").withColumn("chunk_id", F.col(key)))
    for c in payload:
        if c not in latest.columns:
            latest = latest.withColumn(c, F.lit(None).cast(target.schema[c].dataType))
    kept = target.join(latest.select(key), key, "left_anti")
    return kept.unionByName(latest.select(*cols))
