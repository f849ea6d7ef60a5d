"""Keyword index: BM25 search over blocks of documents, with block skipping, and bounded rank fusion.

The index is one table: a row per block of documents and word -- places of the
documents in the block and word counts as arrays, the number of documents, the
largest count and least length, and the length of one document that has the
largest count. A row without a word lists the block's ids and lengths. A block holds at most ``block_docs`` documents that lie in one task of
the build, so postings are never shuffled, and a word that most documents hold
is spread over all blocks.

A search never makes a row per (query, matching document). The block's largest
count and least length bound the score of any of its documents from above (a
WAND bound). From below, the document of largest count in each block has at
least its weight for that one word, so the k-th of these weights over the blocks
is a floor under the k-th score. Only blocks whose bound reaches the floor are
scored, once, where their postings meet the queries' words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakebank.operators.retrieval import BM25_B, BM25_K1, RRF_K, TOKEN_SPLIT, TOP_K, top_per_query
from lakebank.session import scratch_path
from lakebank.sources.sinks import checkpoint_table
from lakebank.sources.tables import spread

#: Documents of a block; queries whose words meet a block in one task.
BLOCK_DOCS, QUERY_TILE = 1024, 4096


def _words(text: Column) -> Column:
    """Words of a text; an empty string may stand first and last."""
    return F.split(F.lower(text), TOKEN_SPLIT)


def _postings(block_docs: int):
    """Arrow body: word arrays of documents -> postings rows, a block per ``block_docs`` documents."""
    def run(batches):
        from pyspark import TaskContext

        block = TaskContext.get().partitionId() << 33
        for batch in batches:
            for start in range(0, batch.num_rows, block_docs):
                part = batch.slice(start, block_docs)
                ids, toks = part.column(0), part.column(1)
                doc = np.repeat(np.arange(len(ids)), pc.fill_null(pc.list_value_length(toks), 0).to_numpy(zero_copy_only=False))
                words = pc.dictionary_encode(toks.flatten())
                code = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                real = pc.not_equal(words.dictionary, "").to_numpy(zero_copy_only=False).astype(bool)[code] if len(code) else np.zeros(0, bool)
                code, doc = code[real], doc[real]
                lengths = np.bincount(doc, minlength=len(ids))
                listed = np.where(pc.is_null(toks).to_numpy(zero_copy_only=False), -1, lengths)   # no text: no length
                pair, tf = np.unique(code * len(ids) + doc, return_counts=True)
                code, doc = pair // len(ids), pair % len(ids)
                at = np.flatnonzero(np.r_[True, code[1:] != code[:-1]]) if len(code) else np.zeros(0, int)
                n, dl, place = len(at), lengths[doc], np.int16 if block_docs <= 2**15 else np.int32
                # the last row lists the block's documents, also those without a word
                ends = pa.array(np.r_[at, len(code), len(code) + len(ids)].astype(np.int32))
                lists = lambda x, y, kind=np.int32: pa.ListArray.from_arrays(ends, pa.array(np.r_[x, y].astype(kind)))  # noqa: E731, B023
                last = pa.array(np.r_[np.zeros(n + 1), len(ids)].astype(np.int32))
                most = lambda f, x: pa.array(np.r_[f.reduceat(x, at) if n else [], 0].astype(np.int32))  # noqa: E731, B023
                top = np.lexsort((dl, -tf, code))[at]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(n + 1, block)), pa.concat_arrays([words.dictionary.take(pa.array(code[at])).cast(pa.string()), pa.nulls(1, pa.string())]),
                    pa.ListArray.from_arrays(last, ids), lists(doc, np.arange(len(ids)), place), lists(tf, np.zeros(len(ids))),
                    pa.ListArray.from_arrays(last, pa.array(listed.astype(np.int32))), most(np.maximum, tf), most(np.minimum, dl),
                    pa.array(np.r_[dl[top], 0].astype(np.int32)), pa.array(np.diff(ends.to_numpy())),
                ], names=["block", "term", "ids", "at", "tf", "dl", "max_tf", "min_dl", "top_dl", "df"])
                block += 1
    return run


def build(corpus: DataFrame, path: str | None = None, id_col: str = "id", text_col: str = "content", block_docs: int = BLOCK_DOCS) -> str:
    """Write the index of ``corpus`` to a folder (a new one in the shared scratch folder by default); returns it.

    One tokenising pass, no shuffle of postings. Null text: a document without
    words, left out of the mean length. Ids keep their type; each is expected once.
    """
    spark = corpus.sparkSession
    path = (path or scratch_path(spark, "keyword_index")).rstrip("/")
    id_type = corpus.schema[id_col].dataType
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("term", T.StringType()), T.StructField("ids", T.ArrayType(id_type)),
                           T.StructField("at", T.ArrayType(T.ShortType() if block_docs <= 2**15 else T.IntegerType())),
                           *[T.StructField(c, T.ArrayType(T.IntegerType())) for c in ("tf", "dl")], *[T.StructField(c, T.IntegerType()) for c in ("max_tf", "min_dl", "top_dl", "df")]])
    docs = spread(corpus.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))).select("id", _words(F.col("text")).alias("toks"))
    docs.mapInArrow(_postings(block_docs), schema).write.mode("overwrite").parquet(path)
    return path


def _weight(tf, dl, avgdl: float, k1: float, b: float):
    return tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl))


def _score_block(k: int, avgdl: float, k1: float, b: float):
    """Co-group body: (query words, postings) of one block -> the block's k best documents per query, the scores of
    asked documents (rows with ahead null) and, where an asked document's score is known, how many go before it."""
    def run(asked: pa.Table, postings: pa.Table) -> pa.Table:
        out: list = [[], [], [], []]
        postings = postings.combine_chunks()
        names = postings["term"].to_pylist()
        ids = [str(x) for row, name in enumerate(names) if name is None for x in postings["ids"][row].as_py()]
        flat = lambda c: postings[c].combine_chunks().flatten().to_numpy(zero_copy_only=False)
        ends = np.r_[0, np.cumsum(pc.list_value_length(postings["at"]).to_numpy())]
        at_all = flat("at")
        weights = _weight(flat("tf").astype(float), flat("dl")[at_all], avgdl, k1, b)      # lengths stand in the row without a word
        lists = {name: (at_all[x:y], weights[x:y]) for name, x, y in zip(names, ends, ends[1:]) if name is not None}
        by_id = np.empty(len(ids), np.int64)
        by_id[sorted(range(len(ids)), key=ids.__getitem__)] = np.arange(len(ids))
        place = {x: j for j, x in enumerate(ids)} if pc.any(pc.is_valid(asked["targets"])).as_py() else {}
        for qid, words, targets in zip(*(asked[c].to_pylist() for c in ("query_id", "words", "targets"))):
            acc = np.zeros(len(ids))
            for term, idf in sorted((w["term"], w["idf"]) for w in words):
                if term in lists:
                    at, w = lists[term]
                    acc[at] += idf * w
            # nine decimals: the ranking does not hang on the order of float sums
            score = np.round(acc, 9)
            hits = np.flatnonzero(acc)
            if k and len(hits):
                least = np.partition(score[hits], -min(k, len(hits)))[-min(k, len(hits))]
                best = hits[score[hits] >= least]
                best = best[np.lexsort((by_id[best], -score[best]))[:k]]
                out[0] += [qid] * len(best)
                out[1] += [ids[j] for j in best]
                out[2] += acc[best].tolist()
                out[3] += [None] * len(best)
            for t in targets or []:
                if t["score"] is None:
                    j = place.get(t["id"])
                    if j is not None and acc[j]:
                        out[0].append(qid), out[1].append(t["id"]), out[2].append(float(acc[j])), out[3].append(-1)
                else:
                    before = (score[hits] > t["score"]).sum() + sum(ids[j] < t["id"] for j in hits[score[hits] == t["score"]])
                    out[0].append(qid), out[1].append(t["id"]), out[2].append(t["score"]), out[3].append(int(before))
        return pa.Table.from_arrays([pa.array(out[0], asked.schema.field("query_id").type), pa.array(out[1], pa.string()), pa.array(out[2], pa.float64()), pa.array(out[3], pa.int64())],
                                    names=["query_id", "id", "raw_score", "ahead"])
    return run


class Search:
    """A query set on an index: ``topk`` gives the best documents, ``ranks`` the places of given documents."""

    def __init__(self, spark: SparkSession, path: str, queries: DataFrame, qid_col: str = "query_id", qtext_col: str = "query_text",
                 k1: float = BM25_K1, b: float = BM25_B):
        self.spark, self.k1, self.b = spark, k1, b
        self.postings = spark.read.parquet(path)
        listed = F.filter("dl", lambda x: x >= 0)
        total = F.aggregate(listed, F.lit(0).cast("long"), lambda acc, x: acc + x)
        n, held, words_held = self.postings.where("term is null").agg(F.sum("df"), F.sum(F.size(listed)), F.sum(total)).head()   # one row
        self.avgdl = words_held / held if held else 1.0
        self.qid_type = queries.schema[qid_col].dataType
        tiles = max(1, -(-queries.count() // QUERY_TILE))
        self.tile = F.pmod(F.xxhash64("query_id"), F.lit(tiles)).alias("tile")
        words = queries.select(F.col(qid_col).alias("query_id"), F.explode(_words(F.col(qtext_col))).alias("term")).where("term <> ''").distinct()
        heads = self.postings.select("block", "term", "df", "max_tf", "min_dl", "top_dl").join(words.select("term").distinct(), "term", "left_semi")
        weight = lambda dl: _weight(F.col("max_tf").cast("double"), F.col(dl), self.avgdl, k1, b)
        self.heads = checkpoint_table(heads.select("block", "term", "df", weight("min_dl").alias("most"), weight("top_dl").alias("held")), "block_heads")
        idf = F.log(F.lit(1.0) + (F.lit(float(n or 0)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
        self.words = checkpoint_table(words.join(self.heads.groupBy("term").agg(F.sum("df").alias("df")), "term").select("query_id", "term", idf.alias("idf")), "query_words")
        # blocks, not documents, per query; the margin covers float sums in another order
        self.bounds = self.heads.join(self.words, "term").groupBy("query_id", "block").agg((F.sum(F.col("idf") * F.col("most")) + 1e-6).alias("bound"))

    def score(self, asked: DataFrame, k: int) -> DataFrame:
        """(query_id, id, raw_score, ahead) of the asked (query_id, block, targets). Only postings of these blocks and their queries' words move."""
        words = self.words.groupBy("query_id").agg(F.collect_list(F.struct("term", "idf")).alias("words"))
        asked = asked.join(words, "query_id").withColumn("tile", self.tile)
        wanted = asked.select(F.col("block").alias("to"), F.col("tile").alias("of"), F.explode(F.array_append("words.term", F.lit(None))).alias("word")).distinct()
        lists = (self.postings.join(wanted, (F.col("block") == F.col("to")) & F.col("term").eqNullSafe(F.col("word")))
                 .select(F.col("block").alias("b"), F.col("of").alias("t"), "term", "ids", "at", "tf", "dl"))
        schema = T.StructType([T.StructField("query_id", self.qid_type), T.StructField("id", T.StringType()),
                               T.StructField("raw_score", T.DoubleType()), T.StructField("ahead", T.LongType())])
        return asked.groupBy("block", "tile").cogroup(lists.groupBy("b", "t")).applyInArrow(_score_block(k, self.avgdl, self.k1, self.b), schema)

    def floors(self, k: int) -> DataFrame:
        """(query_id, floor): no more than the k-th score; no row where no word of the query is in k blocks."""
        kth = top_per_query(self.heads, "held", k, qid="term", id_col="block").where(F.col("rank") == k).select("term", "held")
        return self.words.join(kth, "term").groupBy("query_id").agg((F.max(F.col("idf") * F.col("held")) - 1e-6).alias("floor"))

    def _asked(self, k: int) -> DataFrame:
        """(query_id, block) that can hold one of the k best."""
        return self.bounds.join(self.floors(k), "query_id", "left").where("floor is null or bound >= floor").select("query_id", "block")

    @staticmethod
    def _best(scored: DataFrame, k: int) -> DataFrame:
        hits = scored.where("ahead is null").select("query_id", "id", "raw_score", F.round("raw_score", 9).alias("score"))
        return top_per_query(hits, "score", k)

    def topk(self, k: int = TOP_K) -> DataFrame:
        """BM25 top-k: query_id, rank, id, score (nine decimals), raw_score. Blocks whose bound stays below the floor are not read."""
        none = F.lit(None).cast("array<struct<id:string,score:double>>").alias("targets")
        return self._best(self.score(self._asked(k).select("query_id", "block", none), k), k)

    def topk_and_ranks(self, k: int, hits: DataFrame) -> tuple[DataFrame, DataFrame]:
        """``topk(k)``, and (query_id, id, rank, score) in the whole keyword list of the given (query_id, id).

        The hits' scores come first, from the blocks that hold them and their
        queries' words alone. Then one pass over the blocks gives the top-k and
        counts the documents ahead of each hit; blocks whose bound is below both
        the floor and the hits' scores are not read. Hits without a word of the
        query have no rank and no row.
        """
        documents = self.postings.where("term is null").select("block", F.explode("ids").alias("id")).select("block", F.col("id").cast("string").alias("id"))
        target = lambda score: F.collect_list(F.struct("id", score.alias("score"))).alias("targets")
        at = (hits.select("query_id", F.col("id").cast("string").alias("id")).join(documents, "id")
              .groupBy("query_id", "block").agg(target(F.lit(None).cast("double"))))
        own = checkpoint_table(self.score(checkpoint_table(at, "hit_blocks"), 0), "hit_scores").select("query_id", "id", F.round("raw_score", 9).alias("score"))
        lows = own.groupBy("query_id").agg(target(F.col("score")), F.min("score").alias("low"))
        asked = (self.bounds.join(self.floors(k), "query_id", "left").join(lows, "query_id", "left").where("floor is null or bound >= floor or bound >= low")
                 .select("query_id", "block", F.when(F.col("bound") >= F.col("low"), F.col("targets")).alias("targets")))
        scored = checkpoint_table(self.score(asked, k), "block_scores")
        ranks = scored.where("ahead is not null").groupBy("query_id", "id").agg((F.sum("ahead") + 1).alias("rank"), F.max("raw_score").alias("score"))
        return self._best(scored, k), ranks

    def ranks(self, hits: DataFrame) -> DataFrame:
        return self.topk_and_ranks(1, hits)[1]


def keyword_topk(corpus: DataFrame, queries: DataFrame, k: int = TOP_K, path: str | None = None) -> DataFrame:
    """J4 in one call: index ``corpus`` (id, content), answer ``queries`` (query_id, query_text)."""
    return Search(corpus.sparkSession, build(corpus, path), queries).topk(k)


def hybrid_topk(vector_hits: DataFrame, search: Search, k: int = TOP_K, rrf_k: int = RRF_K) -> DataFrame:
    """Reciprocal rank fusion of a vector list (query_id, id, rank, score; k per query) and the whole keyword list, top k.

    A document outside the vector list gains by its keyword rank alone, so only
    the best k of these can win, and they are among the first k plus as many as
    the vector list has. The vector hits' own keyword ranks are counted. At most
    a few rows per query are ranked; rows equal fusion over both whole lists.
    """
    vector = vector_hits.where(F.col("rank") <= k).select("query_id", F.col("id").cast("string").alias("id"), F.col("rank").alias("vector_rank"), F.col("score").alias("vector_score"))
    vector = checkpoint_table(vector, "vector_hits")
    first, counted = (df.select("query_id", "id", F.col("rank").alias("keyword_rank"), F.col("score").alias("keyword_score"))
                      for df in search.topk_and_ranks(2 * k, vector))
    others = first.join(vector.select("query_id", "id"), ["query_id", "id"], "left_anti")
    rows = vector.join(counted, ["query_id", "id"], "left").unionByName(others, allowMissingColumns=True)
    one = lambda c: F.coalesce(1.0 / (rrf_k + F.col(c)), F.lit(0.0))
    return top_per_query(rows.withColumn("rrf_score", one("vector_rank") + one("keyword_rank")), "rrf_score", k)
