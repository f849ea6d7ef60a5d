"""Exact top-k search over an impact-ordered index, score at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lakebank.llm.common import stored, table

#: Rows of an index block and of a query block; impact levels per dimension.
BLOCK, QUERY_BLOCK, LEVELS = 16384, 1024, 16
#: Shares of the postings after which the stop proof is tried; most rows, as a share, that are rescored early.
TRIES, RESCORE = (0.6, 0.8, 0.92, 1.0), 0.02


class ImpactIndex:
    """Postings of a block of integer vectors: per dimension, segments of rows of one quantised impact."""

    def __init__(self, vectors, levels: int = LEVELS):
        import numpy as np

        self.vectors = vectors
        n, dims = vectors.shape
        low, high = vectors.min(0), vectors.max(0)
        width = np.maximum(1, -(-(high - low + 1) // levels))
        level = (vectors - low) // width
        self.least = low[:, None] + np.arange(levels) * width[:, None]          # bounds of each segment's impacts
        self.most = np.minimum(self.least + width[:, None] - 1, high[:, None])
        key = (level + np.arange(dims) * levels).T.ravel()                       # (dimension, level) of each posting
        order = np.argsort(key, kind="stable")
        self.rows = (order % n).astype(np.int32)
        self.ends = np.searchsorted(key[order], np.arange(dims * levels + 1))

    def search(self, query, k: int, own: int | None):
        """(row, score) of the k best rows but ``own`` and all that tie with the last, exact.

        Segments are taken by falling upper contribution to the query. A row's
        bound is what its segments gave, plus the next contribution for each
        dimension that has not reached it. The search stops when the rows whose
        bound reaches the k-th exact score found so far are few; those are
        rescored exactly, so no possible member is missed.
        """
        import numpy as np

        n, dims = self.vectors.shape
        gain = np.maximum(query[:, None] * self.least, query[:, None] * self.most)
        sizes = np.diff(self.ends)
        filled = sizes.reshape(gain.shape) > 0
        floor = np.where(filled, gain, gain.max(initial=0)).min(1) if dims else np.zeros(0)
        extra = np.where(filled, gain - floor[:, None], 0).ravel()               # over the dimension's least: never negative
        order = np.argsort(-extra, kind="stable")
        order = order[sizes[order] > 0]
        done = np.cumsum(sizes[order])
        acc, met, at = np.zeros(n), np.zeros(n), 0
        base = float(floor.sum())
        for share in TRIES:
            upto = int(np.searchsorted(done, share * n * dims - 0.5)) + 1 if share < 1 else len(order)
            part = order[at:upto]
            if len(part):
                rows = np.concatenate([self.rows[self.ends[s]:self.ends[s + 1]] for s in part])
                acc += np.bincount(rows, np.repeat(extra[part].astype(float), sizes[part]), n)
                met += np.bincount(rows, minlength=n)
            at = max(at, upto)
            rest = float(extra[order[at]]) if at < len(order) else 0.0
            bound = base + acc + (dims - met) * rest
            if own is not None:
                bound[own] = -np.inf
            best = np.argpartition(-bound, min(4 * k, n - 1))[:4 * k + 1] if n > 4 * k else np.arange(n)
            best = best[best != own] if own is not None else best
            exact = np.sort(self.vectors[best] @ query)[::-1]
            limit = exact[k - 1] if len(exact) >= k else -np.inf
            possible = np.flatnonzero(bound >= limit)
            if at >= len(order) or len(possible) <= max(4 * k, RESCORE * n):
                break
        possible = possible[possible != own] if own is not None else possible
        return possible, self.vectors[possible] @ query


def block_topk(ids, rows, vectors, queries, k: int):
    """(query row, query id, row, id, score) of each query's k best in this block; ties to smaller id, then row."""
    import numpy as np

    dims = max([len(v) for v in vectors] + [len(v) for _, _, v in queries])
    pad = lambda v: list(v) + [0] * (dims - len(v))
    data = np.array([pad(v) for v in vectors], np.int64).reshape(len(vectors), dims)
    wanted = np.array([pad(v) for _, _, v in queries], np.int64).reshape(len(queries), dims)
    top = max(1, int(np.abs(data.astype(float)).max(initial=0)), int(np.abs(wanted.astype(float)).max(initial=0)))
    small = top * top * max(1, dims) < 1 << 52
    index = ImpactIndex(data) if small and dims else None
    ids, rows = np.asarray(ids, np.int64), np.asarray(rows, np.int64)
    place = {r: i for i, r in enumerate(rows.tolist())}
    for (qrow, qid, _), query in zip(queries, wanted):
        own = place.get(qrow)
        if index:
            found, scores = index.search(query, k, own)
        else:   # beyond exact doubles: whole numbers of any size, held to 64 bits
            found = np.array([i for i in range(len(rows)) if i != own], np.int64)
            sums = [sum(int(a) * int(b) for a, b in zip(data[i], query)) for i in found]
            scores = np.array([max(-2**63, min(2**63 - 1, s)) for s in sums], np.int64)
        for i in np.lexsort((rows[found], ids[found], -scores if index else [-int(s) for s in scores]))[:k]:
            yield qrow, qid, int(rows[found[i]]), int(ids[found[i]]), int(scores[i])


def usable(vector: Column) -> Column:
    return F.coalesce(vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def exact_topk(vectors: DataFrame, queries: Column, k: int = 5, block: int = BLOCK, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for every row where ``queries`` holds.

    Components become floor(256 x); the score is the integer inner product;
    every row but the query's own is a candidate. Rows and queries are dealt
    into blocks of bounded size; each pair of blocks is one group, which builds
    its index and searches it, and sends on k rows per query. Nothing is
    broadcast or collected but two counts.

    Vectors that are null or hold null, NaN or infinity take no part, as query
    or candidate. Shorter vectors are filled up with 0. Rows with the same
    vec_id are candidates each; ties go to the smaller vec_id. Fewer rows than k:
    all of them. Without rows or queries: empty result. Other columns are not read.
    """
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("long"))
    rows = stored(vectors.where(usable(F.col("embedding")) & F.col("vec_id").isNotNull())
                  .select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long"), whole.alias("v"), F.coalesce(queries, F.lit(False)).alias("asks")), "topk_rows")
    n, asked = rows.agg(F.count("*"), F.count(F.when(F.col("asks"), 1))).head()
    blocks, query_blocks = max(1, -(-n // block)), max(1, -(-asked // query_block))
    deal = lambda m: F.pmod(F.xxhash64("row"), F.lit(m)).cast("int")
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    left = rows.select(deal(blocks).alias("b"), every(query_blocks).alias("q"), "row", "vec_id", "v")
    right = rows.where("asks").select(every(blocks).alias("b"), deal(query_blocks).alias("q"), "row", "vec_id", "v")
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("query_row", "query_id", "row", "vec_id", "score")])

    def run(held, asking):
        import pyarrow as pa

        found = []
        if held.num_rows and asking.num_rows:
            asks = list(zip(asking["row"].to_pylist(), asking["vec_id"].to_pylist(), asking["v"].to_pylist()))
            found = list(block_topk(held["vec_id"].to_pylist(), held["row"].to_pylist(), held["v"].to_pylist(), asks, k))
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in (zip(*found) if found else [[]] * 5)], names=schema.names)

    best = left.groupBy("b", "q").cogroup(right.groupBy("b", "q")).applyInArrow(run, schema)
    place = F.row_number().over(Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row"))
    return (best.withColumn("rank", place).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op4_impact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_topk(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


ORACLE = """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: floor(256 * x::double))::double[] AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT a.r, a.vec_id AS query_id, b.vec_id, list_inner_product(a.q, b.q)::bigint AS score
  FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 50 = 0)
SELECT query_id, (row_number() OVER w)::int AS rank, vec_id, score
FROM s WINDOW w AS (PARTITION BY r ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5
"""
