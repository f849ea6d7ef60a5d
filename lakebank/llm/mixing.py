"""Mixing sources to target weights by nested hash thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakebank.llm.common import WORD, stored, table

#: Bits of the hash that one refinement looks at, and how many such digits the text hash has.
BITS, DIGITS = 12, 5


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: list[int], share: float, cap: float) -> DataFrame:
    """Targets of the sources: (source, source_size, target).

    ``sizes`` has (source, source_size). Weights repeat over the sources in
    code-point order, null last. Everything shared is ``share`` times the sum of
    the sizes; a target stops at ``cap`` times its source's size and the excess
    is shared anew by weight until none is above. Per round two sums reach the
    driver. The order number comes from a range-partitioned sort and one offset
    per task, so many sources do not meet in one task.
    """
    n_tasks = F.shiftright("_at", 33).alias("_p")
    sizes = stored(sizes.orderBy(F.col("source").asc_nulls_last())
                   .withColumn("_at", F.monotonically_increasing_id()), "mix_sources")
    tasks = sizes.groupBy(n_tasks).agg(F.count("*").alias("n"))
    # one row per sort task
    offs = tasks.select("_p", (F.sum("n").over(Window.orderBy("_p")) - F.col("n")).alias("off"))
    pos = (F.col("off") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))) % len(weights)
    ranked = (sizes.withColumn("_p", n_tasks).join(offs, "_p")
              .select("source", "source_size", F.element_at(F.array(*map(F.lit, weights)), (pos + 1).cast("int")).alias("weight")))
    ranked = stored(ranked, "mix_weights")
    budget = share * (ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0))).head()[0])
    full, level = None, 0.0
    while True:
        over = F.col("source_size") * cap < F.lit(level) * F.col("weight") if full is not None else F.lit(False)
        n, held, w = ranked.agg(
            F.count(F.when(over, 1)), F.coalesce(F.sum(F.when(over, F.col("source_size") * cap)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0))).head()
        if n == full or not w:
            break
        full, level = n, (budget - held) / w
    return ranked.select("source", "source_size", F.least(F.lit(level) * F.col("weight"), F.col("source_size") * F.lit(float(cap))).alias("target"))


def mix(docs: DataFrame, weights: list[int], share: float = 1.5, cap: float = 2.0, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (every row; every column, or those of ``keep``) with size, source_size, target and copies.

    ``size`` is the number of words. Each source's target is met by whole
    documents: with a target of r times the source, every document is taken
    floor(r) times, and once more if its hash lies below the source's threshold.
    The threshold comes from histograms: words per (source, hash bucket), the
    bucket in which the budget is crossed is refined alone, 12 bits at a time,
    and the last document is taken if that comes nearer. Smaller budgets thus
    take subsets of larger ones, and no row is sorted. The hash covers doc_id
    and text; only rows alike in both go on to their row number.

    Null text: size 0, taken with its hash. Null source: a source of its own,
    last in order. Empty table: empty result. Equal rows are told apart by their
    row number in the scan. Other columns pass through untouched. Reruns over the same files agree.
    """
    key = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    own = ["_mix_size", "_mix_hash", "_mix_row"]
    rows = (docs.select(F.struct(*(keep or docs.columns)).alias("_mix_doc"), "doc_id", "source", "text").withColumn("_mix_row", F.monotonically_increasing_id())
            .withColumn("_mix_size", word_count(F.col("text")))
            .withColumn("_mix_hash", F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long")))
    # written once: a row number taken anew in a second scan depends on how that scan is split
    rows = stored(rows.drop("doc_id", "text"), "mix_rows")
    meta = rows.select("source", *own)
    sizes = meta.groupBy("source").agg(F.sum("_mix_size").alias("source_size"))
    targets = stored(source_targets(sizes, weights, share, cap), "mix_targets")
    plan = targets.select("source", "source_size", "target",
                          F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("int").alias("base"))
    plan = plan.withColumn("need", F.col("target") - F.col("base") * F.col("source_size"))

    # digit k of the row's position: the text hash first, then a hash of the row number
    digit = [F.shiftright("_mix_hash", 60 - BITS * (k + 1)).bitwiseAND(F.lit((1 << BITS) - 1)) for k in range(DIGITS)]
    by_row = F.xxhash64(F.col("_mix_row"))
    digit += [F.shiftrightunsigned(by_row, 64 - BITS * (k + 1)).bitwiseAND(F.lit((1 << BITS) - 1)) for k in range(DIGITS)]
    same = lambda a, b: F.col(a).eqNullSafe(F.col(b))
    open_, cuts, at = meta, [], plan.where("source_size > 0").select(F.col("source").alias("_s"), F.col("need").alias("_need"))
    for k in range(2 * DIGITS):
        hist = (open_.groupBy("source", digit[k].alias("_b")).agg(F.sum("_mix_size").alias("_w"), F.count("*").alias("_n")))
        run = F.sum("_w").over(Window.partitionBy("source").orderBy("_b"))
        hist = hist.withColumn("_before", run - F.col("_w"))
        edge = (hist.join(at, same("source", "_s"))
                .where("_before < _need and _need <= _before + _w")
                .groupBy("source").agg(F.min(F.struct("_b", (F.col("_need") - F.col("_before")).alias("_need"), "_w", "_n")).alias("e"))
                .select(F.col("source").alias("_s"), "e.*"))
        edge = stored(edge, "mix_edge")
        cuts.append(edge)
        if edge.where("_n > 1").isEmpty() or k == 2 * DIGITS - 1:
            break
        at = edge.where("_n > 1").select("_s", F.col("_b").alias("_at"), "_need")
        open_ = stored(open_.join(at, same("source", "_s") & (digit[k] == F.col("_at"))).select("source", *own), "mix_open")
        at = at.select("_s", "_need")

    # per source: the bucket path and whether its last document is taken
    path = plan
    for k, edge in enumerate(cuts):
        e = edge.select(F.col("_s").alias(f"_s{k}"), F.col("_b").alias(f"_b{k}"),
                        F.when(F.col("_n") == 1, 2 * F.col("_need") >= F.col("_w")).alias(f"_last{k}"))
        path = path.join(e, F.col("source").eqNullSafe(F.col(f"_s{k}")), "left").drop(f"_s{k}")
    # below the path: taken; on it: the flag of the last bucket; nothing needed: not taken
    more = F.lit(False)
    for k in reversed(range(len(cuts))):
        b = F.col(f"_b{k}")
        on = F.when(F.col(f"_last{k}").isNotNull(), F.col(f"_last{k}")).otherwise(more)
        more = F.when(b.isNull(), F.lit(False)).when(digit[k] < b, F.lit(True)).when(digit[k] == b, on).otherwise(F.lit(False))
    # written first, so the planner knows how small it is and the documents stay where they are
    wide = stored(path, "mix_plan").withColumnsRenamed({"source": "_mix_s", "source_size": "_mix_source_size", "target": "_mix_target", "base": "_mix_base"})
    out = rows.join(wide, F.col("source").eqNullSafe(F.col("_mix_s")))
    return (out.withColumn("_mix_copies", (F.col("_mix_base") + F.when(more, 1).otherwise(0)).cast("int"))
            .select(*[F.col("_mix_doc")[c].alias(c) for c in keep or docs.columns], "_mix_size", "_mix_source_size", "_mix_target", "_mix_copies"))


WEIGHTS = [3, 1, 2]


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"), WEIGHTS, keep=["doc_id"])
    return out.select("doc_id", F.col("_mix_size").alias("size"), F.col("_mix_source_size").alias("source_size"),
                      F.col("_mix_target").alias("target"), (F.col("_mix_size") * F.col("_mix_copies")).alias("taken"))


def stage_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: none, once or twice."""
    out = mix(docs, WEIGHTS).where("_mix_copies > 0")
    return out.withColumn("_mix_copies", F.explode(F.array_repeat(F.lit(1), F.col("_mix_copies")))).select(*docs.columns)


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5(coalesce(doc_id::varchar, '') || ':' || md5(coalesce(text, ''))), 1, 15))::bigint AS h
  FROM documents),
s AS (SELECT source, sum(size)::bigint AS source_size FROM d GROUP BY source),
r AS (SELECT *, [3, 1, 2][1 + (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3] AS w FROM s),
-- the sources that stop at twice their size come first in order of size by weight
f AS (SELECT *, coalesce(sum(2.0 * source_size) OVER o, 0) AS held,
             sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS rest,
             1.5 * sum(source_size) OVER () AS budget
      FROM r WINDOW o AS (ORDER BY source_size / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT coalesce(max((budget - held)::double / rest) FILTER (WHERE (budget - held)::double / rest * w <= 2.0 * source_size), 0) AS level FROM f),
t AS (SELECT source, source_size, least(level * w, 2.0 * source_size)::double AS target FROM r, l),
b AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::bigint AS base FROM t),
c AS (SELECT d.doc_id, d.size, b.source_size, b.target, b.base, b.target - b.base * b.source_size AS need,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h) - d.size AS before
      FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size::bigint AS size, source_size, target,
       (size * (base + CASE WHEN need > 0 AND (before + size < need OR (before < need AND 2 * (need - before) >= size)) THEN 1 ELSE 0 END))::bigint AS taken
FROM c
"""
