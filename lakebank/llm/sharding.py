"""K-d tree sharding: recursive weighted medians along the widest metadata dimension."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lakebank.llm.common import running_total, stored, table


def axis(name: str) -> Column:
    """A number column as a double; null and NaN as 0."""
    value = F.col(name).cast("double")
    return F.coalesce(F.when(F.isnan(value), 0.0).otherwise(value), F.lit(0.0))


def ranks(df: DataFrame, name: str) -> DataFrame:
    """(_value, _rank): the distinct values of a string column in code-point order, from 1; without null.

    A range-partitioned sort and one offset per task, so many values do not meet in one task.
    """
    task = F.shiftright("_at", 33).alias("_p")
    values = stored(df.select(F.col(name).alias("_value")).where("_value is not null").distinct().orderBy("_value")
                    .withColumn("_at", F.monotonically_increasing_id()), "kd_values")
    # one row per sort task
    offs = values.groupBy(task).agg(F.count("*").alias("_n")).select("_p", (F.sum("_n").over(Window.orderBy("_p")) - F.col("_n")).alias("_off"))
    rank = F.col("_off") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    return values.withColumn("_p", task).join(offs, "_p").select("_value", rank.cast("double").alias("_rank"))


def kd_shards(rows: DataFrame, size: str, dims: list[str], leaves: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """``rows`` with _shard (from 0) and _slot (gapless from 0 in the shard).

    The table is cut at weighted medians (``size`` is the weight) along the
    dimension that is widest in the node, as a share of its width in the whole
    table, until ``leaves`` leaves remain: given, or the total over
    ``target_bytes``. A node of k leaves is cut in the ratio floor(k/2) to the
    rest, so the leaves are near equal for any k. Each level cuts all nodes at
    once: one range-partitioned sort with running sums, split over tasks
    whatever the size of a node. Ties along the dimension go by row number, so
    equal rows, a third of the table included, are cut too.

    Strings count by their rank among the column's distinct values, so any
    difference counts, however far in. Null sizes count 0, null dimensions are 0. Empty table: empty result. Only
    the total and the dimensions' ranges reach the driver. ``rows`` should be
    narrow (no texts) and must not use names starting with an underscore.
    """
    cols = rows.columns
    n = len(dims)
    texts = {i: ranks(rows, c) for i, c in enumerate(dims) if rows.schema[c].dataType.typeName() in ("string", "char", "varchar")}
    rows = rows.withColumns({"_row": F.monotonically_increasing_id(), "_size": F.coalesce(F.col(size), F.lit(0)).cast("long"),
                             **{f"_d{i}": axis(c) for i, c in enumerate(dims) if i not in texts}})
    for i, ranked in texts.items():
        ranked = ranked.toDF(f"_v{i}", f"_r{i}")
        rows = (rows.join(ranked, F.col(dims[i]) == F.col(f"_v{i}"), "left")
                .withColumn(f"_d{i}", F.coalesce(f"_r{i}", F.lit(0.0))).drop(f"_v{i}", f"_r{i}"))
    rows = stored(rows, "kd_rows")
    spans = [F.max(f"_d{i}") - F.min(f"_d{i}") for i in range(n)]
    total, *width = rows.agg(F.coalesce(F.sum("_size"), F.lit(0)), *spans).head()
    leaves = leaves or max(1, -(-total // target_bytes))
    rows = rows.withColumns({"_shard": F.lit(0).cast("long"), "_k": F.lit(leaves).cast("long")})
    while leaves > 1:
        widths = F.array(*[s / F.lit(float(w)) if w else F.lit(0.0) for s, w in zip(spans, width)])
        nodes = rows.groupBy(F.col("_shard").alias("_node")).agg(widths.alias("_w")).select(
            "_node", F.array_position("_w", F.array_max("_w")).alias("_axis"))
        value = reduce(lambda x, i: x.when(F.col("_axis") == i + 1, F.col(f"_d{i}")), range(n), F.when(F.lit(False), 0.0))
        cut = running_total(rows.join(nodes, F.col("_shard") == F.col("_node")).withColumn("_value", value).drop("_node", "_axis"),
                            "_shard", ["_value", "_row"], "_size", "kd_level")
        less = F.floor(F.col("_k") / 2)
        left = (F.col("before") + F.col("_size") / 2) * F.col("_k") <= F.col("whole") * less
        rows = cut.select(*cols, "_row", "_size", *[f"_d{i}" for i in range(n)],
                          F.when((F.col("_k") == 1) | left, F.col("_shard")).otherwise(F.col("_shard") + less).alias("_shard"),
                          F.when(F.col("_k") == 1, 1).when(left, less).otherwise(F.col("_k") - less).alias("_k"))
        leaves = -(-leaves // 2)
    out = running_total(rows.withColumn("_one", F.lit(1).cast("long")), "_shard", ["_row"], "_one", "kd_slots")
    return out.select(*cols, F.col("_shard").cast("int").alias("_shard"), F.col("before").alias("_slot"))


def document_sizes(docs: DataFrame) -> DataFrame:
    """Metadata of the documents without the text: size in bytes plus 8, and the text's CRC-32 (null text: as empty)."""
    text = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return docs.select("doc_id", "lang", "source", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))


def op9_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = document_sizes(table(spark, sf_dir, "documents"))
    out = kd_shards(rows, "size", ["doc_id", "size", "lang", "source"], leaves=24)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("_shard").alias("shard"),
                      F.col("_slot").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
