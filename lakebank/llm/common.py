"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lakebank.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def ascii_lower(col):
    """Lower-case A-Z only (``lower`` would also change other letters)."""
    return F.translate(col, UPPER, UPPER.lower())


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def pieces(batches: Iterator, rows: int, column: int = -1, nbytes: int = 8 << 20) -> Iterator:
    """Arrow batches cut to at most ``rows`` rows, and about ``nbytes`` of the text column each.

    Bounds what a Python worker holds as objects at a time; no row is left out.
    """
    import pyarrow.compute as pc

    for batch in batches:
        start = 0
        if column >= 0 and batch.num_rows:
            lens = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
            total = 0
            for i, n in enumerate(lens):
                total += n
                if i > start and (total > nbytes or i - start >= rows):
                    yield batch.slice(start, i - start)
                    start, total = i, n
            yield batch.slice(start)
        else:
            for start in range(0, batch.num_rows, rows):
                yield batch.slice(start, rows)


def hash_sample(df: DataFrame, rows: int, *keys) -> DataFrame:
    """``rows`` rows of least hash of ``keys`` (all, if fewer): a bounded sample for fitting.

    A threshold first lets about twice as many through, so what the tasks send
    on for the cut does not grow with their number.
    """
    total = df.count()
    h, range_ = F.xxhash64(*keys), 1 << 30
    low = df.withColumn("_h", h).where(F.pmod("_h", F.lit(range_)) < int(range_ * min(1.0, 2 * rows / max(1, total))))
    return low.orderBy(F.pmod("_h", F.lit(range_)), "_h").limit(rows).drop("_h")


def running_total(df: DataFrame, group: str, order: list, weight: str, name: str) -> DataFrame:
    """Adds ``before`` and ``whole``: the group's weight before the row in ``order``, and in all.

    A range-partitioned sort splits any group over tasks; each task sums its own
    slice, and only one row per (task, group) is combined to get the offsets.
    ``order`` must be unique within the group. Null weights count as 0.
    """
    spark = df.sparkSession
    cols = df.columns
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    schema = T.StructType([*df.schema, T.StructField("_pid", T.IntegerType()), T.StructField("_run", T.LongType())])
    g, w = cols.index(group), cols.index(weight)

    def scan(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        pid = TaskContext.get().partitionId()
        last, carry = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = batch.column(g).to_numpy(zero_copy_only=False)
            wt = np.nan_to_num(batch.column(w).to_numpy(zero_copy_only=False)).astype(np.int64)
            run = np.zeros(len(keys), np.int64)
            cuts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
            for a, b in zip(cuts, np.r_[cuts[1:], len(keys)]):
                if keys[a] != last:
                    last, carry = keys[a], 0
                total = np.cumsum(wt[a:b])
                run[a:b] = carry + total - wt[a:b]
                carry += int(total[-1])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(len(keys), pid, np.int32)), pa.array(run)],
                names=[*batch.schema.names, "_pid", "_run"])

    ordered = df.repartitionByRange(parts, group, *order).sortWithinPartitions(group, *order)
    rows = stored(ordered.mapInArrow(scan, schema), name)
    sums = rows.groupBy(group, "_pid").agg(F.sum(F.coalesce(weight, F.lit(0))).alias("_sum"))
    # one row per (task, group): its size depends on the task count, not on the rows
    by = Window.partitionBy(group).orderBy("_pid")
    offs = sums.select(
        F.col(group).alias("_g"), F.col("_pid").alias("_p"),
        (F.sum("_sum").over(by) - F.col("_sum")).alias("_off"),
        F.sum("_sum").over(Window.partitionBy(group)).alias("whole"))
    return (rows.join(offs, (F.col(group) == F.col("_g")) & (F.col("_pid") == F.col("_p")))
            .withColumn("before", F.col("_run") + F.col("_off"))
            .select(*cols, "before", "whole"))


def components(edges: DataFrame, name: str, precontract: Callable | None = None) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v: long); component = smallest node reached.

    Contraction: every round each node hooks to the neighbour (or itself) of
    least round-salted hash, and the edges are rewritten to the hooked nodes;
    an expected constant share of the nodes goes each round, also on chains and
    stars. Minima are map-side combined, so a node with a third of all edges is
    reduced before the shuffle. Rounds are written to the shared folder; only
    the emptiness of the edge list reaches the driver. Null ends and self loops
    are ignored.
    """
    edges = edges.select("u", "v").where("u is not null and v is not null and u <> v")
    first = edges = stored(precontract(edges) if precontract else edges.distinct(), name)
    steps, salt = [], 0
    while not edges.isEmpty():
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        rank = lambda c: F.xxhash64(F.lit(salt), F.col(c))  # noqa: B023, E731
        best = both.groupBy("u").agg(F.min(F.struct(rank("v").alias("h"), F.col("v"))).alias("b"))
        own = F.struct(rank("u").alias("h"), F.col("u").alias("v"))
        hook = stored(best.select("u", F.least("b", own)["v"].alias("p")), name)
        steps.append(hook)
        a, b = hook.toDF("u", "pu"), hook.toDF("v", "pv")
        edges = stored(edges.join(a, "u").join(b, "v").where("pu <> pv")
                       .select(F.least("pu", "pv").alias("u"), F.greatest("pu", "pv").alias("v")).distinct(), name)
        salt += 1
    if not steps:
        return first.select(F.col("u").alias("node"), F.col("u").alias("component"))
    lab = steps[-1].select(F.col("u").alias("node"), F.col("p").alias("root"))
    for hook in reversed(steps[:-1]):
        up = lab.toDF("p", "root")
        lab = hook.join(up, "p", "left").select(F.col("u").alias("node"), F.coalesce("root", "p").alias("root"))
    lab = stored(lab, name)
    least = lab.groupBy("root").agg(F.min("node").alias("component"))
    return stored(lab.join(least, "root").select("node", "component"), name)
