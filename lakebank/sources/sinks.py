"""Sinks: partitioned table writes, table metadata, lineage cuts.

Writes go to the shared checkpoint/warehouse location named by the cluster;
nothing is written to a machine-local folder unless the session leaves that
setting unset (tests).
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from lakebank.session import scratch_path


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str],
                      mode: str = "overwrite", fmt: str = "parquet") -> str:
    """Partitioned write with right-sized files.

    ``REBALANCE`` on the partition columns clusters rows of one partition value
    into few files while AQE splits an oversized value over several tasks
    (a hot month does not end in one task). ``overwrite`` is dynamic: only the
    partitions present in ``df`` are replaced.
    """
    (df.hint("rebalance", *partition_cols).write
       .option("partitionOverwriteMode", "dynamic")
       .mode(mode).partitionBy(*partition_cols).format(fmt).save(path))
    return path


def save_table(df: DataFrame, name: str, partition_cols: Sequence[str] = (),
               comment: str | None = None, properties: Mapping[str, str] | None = None,
               mode: str = "overwrite", bucket_by: tuple[int, str] | None = None) -> None:
    """Catalog table with comment and properties (A8), optionally bucketed.

    Bucketing both sides of a recurring join (e.g. transactions and accounts
    by ``cuenta_id`` with the same bucket count) removes that join's shuffle.
    """
    spark = df.sparkSession
    w = df.write.mode(mode).format("parquet")
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    if bucket_by:
        w = w.bucketBy(bucket_by[0], bucket_by[1]).sortBy(bucket_by[1])
    w.saveAsTable(name)
    props = dict(properties or {})
    if comment:
        props["comment"] = comment
    if props:
        quoted = lambda x: "'" + str(x).replace("\\", "\\\\").replace("'", "\\'") + "'"
        kv = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in props.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({kv})")


def bucketed_pair(left: DataFrame, right: DataFrame, key: str, join, buckets: int = 64, names: tuple[str, str] | None = None) -> DataFrame:
    """``join(left, right)`` of two catalog tables that are bucketed and sorted alike by ``key``.

    Writing them shuffles each side once; every join on the key after that,
    this one included, reads both sides bucket by bucket without an exchange.
    Tables of the given names can be read again by other jobs.
    """
    spark = left.sparkSession
    tag = uuid.uuid4().hex[:12]
    names = names or (f"bucketed_left_{tag}", f"bucketed_right_{tag}")
    for df, name in zip((left, right), names):
        save_table(df.repartition(buckets, key), name, bucket_by=(buckets, key))
    return join(*(spark.read.table(name).hint("merge") for name in names))


def checkpoint_table(df: DataFrame, name: str = "ckpt") -> DataFrame:
    """Cut lineage by writing to the shared checkpoint folder and reading back.

    Survives executor loss (unlike local checkpoints): the data lives on the
    shared file system, not on executors.
    """
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
