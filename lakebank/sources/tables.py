"""Reading the input tables.

Parquet scans are lazy: Catalyst prunes columns and pushes filters into the
scan, so callers select only what they use and never pre-load whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table as a lazily scanned parquet DataFrame."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """Read a catalog table or view by name."""
    return spark.read.table(name)


def register_views(spark: SparkSession, sf_dir: str, names=DRIVER_TABLES) -> None:
    """Expose driver tables as temp views so ``spark.sql`` / ``read.table`` see them."""
    for n in names:
        read_table(spark, sf_dir, n).createOrReplaceTempView(n)


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Deal the rows of a table of few files over the cluster's cores.

    A large table stored as many files is already split by the scan and stays
    as it is; a table of one file would otherwise run CPU-heavy per-row work
    (tokenising, regex) on a single core. Decided from the scan's file list,
    without running anything.
    """
    n = min_partitions or df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(n) if len(df.inputFiles()) < n else df
