"""Session construction and cluster-facing settings.

Everything here is plain Spark configuration. The defaults are sized for a
large cluster (AQE on, skew-join splitting on, partition coalescing on); tests
and the local bench shrink ``spark.sql.shuffle.partitions`` to the core count.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in the library relies on. AQE re-plans joins from runtime
# sizes (broadcast only when the measured side is under the threshold), splits
# skewed shuffle partitions, and coalesces small ones.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Broadcast only sides measured under 32 MB (size-checked by the planner).
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.adaptive.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int | None = None,
                  app_name: str = "lakebank", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    ``shuffle_partitions`` defaults to the core count on local masters; on a
    cluster leave it to the deployment (AQE coalesces the rest).
    """
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BASE_CONF)
    if shuffle_partitions is None and master.startswith("local"):
        shuffle_partitions = os.cpu_count() or 8
    elif shuffle_partitions is None:
        # cluster: start shuffles wide and let AQE coalesce to ~128 MB partitions,
        # so a 100 TB aggregate does not run with 200 oversized, spilling tasks
        conf["spark.sql.adaptive.coalescePartitions.initialPartitionNum"] = "8192"
        conf["spark.sql.shuffle.partitions"] = "8192"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "8g")
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session. Only when it is unset (tests, local runs) do we
    create a fresh scratch folder and register it.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 -- Spark Connect: only the conf is visible
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder")
        return d
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
            "spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            # a machine-local folder does not survive executor loss on a cluster
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        d = tempfile.mkdtemp(prefix="lakebank-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique sub-path of the shared checkpoint folder for written tables."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/tables/{name}-{uuid.uuid4().hex[:12]}"
