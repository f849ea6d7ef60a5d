"""Streaming change application into an SCD-2 target.

``readStream`` of change files -> ``foreachBatch``. The change log and the
target are partitioned by a hash bucket of the key. Per micro-batch:

1. the batch's changes are added to the log under (bucket, epoch); truncates go
   to a small table of their own. Both are dynamic overwrites of the epoch's own
   partitions, so a retried epoch replaces its rows and never doubles them;
2. the versions of the touched buckets are computed anew from those buckets'
   log -- late events re-open and re-close intervals, because the sequence
   decides, not arrival -- and overwrite these buckets of the target alone;
3. versions keep their whole sequence (tie-breaker included); truncates are
   applied when the target is read, by the same interval join as in batch.

There is one path for every batch, in order or late, whatever it touches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakebank.operators.cdc import _payload, close_versions, versions

BUCKET, EPOCH = "_bucket", "_epoch"


class CdcTarget:
    """An SCD-2 table at ``base`` fed by micro-batches. ``buckets`` is fixed for the table's life: choose it so
    that one bucket's log is a small job (the work of a batch is the touched buckets' share of the log)."""

    def __init__(self, base: str, keys: Sequence[str], sequence_by: Sequence[str], op_col: str = "operacion",
                 delete_ops: Sequence[str] = ("D",), truncate_ops: Sequence[str] = ("TRUNCATE",),
                 except_columns: Sequence[str] = (), buckets: int = 32):
        self.base = base.rstrip("/")
        self.keys, self.sequence_by = list(keys), list(sequence_by)
        self.op_col, self.delete_ops, self.truncate_ops = op_col, list(delete_ops), list(truncate_ops)
        self.except_columns, self.buckets = list(except_columns), buckets
        self.schema = None

    def _overwrite(self, df: DataFrame, part: str, *by: str) -> None:
        """Replace exactly the partitions that ``df`` holds."""
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by)
         .parquet(f"{self.base}/{part}"))

    def foreach_batch(self, batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        self.schema = batch.schema
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        is_trunc = F.coalesce(F.col(self.op_col).isin(*self.truncate_ops), F.lit(False))
        stamped = batch.withColumn(EPOCH, F.lit(epoch_id))
        self._overwrite(stamped.filter(is_trunc), "truncates", EPOCH)
        keyed = stamped.filter(~is_trunc).withColumn(BUCKET, bucket)
        self._overwrite(keyed, "log", BUCKET, EPOCH)
        touched = [r[0] for r in keyed.select(BUCKET).distinct().collect()]       # at most ``buckets`` numbers
        if not touched:
            return
        log = spark.read.schema(T.StructType([*batch.schema, T.StructField(BUCKET, T.IntegerType()), T.StructField(EPOCH, T.LongType())])).parquet(f"{self.base}/log")
        log = log.filter(F.col(BUCKET).isin(touched) & (F.col(EPOCH) <= epoch_id)).drop(EPOCH)
        self._overwrite(versions(log, self.keys, self.sequence_by, self.op_col, self.delete_ops), "versions", BUCKET)

    def current(self, spark: SparkSession) -> DataFrame:
        """The history as of the last batch, truncates applied."""
        held = spark.read.parquet(f"{self.base}/versions").drop(BUCKET)
        truncates = spark.read.schema(self.schema).parquet(f"{self.base}/truncates").drop(EPOCH)
        payload = _payload(truncates, self.keys, self.sequence_by, self.except_columns)
        return close_versions(held, truncates, self.keys, self.sequence_by, payload)


def start_cdc_stream(spark: SparkSession, source_dir: str, schema, target: CdcTarget, checkpoint: str,
                     available_now: bool = True):
    """Start the stream from parquet change files in ``source_dir``."""
    src = spark.readStream.schema(schema).parquet(source_dir)
    w = src.writeStream.foreachBatch(target.foreach_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
