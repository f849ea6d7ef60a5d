"""Change data capture into SCD-1 / SCD-2 tables (C1-C5) and a row-level
change feed between two snapshots (A10).

Semantics (the reference only declares them):

* rows are ordered per key by ``sequence_by`` (several columns compare as a
  struct, left to right; the last one should be a unique tie-breaker);
* every upsert starts a version; validity is half-open
  ``[__START_AT, __END_AT)``; an open version has a null end;
* a delete row closes the key's open version and starts nothing;
* a truncate row closes every version open at its sequence point;
* ``except_columns`` are left out of the target.

Plan: one ordered per-key scan (``lead``), split by time bucket so a hot key
does not land in one task (``ordered.next_value``). The next truncate comes from
one sweep over versions and truncates in order. Both sides may grow: nothing is
listed or forced to be broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakebank.operators.ordered import next_value, time_bucket
from lakebank.sources.sinks import checkpoint_table

START, END = "__START_AT", "__END_AT"


def _payload(df: DataFrame, keys, sequence_by, except_columns) -> list[str]:
    drop = set(keys) | set(except_columns) | set(sequence_by)
    return [c for c in df.columns if c not in drop]


def next_truncate(versions: DataFrame, truncates: DataFrame, seq_cols: Sequence[str]) -> DataFrame:
    """Add ``__next_trunc``: time of the first truncate after each row's sequence.

    One sweep over versions and truncates together, range-partitioned and sorted
    by descending sequence: each task carries the truncate it passed last, and
    what the tasks of later sequences hand on is one row per task. Linear in both
    sides, whatever falls on one day; a truncate at a row's own sequence isn't after it.
    """
    spark = versions.sparkSession
    out = T.StructType([*(T.StructField(f.name, f.dataType) for f in versions.schema), T.StructField("__next_trunc", versions.schema[seq_cols[0]].dataType), T.StructField("__task", T.IntegerType())])
    marked = versions.withColumn("__trunc", F.lit(False)).unionByName(
        truncates.select(*seq_cols).distinct().withColumn("__trunc", F.lit(True)), allowMissingColumns=True)
    order = [*[F.desc(c) for c in seq_cols], F.asc("__trunc")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    at, time = marked.columns.index("__trunc"), marked.columns.index(seq_cols[0])
    cols = [i for i in range(len(marked.columns)) if i != at]

    def sweep(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        task, carried = TaskContext.get().partitionId(), None
        for batch in batches:
            if not batch.num_rows:
                continue
            trunc = batch.column(at).to_numpy(zero_copy_only=False).astype(bool)
            times = batch.column(time)
            last = np.maximum.accumulate(np.where(trunc, np.arange(len(trunc)), -1))
            held = pa.concat_arrays([times, pa.array([carried], times.type)]).take(pa.array(np.where(last < 0, len(trunc), last)))
            if last[-1] >= 0:
                carried = times[int(last[-1])].as_py()
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in cols), held, pa.array(np.full(len(trunc), task, np.int32))], names=out.names).filter(pa.array(~trunc))
        # what this task hands on: a row without a version
        if carried is not None:
            yield pa.RecordBatch.from_arrays([*(pa.nulls(1, f.type) for f in (batch.schema.field(i) for i in cols)), pa.array([carried], times.type), pa.array([-1 - task], pa.int32())], names=out.names)

    swept = marked.repartitionByRange(parts, *order).sortWithinPartitions(*order).mapInArrow(sweep, out)
    swept = checkpoint_table(swept, "cdc_sweep")
    handed = swept.where("__task < 0").select((-1 - F.col("__task")).alias("__from"), F.col("__next_trunc").alias("__handed"))
    before = swept.where("__task >= 0")
    # tasks count up as the sequence goes down; one row per task on either side
    got = (before.select("__task").distinct().join(handed, F.col("__from") < F.col("__task"), "left")
           .groupBy(F.col("__task").alias("__of")).agg(F.max_by("__handed", "__from").alias("__handed")))
    return (before.join(got, F.col("__task") == F.col("__of"), "left")
            .withColumn("__next_trunc", F.coalesce("__next_trunc", "__handed")).drop("__task", "__of", "__handed"))


def versions(keyed: DataFrame, keys: Sequence[str], sequence_by: Sequence[str], op_col: str,
             delete_ops: Sequence[str], bucket_seconds: int = 86400) -> DataFrame:
    """Upserts with ``__lead``, the time of the key's next change (truncates not yet applied)."""
    with_next = next_value(keyed, keys, sequence_by, sequence_by[0], "__lead",
                           bucket=time_bucket(sequence_by[0], bucket_seconds))
    op = F.col(op_col)
    return with_next.filter(~op.isin(*delete_ops) | op.isNull())


def close_versions(open_versions: DataFrame, truncates: DataFrame, keys: Sequence[str], sequence_by: Sequence[str],
                   payload: Sequence[str]) -> DataFrame:
    """Validity of each version: up to the key's next change or the next truncate."""
    cut = next_truncate(open_versions, truncates, sequence_by)
    return cut.select(*keys, *payload, F.col(sequence_by[0]).alias(START), F.least("__lead", "__next_trunc").alias(END))


def apply_changes(changes: DataFrame, keys: Sequence[str], sequence_by: Sequence[str],
                  op_col: str = "operacion", delete_ops: Sequence[str] = ("D",),
                  truncate_ops: Sequence[str] = ("TRUNCATE",), except_columns: Sequence[str] = (),
                  scd_type: int = 2, bucket_seconds: int = 86400) -> DataFrame:
    """Apply a change feed (C1-C5). ``scd_type`` 2 -> history, 1 -> latest state."""
    if scd_type == 1:
        return scd1(changes, keys, sequence_by, op_col, delete_ops, truncate_ops, except_columns)
    op = F.col(op_col)
    keyed = changes.filter(~op.isin(*truncate_ops) | op.isNull())
    truncs = changes.filter(op.isin(*truncate_ops))
    return close_versions(versions(keyed, keys, sequence_by, op_col, delete_ops, bucket_seconds), truncs, keys,
                          sequence_by, _payload(changes, keys, sequence_by, except_columns))


def scd1(changes: DataFrame, keys: Sequence[str], sequence_by: Sequence[str],
         op_col: str = "operacion", delete_ops: Sequence[str] = ("D",),
         truncate_ops: Sequence[str] = ("TRUNCATE",), except_columns: Sequence[str] = ()) -> DataFrame:
    """Latest state per key (C2): rows after the last truncate, newest wins,
    keys whose newest row is a delete are gone. ``max_by`` pre-aggregates
    map-side, so hot keys cost one row per map task in the shuffle."""
    op = F.col(op_col)
    seq = F.struct(*sequence_by)
    last_trunc = changes.filter(op.isin(*truncate_ops)).agg(F.max(seq)).scalar()
    live = changes.filter((~op.isin(*truncate_ops) | op.isNull())
                          & (last_trunc.isNull() | (seq > last_trunc)))
    payload = _payload(changes, keys, sequence_by, except_columns)
    latest = live.groupBy(*keys).agg(F.max_by(F.struct(*payload, op.alias("__op")), seq).alias("__r"))
    return (latest.filter(~F.col("__r.__op").isin(*delete_ops) | F.col("__r.__op").isNull())
            .select(*keys, *[F.col(f"__r.{c}").alias(c) for c in payload]))


def change_feed(before: DataFrame, after: DataFrame, keys: Sequence[str],
                change_col: str = "_change_type") -> DataFrame:
    """Row-level changes between two snapshots of a keyed table (A10):
    ``insert``, ``delete``, ``update_preimage`` + ``update_postimage``."""
    payload = [c for c in after.columns if c not in keys]
    b = before.select(*keys, F.struct(*payload).alias("__b"), F.lit(True).alias("__hb"))
    a = after.select(*keys, F.struct(*payload).alias("__a"), F.lit(True).alias("__ha"))
    j = b.join(a, list(keys), "full_outer")
    hb, ha = F.col("__hb").isNotNull(), F.col("__ha").isNotNull()
    same = F.col("__b").eqNullSafe(F.col("__a"))

    def ev(kind, img):
        return F.struct(F.lit(kind).alias("k"), F.col(img).alias("img"))

    events = (F.when(ha & ~hb, F.array(ev("insert", "__a")))
              .when(hb & ~ha, F.array(ev("delete", "__b")))
              .when(~same, F.array(ev("update_preimage", "__b"), ev("update_postimage", "__a")))
              .otherwise(F.array()))
    return (j.select(*keys, F.explode(events).alias("__e"))
            .select(*keys, *[F.col(f"__e.img.{c}").alias(c) for c in payload],
                    F.col("__e.k").alias(change_col)))


def change_feed_digests(before: DataFrame, after: DataFrame, keys: Sequence[str], buckets: int = 4096,
                        change_col: str = "_change_type") -> DataFrame:
    """``change_feed`` for large snapshots that differ little: only buckets of keys whose digests differ are joined.

    A bucket's digest is its row count and two order-free sums of row hashes, one
    partial/final aggregate per snapshot with one row per bucket. Equal digests of
    unequal buckets are as likely as a collision of 128 bits. The rows that reach
    the join follow the change, not the table.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).alias("__bucket")
    cols = after.columns

    def digest(df: DataFrame, name: str) -> DataFrame:
        h1, h2 = F.xxhash64(*cols), F.xxhash64(F.lit(7), *reversed(cols))
        whole = lambda h: F.sum(h.cast("decimal(20,0)"))
        return df.groupBy(bucket).agg(F.struct(F.count("*").alias("n"), whole(h1).alias("a"), whole(h2).alias("b")).alias(name))

    # written: read for both sides, and so small that the planner sends it to the rows
    changed = checkpoint_table(digest(before, "d1").join(digest(after, "d2"), "__bucket", "full_outer")
                               .where(~F.col("d1").eqNullSafe(F.col("d2"))).select("__bucket"), "changed_buckets")
    some = lambda df: df.withColumn("__bucket", bucket).join(changed, "__bucket", "left_semi").select(*cols)
    return change_feed(some(before), some(after), keys, change_col)
