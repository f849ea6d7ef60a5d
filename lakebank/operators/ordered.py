"""Ordered per-key scans that stay parallel when one key is hot.

A plain ``Window.partitionBy(key).orderBy(ts)`` sends every row of a key to
one task; if one customer or account holds a third of all rows, that task
holds a third of the data. These helpers split each key by a bucket of the
ordering column (a time bucket, or a block of turn numbers):

1. the window runs per (key, bucket) -- the hot key is spread over buckets;
2. a per-(key, bucket) summary (one row per bucket) gets a window over
   buckets, which is tiny (bounded by the time span / bucket width);
3. the summary is joined back on (key, bucket). The large side is already
   hash-partitioned on (key, bucket) by step 1, so only the summary moves.

The result equals the single window over the key (a prefix scan split into a
local scan plus a carried-in value).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakebank.functions.expr import epoch_seconds

BUCKET, KEY = "__bucket", "__key"


def time_bucket(ts: str, seconds: int) -> Column:
    return F.floor(epoch_seconds(ts) / F.lit(seconds))


def block_bucket(c: str, size: int) -> Column:
    return F.floor(F.col(c) / F.lit(size))


def _bucketed(df: DataFrame, keys: Sequence[str], bucket: Column | None) -> DataFrame:
    """Add the key (as one struct, so that null keys meet in joins as they do in
    windows) and the bucket, or reuse both when ``bucket`` is None (keeps the
    partitioning of a previous phase, saving a shuffle)."""
    if bucket is None:
        return df
    return df.withColumns({KEY: F.struct(*keys) if keys else F.lit(0), BUCKET: bucket})


def _value(v: str | Column) -> Column:
    return v if isinstance(v, Column) else F.col(v)


def next_value(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str | Column, out: str,
               bucket: Column | None, keep_bucket: bool = False) -> DataFrame:
    """``lead(value)`` over ``keys`` in ``order``."""
    w = Window.partitionBy(KEY, BUCKET).orderBy(*order)
    b = _bucketed(df, keys, bucket).withColumn("__val", _value(value))
    # the bucket's last row is the one without a next row in the same window
    b = b.withColumns({"__local": F.lead("__val").over(w), "__last": F.lead(F.lit(1)).over(w).isNull()})
    summ = (b.groupBy(KEY, BUCKET)
            .agg(F.min_by(F.col("__val"), F.struct(*order)).alias("__first"))
            .withColumn("__carry", F.lead("__first").over(Window.partitionBy(KEY).orderBy(BUCKET)))
            .select(KEY, BUCKET, "__carry"))
    return (b.join(summ, [KEY, BUCKET], "left")
            .withColumn(out, F.when(F.col("__last"), F.col("__carry")).otherwise(F.col("__local")))
            .drop("__val", "__local", "__last", "__carry", *([] if keep_bucket else [KEY, BUCKET])))


def prev_value(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str | Column, out: str,
               bucket: Column | None, keep_bucket: bool = False) -> DataFrame:
    """``lag(value)`` over ``keys`` in ``order``."""
    w = Window.partitionBy(KEY, BUCKET).orderBy(*order)
    b = _bucketed(df, keys, bucket).withColumn("__val", _value(value))
    b = b.withColumns({"__local": F.lag("__val").over(w), "__first": F.lag(F.lit(1)).over(w).isNull()})
    summ = (b.groupBy(KEY, BUCKET)
            .agg(F.max_by(F.col("__val"), F.struct(*order)).alias("__last"))
            .withColumn("__carry", F.lag("__last").over(Window.partitionBy(KEY).orderBy(BUCKET)))
            .select(KEY, BUCKET, "__carry"))
    return (b.join(summ, [KEY, BUCKET], "left")
            .withColumn(out, F.when(F.col("__first"), F.col("__carry")).otherwise(F.col("__local")))
            .drop("__val", "__local", "__carry", "__first", *([] if keep_bucket else [KEY, BUCKET])))


_AGG = {"sum": F.sum, "max": F.max, "min": F.min}


def _combine(how: str, local: Column, carry: Column) -> Column:
    if how == "sum":
        return F.when(local.isNull(), carry).when(carry.isNull(), local).otherwise(local + carry)
    return F.greatest(local, carry) if how == "max" else F.least(local, carry)


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str],
            aggs: Mapping[str, tuple[Column, str]], bucket: Column | None, include_current: bool = True,
            keep_bucket: bool = False) -> DataFrame:
    """Running aggregates per key in ``order``: ``aggs = {out: (expr, "sum"|"max"|"min")}``.

    ``include_current=False`` gives the aggregate over strictly earlier rows.
    """
    b = _bucketed(df, keys, bucket)
    vals = {f"__v{i}": e for i, (e, _) in enumerate(aggs.values())}
    b = b.withColumns(vals)
    hi = 0 if include_current else -1
    w_local = Window.partitionBy(KEY, BUCKET).orderBy(*order).rowsBetween(Window.unboundedPreceding, hi)
    w_prev = Window.partitionBy(KEY).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    hows = [h for _, h in aggs.values()]
    b = b.withColumns({f"__l{i}": _AGG[h](f"__v{i}").over(w_local) for i, h in enumerate(hows)})
    summ = b.groupBy(KEY, BUCKET).agg(*[_AGG[h](f"__v{i}").alias(f"__b{i}") for i, h in enumerate(hows)])
    summ = summ.select(KEY, BUCKET, *[_AGG[h](f"__b{i}").over(w_prev).alias(f"__c{i}") for i, h in enumerate(hows)])
    j = b.join(summ, [KEY, BUCKET], "left")
    j = j.withColumns({out: _combine(h, F.col(f"__l{i}"), F.col(f"__c{i}"))
                       for i, (out, h) in enumerate(zip(aggs.keys(), hows))})
    drop = [c for i in range(len(hows)) for c in (f"__v{i}", f"__l{i}", f"__c{i}")]
    return j.drop(*drop, *([] if keep_bucket else [KEY, BUCKET]))
