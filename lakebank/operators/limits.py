"""Sliding-window rate limit per customer (I2), batch form.

Rule (reference): a request is accepted when fewer than ``limit`` *accepted*
requests of the same customer lie in ``(ts - window, ts]``; denied requests
are not recorded. Because only accepted requests count, the decision is
sequential per customer -- a plain range-frame count over all attempts would
over-deny. Plan:

1. Cut each customer's stream where the trailing two windows hold no more
   attempts than the limit: every attempt in the last window was accepted
   there, so a piece can begin at that row, with the last window's rows as
   warm-up. One scan per (customer, time bucket) looks for the first such row
   of each bucket; the last two windows of a bucket are seen by the next one
   too. So steady traffic below the limit is cut about once a bucket, however
   busy the customer. Only a stretch that stays saturated is one piece: there
   each decision depends on the one before.
2. Hash-partition by (customer, piece), sort within partitions, and replay
   each piece with a bounded state (at most ``limit`` timestamps) in
   ``mapInPandas``. Rows stream through in order; no group is collected.
"""

from __future__ import annotations

from collections import deque

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakebank.operators.ordered import BUCKET, KEY

RATE_LIMIT_MAX = 30
RATE_LIMIT_WINDOW_SECONDS = 60
RATE_LIMIT_REASON = "RATE_LIMIT_EXCEEDED"


def _micros(ts: str):
    """Microseconds since 1970 of a wall-clock timestamp (zone independent)."""
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"),
                            F.col(ts).cast("timestamp_ntz"))


def _replay(limit: int, window_us: int, keep: list[str]):
    """mapInPandas body over rows sorted by (customer, piece, time, id).

    Warm-up rows are known to be accepted: they fill the state and give no
    output. A piece with at most ``limit`` rows is accepted whole; longer ones
    are replayed row by row with the accepted times still in the window (at
    most ``limit``): the rule is sequential there. A piece cut by an Arrow
    batch goes on with the carried state.
    """
    def run(batches):
        cur = None
        acc: deque = deque()
        for pdf in batches:
            n = len(pdf)
            if n == 0:
                continue
            keys, pieces = pdf["__k"].to_numpy(), pdf["__piece"].to_numpy()
            us, warm = pdf["__us"].to_numpy(), pdf["__warm"].to_numpy()
            out = np.ones(n, dtype=bool)
            brk = np.flatnonzero((keys[1:] != keys[:-1]) | (pieces[1:] != pieces[:-1])) + 1
            for a, b in zip(np.r_[0, brk].tolist(), np.r_[brk, n].tolist()):
                fresh = (keys[a], pieces[a]) != cur
                if fresh:
                    cur = (keys[a], pieces[a])
                    acc.clear()
                if fresh and b - a <= limit:
                    acc.extend(us[a:b].tolist())
                    continue
                for i in range(a, b):
                    t = us[i]
                    while acc and acc[0] <= t - window_us:
                        acc.popleft()
                    if warm[i] or len(acc) < limit:
                        acc.append(t)
                    else:
                        out[i] = False
            res = pdf[keep].copy()
            res["accepted"] = out
            yield res[~warm]
    return run


def rate_limit(requests: DataFrame, key: str, ts: str, id_col: str, limit: int = RATE_LIMIT_MAX,
               window_seconds: int = RATE_LIMIT_WINDOW_SECONDS, bucket_seconds: int = 3600) -> DataFrame:
    """Add ``accepted`` and ``error_reason`` to every request row. Null customers are one customer."""
    window_us = window_seconds * 1_000_000
    bucket_us = max(bucket_seconds * 1_000_000, 2 * window_us)
    keep = list(requests.columns)
    r = requests.withColumns({"__us": _micros(ts), KEY: F.struct(key)})
    own = F.floor(F.col("__us") / bucket_us)
    # the last two windows of a bucket are seen by the next one too
    late = F.col("__us") > (own + 1) * bucket_us - 2 * window_us
    b = r.withColumn(BUCKET, F.explode(F.when(late, F.array(own, own + 1)).otherwise(F.array(own))))
    w = Window.partitionBy(KEY, BUCKET).orderBy("__us", id_col)
    # at most ``limit`` attempts in the trailing two windows, this one included: then every attempt of
    # the last window was accepted, and the replay can begin here with those as warm-up
    earlier = F.lag("__us", limit).over(w)
    real = F.floor(F.col("__us") / bucket_us) == F.col(BUCKET)
    at = F.struct(F.col("__us").alias("us"), F.col(id_col).alias("id"))
    safe = real & (earlier.isNull() | (earlier <= F.col("__us") - 2 * window_us))
    b = b.withColumns({"__real": real, "__at": at, "__safe": safe})
    b = b.withColumn("__cut", F.min(F.when(F.col("__safe"), F.col("__at"))).over(Window.partitionBy(KEY, BUCKET)))
    b = b.filter("__real")
    s = b.groupBy(KEY, BUCKET).agg(F.min("__cut").alias("__c"))
    by = Window.partitionBy(KEY).orderBy(BUCKET)
    has = F.col("__c").isNotNull().cast("long")
    s = s.select(KEY, BUCKET, (F.sum(has).over(by) - has).alias("__before"),
                 F.first("__c", ignorenulls=True).over(by.rowsBetween(1, Window.unboundedFollowing)).alias("__next"))
    b = b.join(s, [KEY, BUCKET])
    after = F.coalesce(F.col("__at") >= F.col("__cut"), F.lit(False))
    piece = F.col("__before") + after.cast("long")
    upcoming = F.when(after | F.col("__cut").isNull(), F.col("__next")).otherwise(F.col("__cut"))
    unit = lambda n, warm: F.struct(n.alias("n"), F.lit(warm).alias("warm"))
    spread = F.explode(F.when(F.col("__us") > upcoming["us"] - window_us, F.array(unit(piece, False), unit(piece + 1, True)))
                       .otherwise(F.array(unit(piece, False)))).alias("__u")
    work = b.select(*keep, F.col(key).cast("string").alias("__k"), "__us", spread)
    work = (work.select(*keep, "__k", "__us", F.col("__u.n").alias("__piece"), F.col("__u.warm").alias("__warm"))
            .repartition("__k", "__piece").sortWithinPartitions("__k", "__piece", "__us", id_col))
    schema = T.StructType([*requests.schema.fields, T.StructField("accepted", T.BooleanType())])
    out = work.mapInPandas(_replay(limit, window_us, keep), schema)
    return out.withColumn("error_reason", F.when(~F.col("accepted"), F.lit(RATE_LIMIT_REASON)))


def rate_limit_replay(rows, limit: int, window_seconds: float):
    """Sequential reference replay (tests): rows = [(key, ts_seconds, id)] -> {id: accepted}."""
    store: dict = {}
    res = {}
    for k, t, i in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        lst = [x for x in store.get(k, []) if x > t - window_seconds]
        if len(lst) >= limit:
            res[i] = False
        else:
            lst.append(t)
            res[i] = True
        store[k] = lst
    return res

