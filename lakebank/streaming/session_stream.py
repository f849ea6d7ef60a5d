"""Streaming session expiry (I3), with the batch rules of ``sessions.session_ttl``.

A session ends ``gap_seconds`` after its last event or at once on a logout. The
state per customer is its one open session, kept by bucket of customers
(``buckets``). No watermark drops an event: one
that lies before the open session and does not touch it comes out as a session
of its own, marked ``late``. A session that is still open when a run stops
stays in the checkpoint's state; ``open_sessions`` reads it from there, so
closed and open sessions together hold every event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupStateTimeout

from lakebank.functions.expr import epoch_micros
from lakebank.streaming.buckets import BUCKETS, bucket_of, by_customer, from_text, order_of, text_of


def _cut(us, logout, ttl_us: int):
    """Sessions of sorted events as (first, last, count, ended by logout): a gap or a logout before an event begins one."""
    import numpy as np

    fresh = np.r_[True, (np.diff(us) >= ttl_us) | logout[:-1]]
    start = np.flatnonzero(fresh)
    end = np.r_[start[1:], len(us)]
    return list(zip(us[start].tolist(), us[end - 1].tolist(), (end - start).tolist(), logout[end - 1].tolist()))


def _step(held, us, logout, ttl_us: int):
    """(open session, sorted events) of one customer -> (sessions that came to an end, the open one or None)."""
    out = []
    if held is not None:
        before = us < held[0] - ttl_us
        out += [(a, b, n, "late") for a, b, n, _ in _cut(us[before], logout[before], ttl_us)] if before.any() else []
        us, logout = us[~before], logout[~before]
    found = [[*x] for x in _cut(us, logout, ttl_us)] if len(us) else []
    if held is not None and found and found[0][0] - held[1] < ttl_us:      # goes on with the open session
        found[0] = [min(held[0], found[0][0]), max(held[1], found[0][1]), held[2] + found[0][2], found[0][3]]
    elif held is not None:
        found.insert(0, [*held, False])
    out += [(a, b, n, "logout" if lo else "ttl") for a, b, n, lo in found[:-1]]
    if found and found[-1][3]:
        out.append((*found[-1][:3], "logout"))
        found = []
    return out, tuple(found[-1][:3]) if found else None


def _session_fn(cols: list[str], ttl_us: int):
    def fn(k, pdfs, state):
        import numpy as np
        import pandas as pd

        # a customer with an event without time has floats here: such times are not kept
        at = lambda xs: pd.Series(np.array([int(x) if x == x else -2**63 for x in xs], np.int64).view("datetime64[us]"))
        whole = lambda xs: [x if isinstance(x, int) else None for x in xs]
        held = {x[0]: x[1:] for x in zip(*state.get[:4])} if state.exists else {}
        ev, customers = by_customer(pdfs)
        times, logouts = ev["__us"].to_numpy(), ev["__logout"].to_numpy(dtype=bool)
        keys, out = [], []
        for key, a, b in customers:
            us = times[a:b]
            if us.dtype != np.int64 and not np.isnan(us).any():
                us = us.astype(np.int64)
            ended, still = _step(held.pop(key, None), us, logouts[a:b], ttl_us)
            keys += [key] * len(ended)
            out += ended
            if still is not None:
                held[key] = still
        if held:
            state.update((list(held), *(whole(x) for x in zip(*held.values())), None))
        elif state.exists:
            state.remove()
        if out:
            first, last, n, how = zip(*out)
            ends = [x + (0 if h == "logout" else ttl_us) for x, h in zip(last, how)]
            yield pd.DataFrame(dict(zip(cols, (keys, at(first), at(last), n, how, at(ends)))))
    return fn


def _schema(key: str, key_type) -> T.StructType:
    ntz = T.TimestampNTZType()
    return T.StructType([T.StructField(key, key_type), T.StructField("started_at", ntz), T.StructField("last_activity", ntz),
                         T.StructField("n_events", T.LongType()), T.StructField("ended_by", T.StringType()), T.StructField("expires_at", ntz)])


def session_stream(events: DataFrame, key: str, ts: str, id_col: str, logout=None, gap_seconds: int = 1800,
                   buckets: int = BUCKETS) -> DataFrame:
    """Closed sessions: ended by ``ttl`` (shown by the customer's next event), by ``logout``, or ``late``."""
    lo = F.lit(False) if logout is None else F.coalesce(logout, F.lit(False))
    kind = events.schema[key].dataType
    e = events.select(bucket_of(key, buckets), text_of(key, kind).alias("__key"), order_of(id_col, events.schema[id_col].dataType).alias("__id"),
                      epoch_micros(ts).alias("__us"), lo.alias("__logout"))
    out = _schema(key, T.StringType())
    held = T.StructType([T.StructField("keys", T.ArrayType(T.StringType())), *[T.StructField(c, T.ArrayType(T.LongType())) for c in ("start_us", "last_us", "n")],
                         T.StructField("key_type", kind)])            # always null: tells readers the keys' type
    closed = e.groupBy("__bucket").applyInPandasWithState(_session_fn(out.names, gap_seconds * 1_000_000), out, held, "append",
                                                          GroupStateTimeout.NoTimeout)
    return closed.withColumn(key, from_text(key, kind))


def open_sessions(spark: SparkSession, checkpoint: str, key: str, gap_seconds: int = 1800) -> DataFrame:
    """Sessions still open in the stream's state, ``ended_by`` = ``open``."""
    s = spark.read.format("statestore").load(checkpoint).select("value.groupState.*")
    at = lambda us: F.timestamp_add("MICROSECOND", us, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    g = s.select(F.explode(F.arrays_zip("keys", "start_us", "last_us", "n")).alias("g")).select("g.*")
    return g.select(from_text("keys", s.schema["key_type"].dataType).alias(key), at(F.col("start_us")).alias("started_at"), at(F.col("last_us")).alias("last_activity"),
                    "n", F.lit("open").alias("ended_by"), at(F.col("last_us") + gap_seconds * 1_000_000).alias("expires_at")).withColumnRenamed("n", "n_events")
