"""Streaming sliding-window rate limit per customer.

``applyInPandasWithState`` keyed by bucket of customers (``buckets``). Every request gets a row, in the
micro-batch in which it arrives; no watermark drops any. A batch's rows of a
customer are decided in event-time order over all their Arrow pieces. The state
holds each customer's accepted times of the last window plus ``lateness``, and
the newest time seen. A request that is older than that newest time by more
than ``lateness`` is not decided: its row is marked ``late``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lakebank.functions.expr import epoch_micros
from lakebank.operators.limits import RATE_LIMIT_MAX, RATE_LIMIT_REASON, RATE_LIMIT_WINDOW_SECONDS
from lakebank.streaming.buckets import BUCKETS, bucket_of, by_customer, from_text, order_of, text_of

LATE_REASON = "LATE_REQUEST"


def _replay(times, accepted: list, newest, limit: int, window_us: int, late_us: int):
    """One customer's sorted times after its state -> (accepted, late) of each, and the new state."""
    oks, late = [], []
    for t in times:
        late.append(newest is not None and t < newest - late_us)
        ok = not late[-1] and sum(t - window_us < x <= t for x in accepted) < limit
        if ok:
            accepted.append(t)
        oks.append(ok)
        newest = t if newest is None else max(newest, t)
        accepted = [x for x in accepted if x > newest - late_us - window_us]
    return oks, late, accepted, newest


def _decide(limit: int, window_us: int, late_us: int, keep: list[str]):
    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState):
        held = {k: (a, n) for k, a, n in zip(*state.get)} if state.exists else {}
        rows, customers = by_customer(pdfs)
        times, oks, late = rows["__us"].tolist(), [], []
        for k, a, b in customers:
            accepted, newest = held.get(k, ([], None))
            ok, behind, accepted, newest = _replay(times[a:b], list(accepted), newest, limit, window_us, late_us)
            oks += ok
            late += behind
            # times are floats where one of the bucket is null; a null one is not kept
            held[k] = [int(x) for x in accepted if x == x], None if newest != newest else int(newest)
        res = rows[keep].copy()
        res["accepted"], res["late"] = oks, late
        state.update((list(held), *map(list, zip(*held.values()))))
        yield res
    return fn


def rate_limit_stream(requests: DataFrame, key: str, ts: str, id_col: str, lateness_seconds: int,
                      limit: int = RATE_LIMIT_MAX, window_seconds: int = RATE_LIMIT_WINDOW_SECONDS, buckets: int = BUCKETS) -> DataFrame:
    """Streaming form of ``limits.rate_limit``: adds ``accepted``, ``late`` and ``error_reason``.

    A request within the lateness counts the accepted requests of the window
    that ends with it; what was decided before stays. State is kept per customer:
    at most ``limit`` times per window, over the window and the lateness.
    """
    fields = requests.schema.fields
    # whole numbers go through pandas as text
    whole = [f.name for f in fields if isinstance(f.dataType, T.IntegralType)]
    src = requests.select(*[text_of(f.name, f.dataType).alias(f.name) if f.name in whole else f.name for f in fields], bucket_of(key, buckets),
                          text_of(key, requests.schema[key].dataType).alias("__key"), order_of(id_col, requests.schema[id_col].dataType).alias("__id"), epoch_micros(ts).alias("__us"))
    out_schema = T.StructType([*[T.StructField(f.name, T.StringType()) if f.name in whole else f for f in fields],
                               T.StructField("accepted", T.BooleanType()), T.StructField("late", T.BooleanType())])
    state_schema = T.StructType([T.StructField("keys", T.ArrayType(T.StringType())), T.StructField("accepted_us", T.ArrayType(T.ArrayType(T.LongType()))),
                                 T.StructField("newest_us", T.ArrayType(T.LongType()))])
    res = src.groupBy("__bucket").applyInPandasWithState(
        _decide(limit, window_seconds * 1_000_000, lateness_seconds * 1_000_000, requests.columns), out_schema, state_schema, "append",
        GroupStateTimeout.NoTimeout)
    res = res.withColumns({f.name: from_text(f.name, f.dataType) for f in fields if f.name in whole}) if whole else res
    return res.withColumn("error_reason", F.when(F.col("late"), F.lit(LATE_REASON)).when(~F.col("accepted"), F.lit(RATE_LIMIT_REASON)))
