"""Streams that keep the state of many customers in a few buckets."""
import datetime as dt

from pyspark.sql import functions as F

from lakebank.operators import sessions
from lakebank.operators.limits import rate_limit
from lakebank.streaming.harness import run_in_parts
from lakebank.streaming.rate_limit_stream import rate_limit_stream
from lakebank.streaming.session_stream import open_sessions, session_stream

T0, BIG = dt.datetime(2024, 1, 1), 2**53 + 1          # BIG is no float


def _log(spark):
    users = [None, BIG, BIG + 1, *range(60)]
    rows = [(BIG + 7 * i if i % 50 else None, users[i * i % 63], T0 + dt.timedelta(seconds=(i * 7919) % 40000), "error" if i % 9 == 0 else "view") for i in range(900)]
    return spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz, event_type string")


def _sorted(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_session_stream_keeps_customers_in_buckets(spark):
    e, logout = _log(spark), F.col("event_type") == "error"
    day = [F.col("ts") < T0 + dt.timedelta(hours=3), (F.col("ts") >= T0 + dt.timedelta(hours=3))]
    sink, ckpt = run_in_parts(spark, e, day, "sessions-few", build=lambda s: session_stream(s, "user_id", "ts", "event_id", logout, 1800, buckets=3))
    state = spark.read.format("statestore").load(ckpt)
    assert 0 < state.count() <= 3                       # one state row per bucket, not per customer
    cols = ["user_id", "started_at", "last_activity", "n_events", "expires_at"]
    still = open_sessions(spark, ckpt, "user_id", 1800)
    assert still.schema["user_id"].dataType == e.schema["user_id"].dataType and still.count() > 3
    got = spark.read.parquet(sink).unionByName(still)
    want = sessions.session_ttl(e, "user_id", "ts", "event_id", 1800, logout)
    assert _sorted(got, "user_id", "n_events", "expires_at") == _sorted(want, "user_id", "n_events", "expires_at")
    many, ckpt = run_in_parts(spark, e, day, "sessions-many", build=lambda s: session_stream(s, "user_id", "ts", "event_id", logout, 1800))
    assert _sorted(got, *cols, "ended_by") == _sorted(spark.read.parquet(many).unionByName(open_sessions(spark, ckpt, "user_id", 1800)), *cols, "ended_by")


def test_rate_limit_stream_keeps_customers_in_buckets(spark):
    r = _log(spark).withColumn("event_id", F.coalesce("event_id", F.lit(BIG + 5))).withColumn("size", F.when(F.col("event_type") == "view", BIG))
    sink, ckpt = run_in_parts(spark, r, [F.col("ts") < T0 + dt.timedelta(hours=3), F.col("ts") >= T0 + dt.timedelta(hours=3)], "rl-few",
                              build=lambda s: rate_limit_stream(s, "user_id", "ts", "event_id", 60, 2, 9000, buckets=3))
    assert 0 < spark.read.format("statestore").load(ckpt).count() <= 3
    got = spark.read.parquet(sink)
    assert got.schema["size"].dataType == r.schema["size"].dataType
    assert _sorted(got, *r.columns) == _sorted(r, *r.columns)          # whole numbers beside nulls stay exact
    assert _sorted(got, "event_id", "ts", "accepted") == _sorted(rate_limit(r, "user_id", "ts", "event_id", 2, 9000), "event_id", "ts", "accepted")
    assert 0 < got.filter("accepted").count() < r.count() and got.filter("late").count() == 0
