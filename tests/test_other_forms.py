"""Sweep over truncates, digests, observed rules, bucketed join and session windows against their plain forms."""
import datetime as dt
import random

from pyspark.sql import functions as F

from lakebank.operators import cdc, quality, sessions
from lakebank.sources import sinks

START = dt.datetime(2024, 5, 1)


def test_thousands_of_truncates_on_one_day(spark):
    rng = random.Random(2)
    at = lambda s: START + dt.timedelta(seconds=s)
    versions = [(rng.choice(["a", None]), at(rng.randrange(80_000)), i) for i in range(3000)] + [("b", START - dt.timedelta(days=400), 1), ("b", START + dt.timedelta(days=400), 2)]
    truncates = [(at(rng.randrange(80_000)), rng.randrange(6000)) for _ in range(2000)] + [(versions[5][1], versions[5][2])]
    v = spark.createDataFrame(versions, "k string, ts timestamp_ntz, seq int")
    t = spark.createDataFrame(truncates, "ts timestamp_ntz, seq int")
    got = sorted(map(str, (tuple(r) for r in cdc.next_truncate(v, t, ["ts", "seq"]).collect())))
    after = lambda ts, seq: min(((a, b) for a, b in truncates if (a, b) > (ts, seq)), default=(None,))[0]
    assert got == sorted(str((k, ts, seq, after(ts, seq))) for k, ts, seq in versions)
    assert cdc.next_truncate(v, t.limit(0), ["ts", "seq"]).where("__next_trunc is not null").count() == 0
    assert cdc.next_truncate(v.limit(0), t, ["ts", "seq"]).count() == 0


def test_digests_join_changed_buckets_only(spark):
    before = spark.range(5000).select("id", (F.col("id") * 3).alias("v"), F.lit(None).cast("string").alias("n"))
    after = (before.where("id <> 17").withColumn("v", F.when(F.col("id") == 40, F.lit(-1)).otherwise(F.col("v")))
             .withColumn("n", F.when(F.col("id") == 41, F.lit("x")).otherwise(F.col("n"))).union(spark.createDataFrame([(9999, 1, None)], before.schema)))
    rows = lambda df: sorted(map(str, (tuple(r) for r in df.collect())))
    got = cdc.change_feed_digests(before, after, ["id"], buckets=512)
    assert rows(got) == rows(cdc.change_feed(before, after, ["id"])) and got.count() == 6
    assert cdc.change_feed_digests(before, before, ["id"]).collect() == []


RULES = [quality.expect_or_drop("positive", "v > 0"), quality.expect("known", "k IN ('a', 'b')")]


def test_observed_counts_in_batch_and_stream(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (-1, "b"), (None, "c"), (5, None)], "v int, k string")
    watched, seen = quality.observe_expectations(df, RULES)
    quality.apply_expectations(watched, RULES).write.parquet(str(tmp_path / "out"))
    rows = lambda x: sorted(map(tuple, x.collect()))
    assert rows(quality.observed_report(spark, seen, RULES)) == rows(quality.expectation_report(df, RULES))
    df.write.parquet(str(tmp_path / "src"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "src")).observe("rules", *quality.expectation_metrics(RULES))
    q = (quality.apply_expectations(stream, RULES).writeStream.format("parquet").option("path", str(tmp_path / "sink"))
         .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start())
    q.awaitTermination()
    got = next(p.observedMetrics["rules"] for p in q.recentProgress if p.numInputRows)
    assert (got.p0, got.f0, got.p1, got.f1) == (2, 2, 2, 2)


def test_bucketed_join_has_no_exchange(spark):
    a = spark.range(500).select("id", (F.col("id") % 7).alias("x"))
    b = spark.range(0, 900, 3).select("id", F.lit("y").alias("y"))
    got = sinks.bucketed_pair(a, b, "id", lambda l, r: l.join(r, "id", "left"), buckets=8)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    assert sorted(map(tuple, got.collect())) == [(i, i % 7, "y" if i % 3 == 0 else None) for i in range(500)]


def test_session_windows_of_a_stream_leave_no_state(spark, tmp_path):
    rng = random.Random(7)
    events = [(rng.randrange(6), START + dt.timedelta(minutes=rng.randrange(3000))) for _ in range(300)] + [(None, START), (3, None)]
    batch = spark.createDataFrame(events, "user long, ts timestamp_ntz")
    want = sorted(map(tuple, sessions.session_windows(batch, "user", "ts", 1800).collect()))
    by = {}
    for u, t in sorted((e for e in events if None not in e), key=lambda e: (e[0], e[1])):
        if u in by and t - by[u][-1][1] < dt.timedelta(seconds=1800):
            by[u][-1][1:] = [t, by[u][-1][2] + 1]
        else:
            by.setdefault(u, []).append([t, t, 1])
    assert want == sorted((u, a, b, n, b + dt.timedelta(seconds=1800)) for u, x in by.items() for a, b, n in x)
    # a last event far ahead moves the watermark past every session
    src, sink, ckpt = (str(tmp_path / x) for x in ("src", "sink", "ckpt"))
    for part in (events, [(-1, START + dt.timedelta(days=900))], [(-1, START + dt.timedelta(days=900, minutes=1))]):
        spark.createDataFrame(part, batch.schema).write.mode("append").parquet(src)
        q = (sessions.session_windows(spark.readStream.schema(batch.schema).parquet(src), "user", "ts", 1800, watermark_seconds=3600).writeStream
             .format("parquet").option("path", sink).option("checkpointLocation", ckpt).outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination()
    got = sorted(map(tuple, spark.read.parquet(sink).where("user >= 0").collect()))
    assert got == want
    # the sessions' state went with them: what is left is the last event's
    assert spark.read.format("statestore").load(ckpt).count() <= 2
