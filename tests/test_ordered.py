"""The bucketed ordered scans equal plain per-key windows, also with a hot key."""
import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from lakebank.operators.ordered import next_value, prev_value, running, time_bucket


def _events(spark):
    rnd = random.Random(7)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(3000):
        k = 0 if i % 3 == 0 else rnd.randint(1, 40)      # key 0 holds a third of all rows
        rows.append((i, k, t0 + dt.timedelta(seconds=rnd.randint(0, 86400 * 5)), rnd.choice([None, 1, 2, 3])))
    return spark.createDataFrame(rows, "id long, k long, ts timestamp_ntz, v int")


def test_lead_lag_running_match_plain_windows(spark):
    e = _events(spark)
    w = Window.partitionBy("k").orderBy("ts", "id")
    b = time_bucket("ts", 3600)
    plain = (e.withColumn("nx", F.lead("v").over(w)).withColumn("pv", F.lag("v").over(w))
             .withColumn("rs", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)))
             .withColumn("rm", F.max("v").over(w.rowsBetween(Window.unboundedPreceding, -1))))
    got = next_value(e, ["k"], ["ts", "id"], "v", "nx", b)
    got = prev_value(got, ["k"], ["ts", "id"], "v", "pv", b)
    got = running(got, ["k"], ["ts", "id"], {"rs": (F.col("v"), "sum")}, b)
    got = running(got, ["k"], ["ts", "id"], {"rm": (F.col("v"), "max")}, b, include_current=False)
    cols = ["id", "nx", "pv", "rs", "rm"]
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == sorted(
        tuple(r) for r in plain.select(*cols).collect())
