"""SCD-2 target with keyed state: late, tied, restarted, empty and replayed feeds against the batch history."""
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakebank.operators.cdc import apply_changes
from lakebank.streaming.cdc_state import KeyedCdcTarget

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("amount", T.DecimalType(18, 2)), T.StructField("note", T.StringType()),
                       T.StructField("operacion", T.StringType()), T.StructField("ts", T.TimestampNTZType()), T.StructField("seq", T.LongType())])
ARGS = dict(keys=["id"], sequence_by=["ts", "seq"], except_columns=["operacion"])


def feed(n=300, seed=4):
    import decimal

    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 1, 0, 0, 0, 123456)
    rows = []
    for i in range(n):
        op = rng.choices(["I", "U", "D", "TRUNCATE", None], [3, 6, 2, 0.1, 0.3])[0]
        key = None if op == "TRUNCATE" else rng.choice([1, 1, 1, 2, 3, 4, None])
        rows.append((key, decimal.Decimal(rng.randrange(10**6)) / 100, rng.choice(['a "b"\n', None, "ñ"]), op, start + dt.timedelta(minutes=rng.randrange(n // 3)), i))
    return rows


def run(spark, target, folder, parts, checkpoint):
    for part in parts:
        spark.createDataFrame(part, SCHEMA).coalesce(2).write.mode("append").parquet(folder)
        target.start(spark.readStream.schema(SCHEMA).parquet(folder), checkpoint).awaitTermination()


def history(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


@pytest.mark.parametrize("order", ["arrival", "late", "time"])
def test_equals_the_batch_history_over_restarts(spark, tmp_path, order):
    rows = feed()
    by = {"arrival": lambda r: r[5], "late": lambda r: -r[5], "time": lambda r: (r[4], r[5])}[order]
    rows.sort(key=by)
    parts = [rows[:40], rows[40:41], rows[41:200], rows[200:]]
    base, src, ckpt = (str(tmp_path / x) for x in ("base", "src", "ckpt"))
    for part in parts:      # a new object each time: nothing lives in the process
        target = KeyedCdcTarget(base, SCHEMA, **ARGS)
        run(spark, target, src, [part], ckpt)
    want = apply_changes(spark.createDataFrame(rows, SCHEMA), **ARGS)
    got = KeyedCdcTarget(base, SCHEMA, **ARGS).current(spark)
    assert got.schema.simpleString() == want.schema.simpleString()
    assert history(got) == history(want)


def test_work_follows_the_batch(spark, tmp_path):
    rows = sorted(feed(), key=lambda r: (r[4], r[5]))
    base, src, ckpt = (str(tmp_path / x) for x in ("base", "src", "ckpt"))
    target = KeyedCdcTarget(base, SCHEMA, **ARGS)
    run(spark, target, src, [rows[:250], rows[250:260]], ckpt)
    by_epoch = {r[0]: r[1] for r in target.changed(spark).groupBy("_epoch").count().collect()}
    # ten changes write themselves and at most one closing each
    assert by_epoch[0] == 250 and 10 <= by_epoch[1] <= 20


def test_before_the_first_change(spark, tmp_path):
    target = KeyedCdcTarget(str(tmp_path / "base"), SCHEMA, **ARGS)
    assert target.current(spark).collect() == []
    run(spark, target, str(tmp_path / "src"), [[]], str(tmp_path / "ckpt"))
    assert target.current(spark).collect() == []


def test_a_replayed_epoch_replaces_its_rows(spark, tmp_path):
    target = KeyedCdcTarget(str(tmp_path / "base"), SCHEMA, **ARGS)
    batch = spark.createDataFrame([(1, 5, "version", "{}", '{"id":1}')], "__p0 long, __p1 long, __kind string, __row string, __key string").withColumn("__lead_us", F.lit(None).cast("long"))
    for _ in range(2):
        target.foreach_batch(batch, 7)
    assert target.changed(spark).count() == 1
