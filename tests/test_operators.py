"""Edge cases of single operators on hand-made frames."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakebank.functions.expr import code_map, code_set_map, mask_account, mask_card, mask_pan, money
from lakebank.operators import cdc, clean, kpi, retrieval
from lakebank.operators.quality import (apply_expectations, expect, expect_or_drop, expect_or_fail,
                                        expectation_report)


def test_masks(spark):
    df = spark.createDataFrame([("1234567812345678",), ("123",), (None,), ("",)], "n string")
    r = df.select(mask_pan("n").alias("p"), mask_account("n").alias("a"), mask_card("n").alias("c")).collect()
    assert r[0]["p"] == "****-****-****-5678" and r[0]["a"] == "****5678" and r[0]["c"] == "**** **** **** 5678"
    assert r[1]["p"] == "****-****-****-****" and r[1]["a"] == "****"
    assert r[2]["p"] is None and r[2]["a"] == "****"
    assert r[3]["a"] == "****"


def test_code_maps(spark):
    df = spark.createDataFrame([("CR",), ("PG",), ("ZZ",), (None,)], "c string")
    assert [r[0] for r in df.select(code_map("c")).collect()] == ["CREDITO", "PAGO_SERVICIO", "OTROS", "OTROS"]
    df = spark.createDataFrame([("01",), ("B",), ("03",), ("x",), (None,)], "c string")
    assert [r[0] for r in df.select(code_set_map("c")).collect()] == [
        "ACTIVA", "BLOQUEADA", "CANCELADA", "DESCONOCIDO", "DESCONOCIDO"]


def test_money_format(spark):
    df = spark.createDataFrame([(1234567.5,), (-1234.5,), (0.0,)], "x double")
    assert [r[0] for r in df.select(money("x")).collect()] == ["1,234,567.50", "-1,234.50", "0.00"]


def test_casts_and_quality(spark):
    raw = spark.createDataFrame([("10.5", 1), ("0.004", 2), ("abc", 3), ("7", None)], "monto string, cuenta_id long")
    c = clean.silver_casts(raw.withColumn("fecha_transaccion", F.lit("2024-01-01 10:00:00")))
    rules = [expect_or_drop("monto_valido", "monto IS NOT NULL AND monto != 0"),
             expect_or_drop("cuenta_existe", "cuenta_id IS NOT NULL"), expect("w", "monto > 100")]
    kept = apply_expectations(c, rules).collect()
    assert [float(r["monto"]) for r in kept] == [10.5]          # 0.004 rounds to 0.00 and is dropped
    rep = {r["rule"]: (r["passed_records"], r["failed_records"]) for r in expectation_report(c, rules).collect()}
    assert rep == {"monto_valido": (2, 2), "cuenta_existe": (3, 1), "w": (0, 4)}


def test_fail_rule_raises(spark):
    df = spark.createDataFrame([(1,), (None,)], "tarjeta_id long")
    with pytest.raises(Exception, match="tarjeta_id_not_null"):
        apply_expectations(df, [expect_or_fail("tarjeta_id_not_null", "tarjeta_id IS NOT NULL")]).collect()


def test_dedup_latest_tie_breaker(spark):
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([(1, t, 1, "a"), (1, t, 2, "b"), (2, t, 5, "c"), (2, t - dt.timedelta(1), 9, "d")],
                               "k long, ts timestamp_ntz, v long, x string")
    r = {row["k"]: row["x"] for row in clean.dedup_latest(df, ["k"], ["ts", "v"]).collect()}
    assert r == {1: "b", 2: "c"}


def _ts(h):
    return dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)


def test_scd2_deletes_and_truncates(spark):
    rows = [(1, "a", "I", _ts(0), 1), (1, "b", "U", _ts(2), 2), (2, "x", "I", _ts(3), 3),
            (9, None, "TRUNCATE", _ts(5), 4), (1, "c", "U", _ts(6), 5), (1, None, "D", _ts(8), 6),
            (2, "y", "U", _ts(50), 7)]
    ch = spark.createDataFrame(rows, "k long, v string, op string, ts timestamp_ntz, id long")
    out = cdc.apply_changes(ch, ["k"], ["ts", "id"], op_col="op", except_columns=["op"])
    got = sorted((r["k"], r["v"], r["__START_AT"], r["__END_AT"]) for r in out.collect())
    assert got == [(1, "a", _ts(0), _ts(2)), (1, "b", _ts(2), _ts(5)), (1, "c", _ts(6), _ts(8)),
                   (2, "x", _ts(3), _ts(5)), (2, "y", _ts(50), None)]
    s1 = sorted((r["k"], r["v"]) for r in cdc.apply_changes(ch, ["k"], ["ts", "id"], op_col="op",
                                                            except_columns=["op"], scd_type=1).collect())
    assert s1 == [(2, "y")]


def test_change_feed(spark):
    b = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k long, v string")
    a = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "k long, v string")
    got = sorted((r["k"], r["v"], r["_change_type"]) for r in cdc.change_feed(b, a, ["k"]).collect())
    assert got == [(2, "B", "update_postimage"), (2, "b", "update_preimage"), (3, "c", "delete"),
                   (4, "d", "insert")]


def test_daily_balance_unmatched_account(spark):
    acc = spark.createDataFrame([(1, "AHORRO", "S", "PEN", 100.0), (2, "AHORRO", "S", "PEN", 50.0)],
                                "cuenta_id long, tipo_producto string, segmento_cliente string, moneda string, "
                                "saldo_inicial double").withColumn("saldo_inicial", F.col("saldo_inicial").cast(
                                    "decimal(18,2)"))
    tx = spark.createDataFrame([(1, 10.0, "CREDITO", _ts(1)), (1, 4.0, "DEBITO", _ts(2)), (1, 3.0, "OTROS", _ts(3))],
                               "cuenta_id long, monto double, tipo_transaccion_desc string, "
                               "fecha_transaccion timestamp_ntz").withColumn("monto", F.col("monto").cast(
                                   "decimal(18,2)"))
    r = {x["cuenta_id"]: x for x in kpi.gold_daily_balances(acc, tx, "2024-02-01").collect()}
    assert float(r[1]["saldo_cierre"]) == 106.0 and r[1]["num_transacciones"] == 3
    assert float(r[2]["saldo_cierre"]) == 50.0 and r[2]["total_creditos"] is None
    assert r[2]["fecha_corte"] == dt.date(2024, 2, 1)


def test_doc_upsert_latest_wins(spark):
    tgt = spark.createDataFrame([("1", "t1", "c1"), ("2", "t2", "c2")], "id string, title string, content string")
    tgt = tgt.withColumn("chunk_id", F.col("id"))
    batch = spark.createDataFrame([("2", "n2a", "x", 1), ("2", "n2b", "y", 2), ("3", "n3", "z", 1)],
                                  "id string, title string, content string, _seq int")
    got = sorted((r["id"], r["title"], r["chunk_id"]) for r in retrieval.doc_upsert(tgt, batch).collect())
    assert got == [("1", "t1", "1"), ("2", "n2b", "2"), ("3", "n3", "3")]


def test_knn_matches_brute_force(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    docs = [(str(i), [float(x) for x in rng.normal(size=8)]) for i in range(300)]
    qs = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(700)]
    c = spark.createDataFrame(docs, "id string, content_vector array<double>").repartition(5)
    q = spark.createDataFrame(qs, "query_id long, query_vector array<double>")
    got = {(r["query_id"], r["rank"]): r["id"] for r in retrieval.knn_topk(c, q, 4, corpus_tiles=3, query_tiles=2).collect()}
    got2 = {(r["query_id"], r["rank"]): r["id"] for r in retrieval.knn_topk(c, q, 4).collect()}
    assert got2 == got
    D = np.array([d[1] for d in docs])
    for qi, v in qs[::37]:
        s = D @ np.array(v)
        order = sorted(range(len(docs)), key=lambda j: (-s[j], docs[j][0]))[:4]
        assert [got[(qi, r + 1)] for r in range(4)] == [docs[j][0] for j in order]


def test_rate_limit_random_with_tiny_batches(spark):
    import random

    from lakebank.operators.limits import rate_limit, rate_limit_replay
    rnd = random.Random(3)
    t0 = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(2000):
        c = "hot" if i % 3 == 0 else f"c{rnd.randint(0, 30)}"
        rows.append((i, c, t0 + dt.timedelta(seconds=rnd.randint(0, 4000))))
    df = spark.createDataFrame(rows, "request_id long, customer_id string, ts timestamp_ntz")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        for limit, win in [(3, 60), (5, 600), (1, 30)]:
            got = {r[0]: r[1] for r in rate_limit(df, "customer_id", "ts", "request_id", limit, win)
                   .select("request_id", "accepted").collect()}
            exp = rate_limit_replay([(c, t.timestamp(), i) for i, c, t in rows], limit, win)
            assert got == exp
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_cdc_stream_target_replayed_epoch_is_a_no_op(spark):
    from lakebank.session import scratch_path
    from lakebank.streaming.cdc_stream import CdcTarget
    rows = [(1, "a", "I", _ts(0), 1), (2, "x", "I", _ts(1), 2), (1, "b", "U", _ts(2), 3)]
    ch = spark.createDataFrame(rows, "k long, v string, op string, ts timestamp_ntz, id long")
    t = CdcTarget(scratch_path(spark, "cdc-idem"), ["k"], ["ts", "id"], op_col="op", except_columns=["op"])
    t.foreach_batch(ch.filter("id < 3"), 0)
    t.foreach_batch(ch.filter("id = 3"), 1)
    first = sorted(tuple(r) for r in t.current(spark).collect())
    t.foreach_batch(ch.filter("id = 3"), 1)             # the engine replays epoch 1 after a failure
    assert sorted(tuple(r) for r in t.current(spark).collect()) == first
    assert [(r[0], r[1]) for r in first] == [(1, "a"), (1, "b"), (2, "x")]


def test_cdc_truncate_at_the_same_time_as_changes(spark):
    """Ten versions and a truncate at one instant: the sequence's second part decides, in batch and in the stream alike."""
    from lakebank.operators.cdc import apply_changes
    from lakebank.session import scratch_path
    from lakebank.streaming.cdc_stream import CdcTarget
    rows = [(i, "v", "I", _ts(0), i) for i in range(9)] + [(None, None, "TRUNCATE", _ts(0), 9), (10, "v", "I", _ts(0), 10)]
    ch = spark.createDataFrame(rows, "k long, v string, op string, ts timestamp_ntz, id long")
    args = dict(op_col="op", except_columns=["op"])
    batch = apply_changes(ch, ["k"], ["ts", "id"], **args)
    assert [r[0] for r in batch.filter("__END_AT is null").collect()] == [10]
    t = CdcTarget(scratch_path(spark, "cdc-ties"), ["k"], ["ts", "id"], **args)
    for epoch, part in enumerate(["id < 4 or id = 10", "id between 4 and 8", "id = 9"]):
        t.foreach_batch(ch.filter(part), epoch)
    assert sorted(map(tuple, t.current(spark).collect())) == sorted(map(tuple, batch.collect()))


def test_rate_limit_of_one_steady_customer_is_cut(spark):
    """A customer without any pause: the log is still cut about once per time bucket, and the decisions stay exact."""
    from lakebank.operators.limits import rate_limit, rate_limit_replay
    at = lambda sec: _ts(0) + dt.timedelta(seconds=sec)
    rows = [(i, "C1", at(10 * i)) for i in range(2000)] + [(5000 + i, "C1", at(7000 + i % 40)) for i in range(90)] + [(9000, None, at(0))]
    df = spark.createDataFrame(rows, "request_id long, customer_id string, ts timestamp_ntz")
    out = rate_limit(df, "customer_id", "ts", "request_id", 30, 60, bucket_seconds=600)
    got = {r[0]: r[1] for r in out.select("request_id", "accepted").collect()}
    assert got == rate_limit_replay([(str(c), t.timestamp(), i) for i, c, t in rows], 30, 60)
    assert not all(got.values())
    merge = "spark.sql.adaptive.coalescePartitions.enabled"       # tiny partitions are merged else
    spark.conf.set(merge, "false")
    try:
        sizes = [r[0] for r in out.groupBy(F.spark_partition_id()).count().select("count").collect()]
    finally:
        spark.conf.set(merge, "true")
    assert max(sizes) < 0.6 * len(rows)


def test_rate_limit_stream_late_rows_and_arrow_pieces(spark):
    """Interleaved parts keep every id; small Arrow pieces decide as the batch operator does."""
    from lakebank.operators.limits import rate_limit
    from lakebank.streaming.harness import run_in_parts
    from lakebank.streaming.rate_limit_stream import rate_limit_stream
    rows = [(i, f"C{i // 2 % 2}", _ts(0) + dt.timedelta(seconds=(i * 7919) % 400)) for i in range(400)]
    df = spark.createDataFrame(rows, "request_id long, customer_id string, ts timestamp_ntz")
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        run = lambda parts, late: spark.read.parquet(run_in_parts(spark, df, parts, "rl", build=lambda s: rate_limit_stream(s, "customer_id", "ts", "request_id", late, 5, 60))[0]).collect()
        whole = {r["request_id"]: r["accepted"] for r in run([F.lit(True)], 0)}
        want = {r["request_id"]: r["accepted"] for r in rate_limit(df, "customer_id", "ts", "request_id", 5, 60).collect()}
        assert whole == want
        parts = run([F.col("request_id") % 2 == 0, F.col("request_id") % 2 == 1], 30)
        assert sorted(r["request_id"] for r in parts) == list(range(400))
        assert any(r["late"] for r in parts) and not any(r["late"] and r["accepted"] for r in parts)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)


def test_request_check_trims_all_white_space(spark):
    from lakebank.operators.guard import request_check
    df = spark.createDataFrame([(1, "\t\n ", "Bearer \tabc\n", "C01"), (2, "\u00a0hola\r\n", "Bearer x", "C01")], "id long, message string, authorization string, customer_id string")
    got = {r["id"]: (r["token"], r["message_clean"], r["is_blank"]) for r in request_check(df).collect()}
    assert got == {1: ("abc", "", True), 2: ("x", "hola", False)}
