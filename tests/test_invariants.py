"""Invariants over whole test tables (sf0.01) and stream = batch."""
from collections import defaultdict

from pyspark.sql import functions as F

from paths import SF_MID
from lakebank.operators import sessions
from lakebank.operators.limits import rate_limit, rate_limit_replay
from lakebank.plans import medallion as M
from lakebank.plans.registry import QUERIES
from lakebank.sources import fixtures as FX


def test_scd2_intervals_do_not_overlap(spark):
    h = M.silver_accounts(FX.account_changes(spark, SF_MID)).collect()
    by = defaultdict(list)
    for r in h:
        by[r["cuenta_id"]].append((r["__START_AT"], r["__END_AT"]))
    for k, iv in by.items():
        iv.sort()
        assert sum(1 for _, e in iv if e is None) <= 1
        for (s1, e1), (s2, _) in zip(iv, iv[1:]):
            assert e1 is not None and e1 <= s2
        for s, e in iv:
            assert e is None or s <= e


def test_trim_never_exceeds_cap(spark):
    t = sessions.history_trim(FX.messages(spark, SF_MID), cap=5)
    assert t.groupBy("session_id").count().agg(F.max("count")).first()[0] <= 5


def test_rate_limit_equals_replay_and_respects_window(spark):
    e = FX.requests(spark, SF_MID).select("request_id", "customer_id", "ts")
    got = {r[0]: r[1] for r in rate_limit(e, "customer_id", "ts", "request_id", 2, 86400)
           .select("request_id", "accepted").collect()}
    rows = [(r["customer_id"], r["ts"].timestamp(), r["request_id"]) for r in e.collect()]
    assert got == rate_limit_replay(rows, 2, 86400)
    acc = defaultdict(list)
    for k, t, i in rows:
        if got[i]:
            acc[k].append(t)
    for ts in acc.values():
        ts.sort()
        for a, b in zip(ts, ts[2:]):
            assert b - a >= 86400          # never 3 accepted inside one sliding day


def test_rate_limit_stream_equals_batch(spark):
    s = {r[0]: r[1] for r in QUERIES["rate_limit_stream"](spark, SF_MID).select("request_id", "accepted").collect()}
    b = {r[0]: r[1] for r in QUERIES["rate_limit_day2"](spark, SF_MID).select("request_id", "accepted").collect()}
    assert s == b


def test_cdc_stream_equals_batch(spark):
    cols = ["cuenta_id", "saldo", "estado", "operacion", "__START_AT", "__END_AT"]
    s = sorted(tuple(r) for r in QUERIES["stream_cdc_target"](spark, SF_MID).select(*cols).collect())
    b = sorted(tuple(r) for r in QUERIES["cdc_scd2"](spark, SF_MID).select(*cols).collect())
    assert s == b


def test_chat_audit_statuses(spark):
    a = QUERIES["chat_audit"](spark, SF_MID)
    st = {r[0]: r[1] for r in a.groupBy("http_status").count().collect()}
    assert set(st) <= {200, 400, 401, 422} and sum(st.values()) == 10000
    assert a.filter((F.col("check_status") == 200) & (F.col("security_error") == "RATE_LIMIT_EXCEEDED")
                    & (F.col("http_status") != 401)).count() == 0


def test_chat_audit_equals_python_replay(spark):
    """X8 has no oracle SQL (sequential limiter): replay the request pipeline in Python."""
    import datetime as dt

    from lakebank.operators.guard import BANKING_BLOCK_PATTERNS
    req = {r["request_id"]: r for r in FX.requests(spark, SF_MID).collect()}
    cl = {r["request_id"]: r for r in FX.claims(spark, SF_MID).collect()}
    sv = {r["request_id"]: r for r in FX.request_severities(spark, SF_MID).collect()}
    epoch0 = dt.datetime(1970, 1, 1)

    def check(r):
        m = r["message"]
        if m is None or not (1 <= len(m) <= 2000):
            return 422
        if not (r["authorization"] or "").startswith("Bearer "):
            return 401
        if len(r["customer_id"] or "") < 3:
            return 400
        return 200

    status = {i: check(r) for i, r in req.items()}
    ok = [(r["customer_id"], (r["ts"] - epoch0).total_seconds(), i) for i, r in req.items() if status[i] == 200]
    accepted = rate_limit_replay(ok, 2, 3600)
    expect = {}
    for i, r in req.items():
        if status[i] != 200:
            expect[i] = status[i]
            continue
        c = cl[i]
        secs = int((r["ts"] - epoch0).total_seconds())
        if not accepted[i]:
            expect[i] = 401
            continue
        if c["exp"] <= secs or r["customer_id"] not in (c["sub"] or "", c["oid"] or "",
                                                           c["extension_customer_id"] or ""):
            expect[i] = 401
            continue
        text = r["message"].strip().lower()
        s = sv[i]
        sev = [s[k] for k in ("hate", "violence", "self_harm", "sexual")]
        blocked = any(p in text for p in BANKING_BLOCK_PATTERNS) or (
            any(v is not None for v in sev) and max(v or 0 for v in sev) >= 2)
        expect[i] = 422 if blocked else 200
    got = {r["request_id"]: r["http_status"] for r in QUERIES["chat_audit"](spark, SF_MID)
           .select("request_id", "http_status").collect()}
    assert got == expect


def test_cdc_stream_in_order_arrival_equals_batch(spark):
    """Parts arrive in time order."""
    from lakebank.session import scratch_path
    from lakebank.streaming.cdc_stream import CdcTarget, start_cdc_stream
    from lakebank.streaming.harness import run_in_parts
    ch = FX.account_changes(spark, SF_MID)
    target = CdcTarget(scratch_path(spark, "cdc-inorder"), ["cuenta_id"], ["_ingest_timestamp", "_change_id"],
                       except_columns=M.CDC_EXCEPT_COLUMNS + ["_change_id"])
    ts = F.col("_ingest_timestamp")
    cuts = [F.lit(x).cast("timestamp_ntz") for x in ("2024-01-08", "2024-01-16", "2024-01-24")]
    parts = [ts < cuts[0], (ts >= cuts[0]) & (ts < cuts[1]), (ts >= cuts[1]) & (ts < cuts[2]), ts >= cuts[2]]
    run_in_parts(spark, ch, parts, "cdc-inorder",
                 start=lambda src, ckpt: start_cdc_stream(spark, src, ch.schema, target, ckpt))
    cols = ["cuenta_id", "saldo", "estado", "operacion", "__START_AT", "__END_AT"]
    s = sorted(tuple(r) for r in M.cast_money(target.current(spark)).select(*cols).collect())
    b = sorted(tuple(r) for r in QUERIES["cdc_scd2"](spark, SF_MID).select(*cols).collect())
    assert s == b


def test_cdc_stream_incremental_path_with_late_truncates(spark):
    """Later batches touch few keys and bring every truncate late; the result equals batch."""
    from lakebank.session import scratch_path
    from lakebank.streaming.cdc_stream import CdcTarget, start_cdc_stream
    from lakebank.streaming.harness import run_in_parts
    ch = FX.account_changes(spark, SF_MID)
    target = CdcTarget(scratch_path(spark, "cdc-incr"), ["cuenta_id"], ["_ingest_timestamp", "_change_id"],
                       except_columns=M.CDC_EXCEPT_COLUMNS + ["_change_id"])
    u, tr = F.col("cuenta_id"), F.col("operacion") == "TRUNCATE"
    parts = [(u < 100) & ~tr, (u >= 100) & (u < 120) & ~tr, ((u >= 120) & ~tr) | tr]
    run_in_parts(spark, ch, parts, "cdc-incr",
                 start=lambda src, ckpt: start_cdc_stream(spark, src, ch.schema, target, ckpt))
    cols = ["cuenta_id", "saldo", "estado", "operacion", "__START_AT", "__END_AT"]
    s = sorted(tuple(r) for r in M.cast_money(target.current(spark)).select(*cols).collect())
    b = sorted(tuple(r) for r in QUERIES["cdc_scd2"](spark, SF_MID).select(*cols).collect())
    assert s == b
