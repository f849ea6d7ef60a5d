"""The reference's unit tests, re-expressed over tables (FIXTURES.md section 1)."""
import datetime as dt

from pyspark.sql import functions as F

from lakebank.operators import guard, sessions
from lakebank.operators.limits import rate_limit


def _msgs(spark, rows):
    return spark.createDataFrame(rows, "session_id string, turn long, role string, text string")


def test_history_round_trip(spark):
    m = _msgs(spark, [("test-session-001", 0, "user", "¿Cuál es mi saldo?"),
                      ("test-session-001", 1, "assistant", "Tu saldo es 1,500 PEN.")])
    h = sessions.session_history(sessions.history_trim(m)).collect()
    assert len(h) == 1 and len(h[0]["messages"]) == 2


def test_history_truncation(spark):
    rows = [("s", 0, "system", "Eres un asistente bancario.")]
    for i in range(25):
        rows += [("s", 1 + 2 * i, "user", f"Pregunta {i}"), ("s", 2 + 2 * i, "assistant", f"Respuesta {i}")]
    kept = sessions.history_trim(_msgs(spark, rows)).orderBy("pos").collect()
    assert len(kept) == 20                      # <= 20; by the rule exactly 1 system + 19 recent
    assert kept[0]["role"] == "system"
    assert [r["text"] for r in kept[-2:]] == ["Pregunta 24", "Respuesta 24"]


def test_guard_pattern_block(spark):
    df = spark.createDataFrame([("¿Me puedes dar mi número completo de tarjeta?",)], "text string")
    r = guard.guard_input(df, "text", enabled=False).collect()[0]
    assert r["is_blocked"] is True and "tarjeta" in r["reason"].lower()


def test_guard_normal_query_passes(spark):
    df = spark.createDataFrame([("¿Cuál es el saldo de mi cuenta en soles?",)], "text string")
    r = guard.guard_input(df, "text", enabled=False).collect()[0]
    assert r["is_blocked"] is False and r["reason"] == "safety_disabled"


def test_scopes_of_an_agent_token(spark):
    df = spark.createDataFrame([("banking.read banking.agent",), (None,)], "scp string")
    r = guard.scope_flags(df).collect()
    assert r[0]["has_scope"] and "banking.agent" in r[0]["scopes"]
    assert r[1]["scopes"] == ["banking.read"] and r[1]["can_query_loans"]


def test_invalid_token_echoes_customer(spark):
    req = spark.createDataFrame([(1, "CUSTOMER_001", dt.datetime(2024, 1, 1))],
                                "request_id long, customer_id string, ts timestamp_ntz")
    claims = spark.createDataFrame([(1, None, None, None, None, None)],
                                   "request_id long, sub string, oid string, extension_customer_id string, "
                                   "scp string, exp long")
    r = guard.token_check(req.join(claims, "request_id", "left")).collect()[0]
    # no key store, so validation is skipped: the id is echoed and the reason says so
    assert r["customer_id"] == "CUSTOMER_001" and r["token_error"] == "JWT_VALIDATION_SKIPPED"
    assert r["token_valid"] is True
    claims2 = spark.createDataFrame([(1, "CUSTOMER_002", None, None, None, 10**10)], claims.schema)
    r2 = guard.token_check(req.join(claims2, "request_id", "left")).collect()[0]
    assert r2["token_valid"] is False and r2["token_error"] == "CUSTOMER_ID_MISMATCH"


def test_rate_limiting(spark):
    t0 = dt.datetime(2024, 1, 1, 12, 0, 0)
    rows = [(i, "rate-limit-test-customer", t0 + dt.timedelta(seconds=i)) for i in range(4)]
    req = spark.createDataFrame(rows, "request_id long, customer_id string, ts timestamp_ntz")
    r = rate_limit(req, "customer_id", "ts", "request_id", limit=3, window_seconds=60).orderBy("request_id").collect()
    assert [x["accepted"] for x in r] == [True, True, True, False]
    assert r[3]["error_reason"] == "RATE_LIMIT_EXCEEDED"


def test_unauthorized_returns_error(spark):
    df = spark.createDataFrame([(1, False, False, False, False)],
                               "request_id long, token_valid boolean, input_blocked boolean, llm_error boolean, "
                               "output_blocked boolean")
    r = guard.request_outcome(guard.chat_outcome(df)).collect()[0]
    assert r["error"] == "UNAUTHORIZED" and r["http_status"] == 401 and r["outcome"] == "unauthorized"


def test_history_trim_other_roles_count_then_drop(spark):
    rows = [("s", 0, "system", "sys")]
    for i in range(12):
        rows += [("s", 1 + 2 * i, "user", f"q{i}"), ("s", 2 + 2 * i, "tool", f"t{i}")]
    kept = sessions.history_trim(_msgs(spark, rows), cap=20).orderBy("pos").collect()
    # 25 messages > 20: system + the last 19 non-system (t2, u3, t3, ..., u11, t11 = 9 user + 10 tool),
    # then the tool messages are dropped
    assert [r["role"] for r in kept] == ["system"] + ["user"] * 9
    assert [r["text"] for r in kept][1] == "q3"
    loaded = sessions.session_history(sessions.history_trim(_msgs(spark, rows[:5]), cap=20)).collect()[0]
    assert [m["role"] for m in loaded["messages"]] == ["system", "user", "user"]   # load keeps known roles
