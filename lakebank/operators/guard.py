"""Request checks, token claims, text guardrails and request outcomes
(P11-P17, P19, X8), set-wise over request logs.

The hosted parts (token signature check, harm classifier, language model) are
not rebuilt: claims arrive decoded and severities arrive as columns. What is
rebuilt is the decision logic, as built-in column expressions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakebank.functions.expr import epoch_seconds, first_match, scopes

# Fixed values from the reference.
BANKING_BLOCK_PATTERNS = [
    "número completo de tarjeta",
    "clave secreta",
    "pin bancario",
    "contraseña",
    "cvv",
    "clave dinámica",
]
PATTERN_REASON = "Patrón bancario sensible detectado: '{pattern}'"
SEVERITY_REASON = "Categoría '{category}' con severidad {severity}"
SEVERITY_THRESHOLD = 2
SEVERITY_CATEGORIES = ["hate", "violence", "self_harm", "sexual"]
REASON_OK = "OK"
REASON_SERVICE_ERROR = "service_error"
REASON_DISABLED = "safety_disabled"
SCOPE_AGENT, SCOPE_READ = "banking.agent", "banking.read"
SCOPE_LOANS, SCOPE_CARDS = "banking.loans.read", "banking.cards.read"
MESSAGE_MIN, MESSAGE_MAX = 1, 2000
CUSTOMER_ID_MIN = 3
BEARER = "Bearer "
UNAUTHORIZED, CONTENT_BLOCKED = "UNAUTHORIZED", "CONTENT_BLOCKED"
CUSTOMER_ID_MISMATCH, TOKEN_EXPIRED = "CUSTOMER_ID_MISMATCH", "TOKEN_EXPIRED"
JWT_VALIDATION_SKIPPED = "JWT_VALIDATION_SKIPPED"


def strip(col: Column) -> Column:
    """Without white space at both ends: all of Unicode's, and the four ASCII separators."""
    return F.regexp_replace(col, r"(?U)^[\s\x1C-\x1F]+|[\s\x1C-\x1F]+$", "")


def scope_flags(claims: DataFrame, scp: str = "scp") -> DataFrame:
    """Scope list (null claim -> banking.read) and the three RBAC flags."""
    s = scopes(scp)
    has = lambda x: F.array_contains(s, x)
    return claims.withColumns({
        "scopes": s,
        "has_scope": has(SCOPE_AGENT) | has(SCOPE_READ),
        "can_query_loans": has(SCOPE_LOANS) | has(SCOPE_READ),
        "can_query_cards": has(SCOPE_CARDS) | has(SCOPE_READ),
    })


def claim_match(df: DataFrame, customer: str = "customer_id",
                claim_cols: Sequence[str] = ("sub", "oid", "extension_customer_id")) -> Column:
    """Requested customer equals one of the claims (missing claims -> '')."""
    c = F.col(customer)
    return F.coalesce(c.isin(*[F.coalesce(F.col(x), F.lit("")) for x in claim_cols]), F.lit(False))


def request_check(requests: DataFrame, message: str = "message", auth: str = "authorization",
                  customer: str = "customer_id") -> DataFrame:
    """Request validation as the REST layer does it.

    Message length 1..2000 is checked *before* trimming (422); then the
    header must start with ``Bearer `` (401); then the customer id needs at
    least 3 characters (400). A blank message passes (flag ``is_blank``).
    """
    n = F.length(F.col(message))
    bad_msg = F.col(message).isNull() | (n < MESSAGE_MIN) | (n > MESSAGE_MAX)
    bad_auth = ~F.coalesce(F.startswith(F.col(auth), F.lit(BEARER)), F.lit(False))
    bad_cust = F.coalesce(F.length(F.col(customer)), F.lit(0)) < CUSTOMER_ID_MIN
    status = (F.when(bad_msg, 422).when(bad_auth, 401).when(bad_cust, 400).otherwise(200))
    token = F.when(~bad_auth, strip(F.regexp_replace(F.col(auth), "^Bearer ", "")))
    return requests.withColumns({
        "status": status,
        "token": token,
        "message_clean": strip(F.col(message)),
        "is_blank": F.coalesce(F.length(strip(F.col(message))) == 0, F.lit(False)),
    })


def guard_patterns(df: DataFrame, text: str, patterns: Sequence[str] = BANKING_BLOCK_PATTERNS) -> DataFrame:
    """First sensitive phrase (list order) in the lower-cased text."""
    hit = first_match(text, patterns)
    return df.withColumns({
        "pattern": hit,
        "pattern_reason": F.when(hit.isNotNull(), F.format_string(PATTERN_REASON.replace("{pattern}", "%s"), hit)),
    })


def guard_severity(df: DataFrame, cats: Sequence[str] = SEVERITY_CATEGORIES,
                   threshold: int = SEVERITY_THRESHOLD) -> DataFrame:
    """Block when the max severity >= threshold; ties go to the first
    category in list order; a missing category counts 0; no verdict at all
    (every category null) passes as ``service_error``."""
    vals = [F.coalesce(F.col(c), F.lit(0)) for c in cats]
    mx = F.greatest(*vals)
    cat = None
    for c, v in zip(cats, vals):
        cat = F.when(v == mx, F.lit(c)) if cat is None else cat.when(v == mx, F.lit(c))
    no_verdict = None
    for c in cats:
        no_verdict = F.col(c).isNull() if no_verdict is None else (no_verdict & F.col(c).isNull())
    blocked = ~no_verdict & (mx >= threshold)
    reason = (F.when(no_verdict, F.lit(REASON_SERVICE_ERROR))
              .when(blocked, F.format_string(SEVERITY_REASON.replace("{category}", "%s")
                                             .replace("{severity}", "%d"), cat, mx))
              .otherwise(F.lit(REASON_OK)))
    return df.withColumns({"max_severity": F.when(~no_verdict, mx), "severity_blocked": blocked,
                           "severity_reason": reason})


def guard_input(df: DataFrame, text: str, direction: str = "input", enabled: bool = True,
                patterns: Sequence[str] = BANKING_BLOCK_PATTERNS) -> DataFrame:
    """Input side = patterns first, then severity; output side skips the
    patterns. With the classifier disabled the severity step yields
    ``safety_disabled`` and never blocks."""
    d = df
    if direction == "input":
        d = guard_patterns(d, text, patterns)
        pat_block = F.col("pattern").isNotNull()
        pat_reason = F.col("pattern_reason")
    else:
        pat_block, pat_reason = F.lit(False), F.lit(None).cast("string")
    if enabled:
        d = guard_severity(d)
        sev_block, sev_reason = F.col("severity_blocked"), F.col("severity_reason")
    else:
        sev_block, sev_reason = F.lit(False), F.lit(REASON_DISABLED)
    return d.withColumns({
        "is_blocked": pat_block | sev_block,
        "reason": F.when(pat_block, pat_reason).otherwise(sev_reason),
    })


def request_outcome(df: DataFrame, error: str = "error") -> DataFrame:
    """Agent outcome -> HTTP status (UNAUTHORIZED 401, CONTENT_BLOCKED 422, else 200)."""
    e = F.col(error)
    return df.withColumn("http_status", F.when(e == UNAUTHORIZED, 401).when(e == CONTENT_BLOCKED, 422)
                         .otherwise(200))


def chat_outcome(df: DataFrame, token_valid: str = "token_valid", input_blocked: str = "input_blocked",
                 llm_error: str = "llm_error", output_blocked: str = "output_blocked") -> DataFrame:
    """Stage order of a chat request: invalid token -> blocked input ->
    model error (fallback reply) -> blocked output (replaced reply) -> ok."""
    tv = F.coalesce(F.col(token_valid), F.lit(False))
    outcome = (F.when(~tv, F.lit("unauthorized"))
               .when(F.coalesce(F.col(input_blocked), F.lit(False)), F.lit("content_blocked"))
               .when(F.coalesce(F.col(llm_error), F.lit(False)), F.lit("llm_error"))
               .when(F.coalesce(F.col(output_blocked), F.lit(False)), F.lit("output_blocked"))
               .otherwise(F.lit("ok")))
    err = F.when(~tv, F.lit(UNAUTHORIZED)).when(F.coalesce(F.col(input_blocked), F.lit(False)),
                                                F.lit(CONTENT_BLOCKED))
    return df.withColumns({"outcome": outcome, "error": err})


def token_check(requests_claims: DataFrame, ts: str = "ts", exp: str = "exp",
                claim_cols: Sequence[str] = ("sub", "oid", "extension_customer_id")) -> DataFrame:
    """Security verdict from decoded claims: expired token, customer mismatch,
    else valid (claims already verified upstream). A request with no claims at
    all had no key store to validate against: it passes with
    ``JWT_VALIDATION_SKIPPED`` (and the default scope), as the reference does."""
    none = F.col(exp).isNull()
    for c in claim_cols:
        none = none & F.col(c).isNull()
    expired = F.coalesce(F.col(exp) <= epoch_seconds(ts), F.lit(True))
    match = claim_match(requests_claims, claim_cols=claim_cols)
    reason = (F.when(none, F.lit(JWT_VALIDATION_SKIPPED)).when(expired, F.lit(TOKEN_EXPIRED))
              .when(~match, F.lit(CUSTOMER_ID_MISMATCH)))
    return requests_claims.withColumns({"token_valid": none | reason.isNull(), "token_error": reason})


def chat_audit(requests: DataFrame, claims: DataFrame, severities: DataFrame | None,
               limit: int = 30, window_seconds: int = 60, key: str = "request_id",
               replies: DataFrame | None = None) -> DataFrame:
    """Request check -> rate limit -> token/claims -> input guard -> model reply -> output guard -> outcome.

    ``replies`` (key, reply, llm_error and the reply's severities) are what the
    model gave; a reply that failed gives the fallback text, a blocked one is
    replaced, as ``outcome`` tells. Without it those two stages pass.

    Requests rejected by the REST checks never reach the agent, so they do not
    consume the rate limit. Rate-limited calls surface as 401, as in the
    reference. Joins are equi-joins on the request id.
    """
    from lakebank.operators.limits import rate_limit
    checked = request_check(requests, "message")
    ok = checked.filter(F.col("status") == 200)
    limited = rate_limit(ok, "customer_id", "ts", key, limit, window_seconds).drop("error_reason")
    rest = checked.filter(F.col("status") != 200).withColumn("accepted", F.lit(None).cast("boolean"))
    r = limited.unionByName(rest)
    j = token_check(r.join(claims, key, "left"))
    if severities is not None:
        j = j.join(severities, key, "left")
    else:
        j = j.withColumns({c: F.lit(None).cast("int") for c in SEVERITY_CATEGORIES})
    j = guard_input(j, "message_clean")
    is_limited = ~F.coalesce(F.col("accepted"), F.lit(True))
    j = j.withColumns({"security_error": F.when(is_limited, F.lit("RATE_LIMIT_EXCEEDED"))
                       .otherwise(F.col("token_error")),
                       "token_valid": ~is_limited & F.col("token_valid"),
                       "input_blocked": F.col("is_blocked"), "guard_reason": F.col("reason")})
    if replies is None:
        j = j.withColumns({"llm_error": F.lit(False), "output_blocked": F.lit(False)})
    else:
        out = guard_input(replies, "reply", "output").select(key, "llm_error", F.col("is_blocked").alias("output_blocked"))
        j = j.join(out, key, "left")
    j = chat_outcome(j)
    reached = F.col("status") == 200
    http = F.when(~reached, F.col("status")).when(F.col("error") == UNAUTHORIZED, 401).when(
        F.col("error") == CONTENT_BLOCKED, 422).otherwise(200)
    return j.select(key, "customer_id", "ts", F.col("status").alias("check_status"),
                    F.when(reached, F.col("security_error")).alias("security_error"),
                    F.when(reached, F.col("outcome")).alias("outcome"),
                    F.when(reached, F.col("guard_reason")).alias("guard_reason"), http.alias("http_status"))
