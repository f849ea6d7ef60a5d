"""Query registry: one callable ``(spark, sf_dir) -> DataFrame`` per operator key.

Every query reads the driver tables (through ``sources.fixtures``) in full;
money columns are returned as double after exact decimal arithmetic so the
results compare one-to-one with the DuckDB oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakebank.operators import cdc, clean, kpi
from lakebank.operators.quality import apply_expectations, expectation_report
from lakebank.plans import medallion as M
from lakebank.sources import fixtures as FX
from lakebank.sources import ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
#: Queries no SQL can answer alike; their recall is tested.
APPROXIMATE: dict[str, Query] = {}


def register(name: str, into: dict[str, Query] = QUERIES):
    def deco(fn):
        into[name] = lambda spark, sf_dir: M.cast_money(fn(spark, sf_dir))
        into[name].__name__ = name
        into[name].__doc__ = fn.__doc__
        return fn
    return deco


# ---------------------------------------------------------------- gold / KPI

@register("gold_daily_balances")
def q_gold_daily_balances(spark, d):
    """Closing balance per account and day."""
    return M.gold_daily_balances(spark, d)


@register("gold_daily_balances_cumulative")
def q_gold_daily_balances_cumulative(spark, d):
    """G2 with ``cumulative=True``: the closing balance carries earlier days."""
    return kpi.gold_daily_balances(M.account_history(spark, d), M.silver_txns_for(spark, d), FX.AS_OF, cumulative=True)


@register("agg_daily_movements")
def q_agg_daily_movements(spark, d):
    """G1: credits, debits, count per account and day."""
    return kpi.daily_movements(M.silver_txns_for(spark, d))


@register("join_left_balances")
def q_join_left_balances(spark, d):
    """Accounts left join daily movements."""
    return kpi.join_left_balances(FX.accounts(spark, d), M.silver_txns_for(spark, d))


@register("join_left_balances_bucketed")
def q_join_left_balances_bucketed(spark, d):
    """J1 on catalog tables bucketed by account on both sides: no shuffle below the join."""
    from lakebank.sources import sinks
    accounts = kpi.current_rows(FX.accounts(spark, d)).select("cuenta_id", "tipo_producto", "segmento_cliente", "moneda", "saldo_inicial")
    return sinks.bucketed_pair(accounts, kpi.daily_movements(M.silver_txns_for(spark, d)), "cuenta_id",
                               lambda accounts, movements: accounts.join(movements, "cuenta_id", "left"))


@register("agg_card_month")
def q_agg_card_month(spark, d):
    """Per card and month purchases, total, average, active days."""
    return kpi.card_month(M.silver_txns_for(spark, d))


@register("join_inner_cards")
def q_join_inner_cards(spark, d):
    """Monthly usage inner join current cards."""
    return kpi.join_inner_cards(kpi.card_month(M.silver_txns_for(spark, d)),
                                M.silver_cards(FX.raw_cards(spark, d)))


@register("gold_card_usage")
def q_gold_card_usage(spark, d):
    """Monthly card usage KPI with activity rate."""
    return M.gold_card_usage(spark, d)


@register("agg_watermark")
def q_agg_watermark(spark, d):
    """COALESCE(MAX(fecha), '2020-01-01') of the bronze transactions."""
    return kpi.watermark(M.bronze_transactions(spark, d), "fecha_transaccion")


# ---------------------------------------------------------------- silver

@register("silver_casts")
def q_silver_casts(spark, d):
    """try_cast of amount and timestamp."""
    return clean.silver_casts(FX.raw_transactions(spark, d)).select(
        "transaccion_id", "monto", "fecha_transaccion")


@register("code_map")
def q_code_map(spark, d):
    """Transaction code -> label."""
    return clean.label_codes(FX.raw_transactions(spark, d)).select(
        "transaccion_id", "tipo_tx_cod", "tipo_transaccion_desc")


@register("mask_pan")
def q_mask_pan(spark, d):
    """PAN masked to the last four digits, raw number dropped."""
    return clean.mask_card_number(FX.raw_transactions(spark, d)).select(
        "transaccion_id", "numero_tarjeta_masked")


@register("silver_transactions")
def q_silver_transactions(spark, d):
    """Bronze transactions (partitions, ingest metadata) -> casts + labels +
    mask + stamp, then drop/warn rules."""
    return M.silver_transactions(M.bronze_transactions(spark, d))


@register("dq_drop")
def q_dq_drop(spark, d):
    """Q1: rows passing the two drop rules."""
    return M.silver_txns_for(spark, d).select("transaccion_id", "cuenta_id", "monto")


@register("dq_warn")
def q_dq_warn(spark, d):
    """Q2: warn rule keeps rows and flags them."""
    df = M.silver_transactions_unchecked(FX.raw_transactions(spark, d))
    warn = [r for r in M.SILVER_TXN_RULES if r.action == "warn"]
    return apply_expectations(df, warn, warn_flags=True).select("transaccion_id", "moneda", "moneda_valida")


@register("dq_fail")
def q_dq_fail(spark, d):
    """Q3: fail rule on card ids (passes on the test data)."""
    return apply_expectations(FX.raw_cards(spark, d), M.SILVER_CARD_RULES).select("tarjeta_id", "version_id")


@register("dq_report")
def q_dq_report(spark, d):
    """Q4: passed / failed counts per rule."""
    df = M.silver_transactions_unchecked(FX.raw_transactions(spark, d))
    return expectation_report(df, M.SILVER_TXN_RULES)


@register("dq_observed")
def q_dq_observed(spark, d):
    """Q2 / Q4: the same counts, observed while the checked table is written."""
    from lakebank.operators import quality
    from lakebank.session import scratch_path
    df, seen = quality.observe_expectations(M.silver_transactions_unchecked(FX.raw_transactions(spark, d)), M.SILVER_TXN_RULES)
    quality.apply_expectations(df, M.SILVER_TXN_RULES).write.parquet(scratch_path(spark, "silver-observed"))
    return quality.observed_report(spark, seen, M.SILVER_TXN_RULES)


@register("dedup_latest")
def q_dedup_latest(spark, d):
    """Newest version per card (tie-break on version id)."""
    return clean.dedup_latest(FX.raw_cards(spark, d), ["tarjeta_id"], ["_ingest_timestamp", "version_id"])


@register("code_set_map")
def q_code_set_map(spark, d):
    """Card state code sets -> label."""
    return clean.card_state(FX.raw_cards(spark, d)).select("tarjeta_id", "version_id", "estado_cod",
                                                            "estado_tarjeta")


@register("silver_cards")
def q_silver_cards(spark, d):
    """Dedup + state label + fail rule."""
    return M.silver_cards(FX.raw_cards(spark, d))


@register("filter_in")
def q_filter_in(spark, d):
    """Keep DEBITO and PAGO_SERVICIO rows."""
    return M.silver_txns_for(spark, d).filter(
        F.col("tipo_transaccion_desc").isin(*kpi.CARD_USAGE_TYPES)).select(
        "transaccion_id", "tarjeta_id", "tipo_transaccion_desc", "monto")


@register("project_columns")
def q_project_columns(spark, d):
    """Column selection of the account master."""
    return FX.accounts(spark, d).select("cuenta_id", "tipo_producto", "segmento_cliente", "moneda",
                                        "saldo_inicial")


# ---------------------------------------------------------------- CDC

@register("cdc_scd2")
def q_cdc_scd2(spark, d):
    """C1+C3+C4+C5 / X3: SCD-2 history of the account change feed."""
    return M.silver_accounts(FX.account_changes(spark, d))


@register("cdc_scd1")
def q_cdc_scd1(spark, d):
    """Latest state per account."""
    return cdc.apply_changes(FX.account_changes(spark, d), ["cuenta_id"], ["_ingest_timestamp", "_change_id"],
                             except_columns=M.CDC_EXCEPT_COLUMNS + ["_change_id"], scd_type=1)


CHANGE_FEED_CUT = "2024-01-16 00:00:00"


@register("change_feed")
def q_change_feed(spark, d):
    """A10: row changes between the SCD-1 state at mid-month and at the end."""
    ch = FX.account_changes(spark, d)
    args = dict(keys=["cuenta_id"], sequence_by=["_ingest_timestamp", "_change_id"],
                except_columns=M.CDC_EXCEPT_COLUMNS + ["_change_id"], scd_type=1)
    before = cdc.apply_changes(ch.filter(F.col("_ingest_timestamp") < F.lit(CHANGE_FEED_CUT).cast(
        "timestamp_ntz")), **args)
    after = cdc.apply_changes(ch, **args)
    return cdc.change_feed(before, after, ["cuenta_id"])


@register("change_feed_digests")
def q_change_feed_digests(spark, d):
    """A10: the same changes, joining only key buckets whose digests differ (from the last day of the feed)."""
    from lakebank.sources.sinks import checkpoint_table
    ch = FX.account_changes(spark, d)
    args = dict(keys=["cuenta_id"], sequence_by=["_ingest_timestamp", "_change_id"],
                except_columns=M.CDC_EXCEPT_COLUMNS + ["_change_id"], scd_type=1)
    before = cdc.apply_changes(ch.filter(F.col("_ingest_timestamp") < F.lit(CHANGE_FEED_CUT).cast("timestamp_ntz")), **args)
    before, after = (checkpoint_table(x, "snapshot") for x in (before, cdc.apply_changes(ch, **args)))
    return cdc.change_feed_digests(before, after, ["cuenta_id"])


# ---------------------------------------------------------------- bronze

@register("src_derived_partitions")
def q_src_derived_partitions(spark, d):
    """A2: year / month partition columns derived from the transaction date."""
    return ingest.derive_partitions(FX.raw_transactions(spark, d), "fecha_transaccion").select(
        "transaccion_id", "fecha_transaccion", "year_partition", "month_partition")


INCR_TARGET_CUT = "2000-01-01 00:00:00"
INCR_UPPER = "2001-06-30 00:00:00"


@register("src_incremental")
def q_src_incremental(spark, d):
    """A3: rows after the target's high watermark up to the upper bound."""
    src = M.bronze_transactions(spark, d)
    target = src.filter(F.col("fecha_transaccion") < F.lit(INCR_TARGET_CUT).cast("timestamp_ntz"))
    return ingest.incremental(src, target, "fecha_transaccion", INCR_UPPER).select(
        "transaccion_id", "fecha_transaccion", "year_partition", "month_partition")


@register("ingest_metadata")
def q_ingest_metadata(spark, d):
    """A4: ingest time, source system and batch id on the account snapshot."""
    return ingest.ingest_metadata(FX.accounts(spark, d), M.PROCESSED_AT, batch_id="batch-0001")


# ---------------------------------------------------------------- product views

def _customers(spark, d):
    return FX.accounts(spark, d).select(F.col("cuenta_id").alias("customer_id"))


@register("mask_account")
def q_mask_account(spark, d):
    """P5: account mask (last four or ****)."""
    from lakebank.functions.expr import mask_account
    return FX.product_accounts(spark, d).select("customer_id", "account_number",
                                                mask_account("account_number").alias("masked"))


@register("view_account_balance")
def q_view_account_balance(spark, d):
    """V1: PEN accounts per customer, masked, formatted."""
    from lakebank.operators import views
    return views.account_balance_lines(FX.product_accounts(spark, d), "PEN")


@register("account_movements_topn")
def q_account_movements_topn(spark, d):
    """Newest 5 PEN movements per customer."""
    from lakebank.operators import views
    return views.top_movements(FX.movements(M.silver_txns_for(spark, d)), "PEN", 5).drop("line")


@register("view_account_movements")
def q_view_account_movements(spark, d):
    """V2: movement lines with sign and absolute amount (limit 20 is capped to 10)."""
    from lakebank.operators import views
    return views.top_movements(FX.movements(M.silver_txns_for(spark, d)), "PEN", 20)


@register("statement_text")
def q_statement_text(spark, d):
    """One movements text per customer (fixed message when none)."""
    from lakebank.operators import views
    return views.movements_text(FX.movements(M.silver_txns_for(spark, d)), _customers(spark, d), "PEN", 5)


@register("account_balance_text")
def q_account_balance_text(spark, d):
    """G6 over V1: one balance text per customer."""
    from lakebank.operators import views
    return views.account_balance_text(FX.product_accounts(spark, d), _customers(spark, d), "PEN")


def _cards(spark, d):
    return FX.credit_cards(M.silver_cards(FX.raw_cards(spark, d)))


@register("view_credit_cards")
def q_view_credit_cards(spark, d):
    """V3: card view with mask, defaults and utilisation."""
    from lakebank.operators import views
    return views.credit_cards_view(_cards(spark, d))


@register("card_utilization")
def q_card_utilization(spark, d):
    """Used / limit * 100 when limit > 0, else 0."""
    from lakebank.functions.expr import utilization_pct
    return _cards(spark, d).select("card_id", "credit_limit", "used_balance",
                                   utilization_pct("used_balance", "credit_limit").alias("utilization_pct"))


@register("default_fill")
def q_default_fill(spark, d):
    """P10: missing card fields take their defaults."""
    from lakebank.operators import views
    return views.credit_cards_view(_cards(spark, d)).select("card_id", "card_type", "status", "currency",
                                                            "cut_date")


@register("view_card_movements")
def q_view_card_movements(spark, d):
    """V4: card purchases of the last 30 days before the as-of date."""
    from lakebank.operators import views
    return views.card_movements_view(FX.card_movements(M.silver_txns_for(spark, d)), FX.AS_OF, 30)


@register("view_card_movements_capped")
def q_view_card_movements_capped(spark, d):
    """A 120-day request is capped to 90 days."""
    from lakebank.operators import views
    return views.card_movements_view(FX.card_movements(M.silver_txns_for(spark, d)), FX.AS_OF, 120)


@register("view_loans")
def q_view_loans(spark, d):
    """V5: loans with 8-character reference and defaults."""
    from lakebank.operators import views
    return views.loans_view(FX.loans(spark, d))


@register("view_loan_eligibility")
def q_view_loan_eligibility(spark, d):
    """V6: offer or reason per customer."""
    from lakebank.operators import views
    return views.loan_eligibility_view(FX.eligibility(spark, d))


@register("view_transfer_limits")
def q_view_transfer_limits(spark, d):
    """V7: daily and month-to-date transfer use against the limits."""
    from lakebank.operators import views
    return views.transfer_limits(M.silver_txns_for(spark, d))


@register("credit_cards_text")
def q_credit_cards_text(spark, d):
    """G6 over V3: one card text per customer (fixed message when none)."""
    from lakebank.operators import views
    return views.credit_cards_text(_cards(spark, d), _customers(spark, d))


@register("card_movements_text")
def q_card_movements_text(spark, d):
    """G6 over V4: purchases of the last 90 days per customer."""
    from lakebank.operators import views
    return views.card_movements_text(FX.card_movements(M.silver_txns_for(spark, d)), _customers(spark, d), FX.AS_OF, 90)


@register("loans_text")
def q_loans_text(spark, d):
    """G6 over V5: one loan text per customer."""
    from lakebank.operators import views
    return views.loans_text(FX.loans(spark, d), _customers(spark, d))


@register("loan_eligibility_text")
def q_loan_eligibility_text(spark, d):
    """G6 over V6: the offer or the reason per customer."""
    from lakebank.operators import views
    return views.loan_eligibility_text(FX.eligibility(spark, d), _customers(spark, d))


@register("transfer_limits_text")
def q_transfer_limits_text(spark, d):
    """G6 over V7: use of the day and month for every customer."""
    from lakebank.operators import views
    return views.transfer_limits_text(M.silver_txns_for(spark, d), _customers(spark, d), "2001-07-16")


# ---------------------------------------------------------------- sessions and cache

def _long(df, *cols):
    return df.withColumns({c: F.col(c).cast("long") for c in cols})


@register("history_trim")
def q_history_trim(spark, d):
    """Saved history with cap 5 (test chats have at most 8 turns)."""
    from lakebank.operators import sessions
    return _long(sessions.history_trim(FX.messages(spark, d), cap=5), "pos")


@register("history_trim_20")
def q_history_trim_20(spark, d):
    """W3 with the reference cap of 20."""
    from lakebank.operators import sessions
    return _long(sessions.history_trim(FX.messages(spark, d), cap=20), "pos")


@register("session_history")
def q_session_history(spark, d):
    """Loaded history (system/user/assistant, in order) of the trimmed sessions."""
    from lakebank.operators import sessions
    h = sessions.session_history(sessions.history_trim(FX.messages(spark, d), cap=5))
    m = F.col("messages")
    return h.select("session_id", F.size(m).cast("long").alias("n_messages"),
                    F.array_join(F.transform(m, lambda x: x["role"]), ",").alias("roles"),
                    F.md5(F.array_join(F.transform(m, lambda x: x["text"]), "\n")).alias("digest"))


@register("prompt_assembly")
def q_prompt_assembly(spark, d):
    """Prompt per user turn (system message only on an empty history)."""
    from lakebank.operators import sessions
    p = sessions.prompt_assembly(FX.messages(spark, d))
    prior = F.slice("messages", F.lit(1), F.col("n_prior").cast("int"))
    text = F.array_join(F.transform(prior, lambda x: F.concat(x["role"], F.lit(": "), x["text"])), "\n")
    return p.withColumn("prior_md5", F.when(F.col("n_prior") > 0, F.md5(text))).drop("messages")


def _session_ttl(spark, d, ttl):
    from lakebank.operators import sessions
    e = FX.read_table(spark, d, "events")
    return sessions.session_ttl(e.select("user_id", "ts", "event_id", "event_type"), "user_id", "ts", "event_id", ttl,
                                logout=F.col("event_type") == "error")


@register("session_ttl")
def q_session_ttl(spark, d):
    """Sessions with the 30-minute TTL; 'error' events act as logout."""
    return _session_ttl(spark, d, 1800)


@register("session_ttl_12h")
def q_session_ttl_12h(spark, d):
    """I3 with a 12-hour TTL (the test log is sparse)."""
    return _session_ttl(spark, d, 43200)


@register("session_window")
def q_session_window(spark, d):
    """I3 by the built-in session window: 30 minutes, no logout."""
    from lakebank.operators import sessions
    ev = FX.read_table(spark, d, "events")
    return sessions.session_windows(ev, "user_id", "ts", 1800)


CACHE_TYPES = ["balance", "cards", "loans"]


@register("ttl_lookup")
def q_ttl_lookup(spark, d):
    """I4: cache hit or miss per request with the 300 s TTL."""
    from lakebank.operators import sessions
    return sessions.ttl_lookup(FX.cache_events(spark, d), CACHE_TYPES, 300)


@register("ttl_lookup_1d")
def q_ttl_lookup_1d(spark, d):
    """I4 with a one-day TTL."""
    from lakebank.operators import sessions
    return sessions.ttl_lookup(FX.cache_events(spark, d), CACHE_TYPES, 86400)


# ---------------------------------------------------------------- security and guardrails

TEST_PATTERNS = ["thwh", "ouè", "anan", "eaux"]


@register("scope_flags")
def q_scope_flags(spark, d):
    """Scopes and RBAC flags from the scp claim."""
    from lakebank.operators import guard
    s = guard.scope_flags(FX.claims(spark, d))
    return s.select("request_id", F.array_join("scopes", " ").alias("scopes"), "has_scope",
                    "can_query_loans", "can_query_cards")


@register("claim_match")
def q_claim_match(spark, d):
    """Requested customer id against sub / oid / customer claim."""
    from lakebank.operators import guard
    j = FX.requests(spark, d).join(FX.claims(spark, d), "request_id")
    return j.select("request_id", "customer_id", guard.claim_match(j).alias("matched"))


@register("request_check")
def q_request_check(spark, d):
    """REST validation status, bearer token, trimmed message."""
    from lakebank.operators import guard
    return guard.request_check(FX.requests(spark, d)).select(
        "request_id", "status", "token", "message_clean", "is_blank")


@register("chat_outcome")
def q_chat_outcome(spark, d):
    """Stage outcome per request."""
    from lakebank.operators import guard
    return guard.request_outcome(guard.chat_outcome(FX.stage_flags(spark, d))).select(
        "request_id", "outcome", "error", "http_status")


@register("request_outcome")
def q_request_outcome(spark, d):
    """Requests per HTTP status."""
    from lakebank.operators import guard
    o = guard.request_outcome(guard.chat_outcome(FX.stage_flags(spark, d)))
    return o.groupBy("http_status").agg(F.count(F.lit(1)).alias("n"))


@register("guard_patterns")
def q_guard_patterns(spark, d):
    """The reference phrase list over every chat message."""
    from lakebank.operators import guard
    return guard.guard_patterns(FX.messages(spark, d), "text").select(
        "session_id", "turn", "pattern", "pattern_reason")


@register("guard_patterns_custom")
def q_guard_patterns_custom(spark, d):
    """P15 with a phrase list that occurs in the test texts (list order wins)."""
    from lakebank.operators import guard
    return guard.guard_patterns(FX.messages(spark, d), "text", TEST_PATTERNS).select(
        "session_id", "turn", "pattern", "pattern_reason")


@register("guard_severity")
def q_guard_severity(spark, d):
    """Severity decision per message."""
    from lakebank.operators import guard
    return guard.guard_severity(FX.severities(spark, d)).select(
        "session_id", "turn", "max_severity", "severity_blocked", "severity_reason")


def _guarded(spark, d, direction):
    from lakebank.operators import guard
    j = FX.messages(spark, d).join(FX.severities(spark, d), ["session_id", "turn"], "left")
    return guard.guard_input(j, "text", direction, True, TEST_PATTERNS).select(
        "session_id", "turn", "is_blocked", "reason")


@register("guard_input")
def q_guard_input(spark, d):
    """P17 input side: patterns first, then severities."""
    return _guarded(spark, d, "input")


@register("guard_output")
def q_guard_output(spark, d):
    """P17 output side: severities only."""
    return _guarded(spark, d, "output")


@register("rate_limit")
def q_rate_limit(spark, d):
    """30 accepted requests per customer per sliding 60 s (sequential rule)."""
    from lakebank.operators.limits import rate_limit
    return rate_limit(FX.requests(spark, d).select("request_id", "customer_id", "ts"),
                      "customer_id", "ts", "request_id", 30, 60)


@register("rate_limit_day2")
def q_rate_limit_day2(spark, d):
    """I2 with 2 per sliding day, so denials occur in the test log."""
    from lakebank.operators.limits import rate_limit
    return rate_limit(FX.requests(spark, d).select("request_id", "customer_id", "ts"),
                      "customer_id", "ts", "request_id", 2, 86400)


@register("chat_audit")
def q_chat_audit(spark, d):
    """Request checks, rate limit (2 per sliding hour, so it bites on the
    test log), claims, input guard, model reply, output guard, outcome."""
    from lakebank.operators import guard
    return guard.chat_audit(FX.requests(spark, d), FX.claims(spark, d), FX.request_severities(spark, d),
                            limit=2, window_seconds=3600, replies=FX.replies(spark, d))


# ---------------------------------------------------------------- retrieval

def _rounded(df, *cols):
    return df.withColumns({c: F.round(c, 6) for c in cols})


def _vector_hits(spark, d, k):
    from lakebank.operators import retrieval as R
    return R.knn_topk(FX.documents_index(spark, d), FX.search_queries(spark, d), k)


def _keyword_search(spark, d):
    """Index of the documents, written once, and the benchmark items as its query set."""
    from lakebank.operators import keyword_index as KI
    b = FX.read_table(spark, d, "benchmark").select(F.col("item_id").alias("query_id"),
                                                     F.col("text").alias("query_text"))
    return KI.Search(spark, KI.build(FX.knowledge_text(spark, d)), b)


def _hybrid(spark, d, k=3):
    from lakebank.operators import keyword_index as KI
    return KI.hybrid_topk(_vector_hits(spark, d, k), _keyword_search(spark, d), k)


@register("knn_topk")
def q_knn_topk(spark, d):
    """Exact top-3 document vectors per benchmark query vector."""
    return _rounded(_vector_hits(spark, d, 3), "score")


@register("knn_lsh", APPROXIMATE)
def q_knn_lsh(spark, d):
    """J3, approximate: top-3 by random-projection buckets and exact rescoring."""
    from lakebank.operators import lsh
    hits = lsh.knn_lsh(FX.documents_index(spark, d), FX.search_queries(spark, d), 3)
    return _rounded(hits.select("query_id", "id", "score", "rank"), "score")


@register("keyword_topk")
def q_keyword_topk(spark, d):
    """BM25 top-3 documents per benchmark query text, from the block index."""
    return _rounded(_keyword_search(spark, d).topk(3).select("query_id", "id", "raw_score", "rank")
                    .withColumnRenamed("raw_score", "score"), "score")


@register("hybrid_topk")
def q_hybrid_topk(spark, d):
    """Reciprocal rank fusion of the 3 nearest vectors and the whole keyword list, top 3."""
    return _rounded(_hybrid(spark, d).select("query_id", "id", "rank", "vector_rank", "keyword_rank",
                                            "rrf_score"), "rrf_score")


def _fallback_hits(spark, d):
    from lakebank.operators import retrieval as R
    h = _hybrid(spark, d).withColumns({"search_score": F.col("rrf_score") * 30.0,
                                       "reranker_score": F.col("vector_score")})
    return R.score_fallback_filter(h)


@register("score_fallback_filter")
def q_score_fallback_filter(spark, d):
    """Reranker score, else base score; keep >= 0.6."""
    return _rounded(_fallback_hits(spark, d).select("query_id", "rank", "id", "score"), "score")


@register("rag_context")
def q_rag_context(spark, d):
    """Numbered context text per query (empty when nothing passes)."""
    from lakebank.operators import retrieval as R
    from lakebank.sources.sinks import checkpoint_table
    # written first: its measured size lets the planner broadcast it, and only the hits' texts move
    hits = checkpoint_table(_fallback_hits(spark, d), "hits")
    hits = hits.join(FX.documents_index(spark, d, hits).select("id", "content"), "id")
    return R.rag_context(hits, FX.search_queries(spark, d))


def _upsert_batch(spark, d):
    b = FX.read_table(spark, d, "benchmark")
    i = F.col("item_id")
    base = b.select((i * 7).cast("string").alias("id"), F.concat(F.lit("faq-"), i.cast("string")).alias("title"),
                    F.col("text").alias("content"), F.lit("faq").alias("source"), F.lit("faq").alias("product_type"),
                    F.lit(1).alias("_seq"))
    v2 = b.filter(i % 3 == 0).select(
        (i * 7).cast("string").alias("id"), F.concat(F.lit("faq-v2-"), i.cast("string")).alias("title"),
        F.col("text").alias("content"), F.lit("faq").alias("source"), F.lit("faq").alias("product_type"),
        F.lit(2).alias("_seq"))
    new = b.select(F.concat(F.lit("new-"), i.cast("string")).alias("id"),
                   F.concat(F.lit("faq-"), i.cast("string")).alias("title"), F.col("text").alias("content"),
                   F.lit("faq").alias("source"), F.lit("faq").alias("product_type"), F.lit(1).alias("_seq"))
    return base.unionByName(v2).unionByName(new)


@register("doc_upsert")
def q_doc_upsert(spark, d):
    """Upsert a batch of FAQ documents into the knowledge index (latest wins)."""
    from lakebank.operators import retrieval as R
    out = R.doc_upsert(FX.documents_index(spark, d), _upsert_batch(spark, d))
    return out.select("id", "title", "content", "source", "product_type", "chunk_id",
                      F.col("content_vector").isNotNull().alias("has_vector"))


# ---------------------------------------------------------------- streaming

PART_CUTS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")


def _time_parts(ts: str):
    a, b = (F.lit(x).cast("timestamp_ntz") for x in PART_CUTS)
    c = F.col(ts)
    return [c < a, (c >= a) & (c < b), (c >= b) | c.isNull()]


@register("stream_cdc_target")
def q_stream_cdc_target(spark, d):
    """The change feed arrives in three out-of-order parts; the
    streaming target must equal the batch SCD-2 history."""
    from lakebank.session import scratch_path
    from lakebank.streaming.cdc_state import KeyedCdcTarget
    from lakebank.streaming.harness import run_in_parts
    ch = FX.account_changes(spark, d)
    target = KeyedCdcTarget(scratch_path(spark, "cdc-target"), ch.schema, ["cuenta_id"], ["_ingest_timestamp", "_change_id"],
                            except_columns=M.CDC_EXCEPT_COLUMNS + ["_change_id"])
    k = F.col("_change_id")
    run_in_parts(spark, ch, [k % 3 == 2, k % 3 == 0, k % 3 == 1], "cdc",
                 start=lambda src, ckpt: target.start(spark.readStream.schema(ch.schema).parquet(src), ckpt))
    return target.current(spark)


@register("rate_limit_stream")
def q_rate_limit_stream(spark, d):
    """I2 stream: 2 accepted per sliding day, requests arriving in three parts."""
    from lakebank.streaming.harness import run_in_parts
    from lakebank.streaming.rate_limit_stream import rate_limit_stream
    req = FX.requests(spark, d).select("request_id", "customer_id", "ts")
    sink, _ = run_in_parts(spark, req, _time_parts("ts"), "ratelimit",
                           build=lambda s: rate_limit_stream(s, "customer_id", "ts", "request_id", 3600, 2, 86400))
    return spark.read.parquet(sink)


def _session_stream(spark, d, logout, name):
    from lakebank.streaming.harness import run_in_parts
    from lakebank.streaming.session_stream import open_sessions, session_stream
    ev = FX.read_table(spark, d, "events").select("user_id", "ts", "event_id", "event_type")
    sink, checkpoint = run_in_parts(spark, ev, _time_parts("ts"), name,
                                    build=lambda s: session_stream(s, "user_id", "ts", "event_id", logout, 1800))
    return spark.read.parquet(sink).unionByName(open_sessions(spark, checkpoint, "user_id", 1800))


@register("session_stream")
def q_session_stream(spark, d):
    """I3 stream: 30-minute sessions, closed and still open."""
    return _session_stream(spark, d, None, "sessions")


@register("session_stream_logout")
def q_session_stream_logout(spark, d):
    """I3 stream with logout: 'error' events end their session at once."""
    return _session_stream(spark, d, F.col("event_type") == "error", "sessions-logout")


# ---------------------------------------------------------------- sinks and catalog

@register("sink_partitioned")
def q_sink_partitioned(spark, d):
    """Bronze transactions written partitioned by year and month
    (rebalanced files, dynamic overwrite), all of it read back."""
    from lakebank.session import scratch_path
    from lakebank.sources.sinks import write_partitioned
    path = write_partitioned(M.bronze_transactions(spark, d), scratch_path(spark, "bronze-txn"),
                             ["year_partition", "month_partition"])
    back = spark.read.parquet(path)
    return back.select(
        "transaccion_id", "fecha_transaccion", "year_partition", "month_partition", "tipo_tx_cod")


@register("scan_table")
def q_scan_table(spark, d):
    """Read the account master through the catalog by name."""
    from lakebank.sources.tables import scan_table
    FX.accounts(spark, d).createOrReplaceTempView("silver_cuentas")
    return scan_table(spark, "silver_cuentas")


# ---------------------------------------------------------------- remaining CDC keys and composites

def _scd2_args(**kw):
    base = dict(keys=["cuenta_id"], sequence_by=["_ingest_timestamp", "_change_id"],
                except_columns=M.CDC_EXCEPT_COLUMNS + ["_change_id"])
    base.update(kw)
    return base


@register("cdc_delete")
def q_cdc_delete(spark, d):
    """Versions closed by a delete row of their key (whole feed, truncates included)."""
    ch = FX.account_changes(spark, d)
    gone = ch.filter(F.col("operacion") == "D").select("cuenta_id", F.col("_ingest_timestamp").alias("__END_AT")).distinct()
    return cdc.apply_changes(ch, **_scd2_args()).join(gone, ["cuenta_id", "__END_AT"], "left_semi")


@register("cdc_truncate")
def q_cdc_truncate(spark, d):
    """C4: versions closed by a truncate (end = a truncate's sequence time)."""
    ch = FX.account_changes(spark, d)
    h = cdc.apply_changes(ch, **_scd2_args())
    t = ch.filter(F.col("operacion") == "TRUNCATE").select(F.col("_ingest_timestamp").alias("__END_AT")).distinct()
    return h.join(t, "__END_AT", "left_semi")


@register("cdc_except_columns")
def q_cdc_except_columns(spark, d):
    """Latest state keeping the batch id but leaving out the source system."""
    return cdc.apply_changes(FX.account_changes(spark, d), ["cuenta_id"], ["_ingest_timestamp", "_change_id"],
                             except_columns=["_source_system", "_change_id"], scd_type=1)


@register("silver_accounts")
def q_silver_accounts(spark, d):
    """C1 + C3 + C4 + C5 over the account change feed."""
    return M.silver_accounts(FX.account_changes(spark, d))


@register("bronze_accounts")
def q_bronze_accounts(spark, d):
    """Account snapshot + YEAR() partition + ingest metadata (the JDBC source is
    replaced by the driver table; ``ingest.read_jdbc_partitioned`` is the database form)."""
    snap = FX.accounts_snapshot(spark, d)
    return ingest.ingest_metadata(ingest.derive_partitions(snap, "fecha_apertura", ("year",)), M.PROCESSED_AT,
                                  batch_id="batch-0001")


@register("bronze_transactions")
def q_bronze_transactions(spark, d):
    """Watermark of the existing bronze table, incremental slice, partitions, metadata."""
    src = FX.raw_transactions(spark, d)
    target = src.filter(F.col("fecha_transaccion") < F.lit(INCR_TARGET_CUT).cast("timestamp_ntz"))
    inc = ingest.incremental(src, target, "fecha_transaccion", INCR_UPPER)
    return ingest.ingest_metadata(ingest.derive_partitions(inc, "fecha_transaccion"), M.PROCESSED_AT)


@register("bronze_cards")
def q_bronze_cards(spark, d):
    """Bronze card versions: year / month partitions of the version date, ingest metadata."""
    raw = FX.raw_cards(spark, d).withColumnRenamed("_ingest_timestamp", "fecha_version")
    return ingest.ingest_metadata(ingest.derive_partitions(raw, "fecha_version"), M.PROCESSED_AT, batch_id="batch-0001")


@register("session_ids")
def q_session_ids(spark, d):
    """Session id per request, a new one where it is missing (every 41st): the length and form of it."""
    from lakebank.operators import sessions
    given = FX.requests(spark, d).withColumn("session_id", F.when(F.col("request_id") % 41 != 0, F.col("session_id")))
    out = sessions.with_session_id(given.withColumn("given", F.col("session_id").isNotNull()))
    form = F.col("session_id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")
    return out.select("request_id", "given", form.alias("is_new"), F.when(F.col("given"), F.col("session_id")).alias("session_id"))


@register("json_roundtrip")
def q_json_roundtrip(spark, d):
    """Cached JSON payloads decoded and encoded again (to_json / from_json)."""
    e = FX.read_table(spark, d, "events")
    parsed = F.from_json("props", "k long")
    return e.select("event_id", parsed.getField("k").alias("k"), F.to_json(parsed).alias("json"))


@register("called_functions")
def q_called_functions(spark, d):
    """Names of the tools a reply called, missing names as ''."""
    fc = FX.function_calls(spark, d)
    names = F.transform("function_calls", lambda x: F.coalesce(x["name"], F.lit("")))
    return fc.select("request_id", F.size(names).cast("long").alias("n_calls"),
                     F.array_join(names, ",").alias("functions_called"))
