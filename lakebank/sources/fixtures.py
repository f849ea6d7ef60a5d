"""Driver test tables -> banking domain tables.

The driver ships TPC-H-like tables, not banking ones. Each function here
derives one domain table from them with plain column expressions (no shuffle),
so every query's work grows with the input. The rules are deterministic and
mirrored one-for-one by the DuckDB oracle in ``lakebank/oracle_sql.py``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakebank.functions.expr import epoch_seconds
from lakebank.sources.tables import read_table

# Fixed "today" of the test data: the newest order date. Passed as an argument
# wherever the reference uses current_date / current_timestamp.
AS_OF = "2001-08-01"

# Fixed values for the fixture mapping.
CURRENCIES = ["PEN", "USD", "EUR", "GBP"]
PRODUCT_TYPES = ["AHORRO", "CORRIENTE", "PLAZO_FIJO"]
CARD_TYPES = ["VISA", "MASTERCARD", "AMEX"]


def _pick(idx: Column, values: list[str]) -> Column:
    """values[idx] with null for idx outside the list."""
    return F.get(F.array(*[F.lit(v) for v in values]), idx)


def customer_code(uid: Column) -> Column:
    """Textual customer id as the agent half uses it: C + 6 digits."""
    return F.concat(F.lit("C"), F.lpad(uid.cast("string"), 6, "0"))


def card_id(custkey: Column, orderkey: Column) -> Column:
    return custkey * 2 + orderkey % 2


BUSINESS_ACCOUNT_OFFSET = 1_000_000_000


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account master (silver_cuentas current rows): personal accounts from
    ``customer`` and business accounts from ``supplier`` (ids offset by 10^9).
    Suppliers place no orders, so their accounts have no movements."""
    c = read_table(spark, sf_dir, "customer")
    s = read_table(spark, sf_dir, "supplier")
    personal = c.select(
        F.col("c_custkey").alias("cuenta_id"),
        _pick((F.col("c_nationkey") % 3).cast("int"), PRODUCT_TYPES).alias("tipo_producto"),
        F.col("c_mktsegment").alias("segmento_cliente"),
        _pick((F.col("c_nationkey") % 4).cast("int"), CURRENCIES).alias("moneda"),
        F.col("c_acctbal").cast("decimal(18,2)").alias("saldo_inicial"),
    )
    business = s.select(
        (F.col("s_suppkey") + BUSINESS_ACCOUNT_OFFSET).alias("cuenta_id"),
        F.lit("CORRIENTE").alias("tipo_producto"),
        F.lit("EMPRESA").alias("segmento_cliente"),
        _pick((F.col("s_nationkey") % 4).cast("int"), CURRENCIES).alias("moneda"),
        F.col("s_acctbal").cast("decimal(18,2)").alias("saldo_inicial"),
    )
    return personal.unionByName(business)


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze-shaped transactions from ``orders`` (amount still text)."""
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    tarjeta = card_id(F.col("o_custkey"), k)
    prio = F.substring("o_orderpriority", 1, 1)
    return o.select(
        k.alias("transaccion_id"),
        F.when(k % 89 == 0, F.lit(None).cast("bigint")).otherwise(F.col("o_custkey")).alias("cuenta_id"),
        tarjeta.alias("tarjeta_id"),
        F.when(k % 97 == 0, F.lit("N/A"))
         .when(k % 101 == 0, F.lit("0"))
         .otherwise(F.col("o_totalprice").cast("string")).alias("monto"),
        _pick((k % 4).cast("int"), CURRENCIES).alias("moneda"),
        F.col("o_orderdate").alias("fecha_transaccion"),
        F.when(k % 53 == 0, F.lit(None).cast("string"))
         .when(prio == "1", "CR").when(prio == "2", "DB").when(prio == "3", "TF")
         .when(prio == "4", "PG").otherwise("XX").alias("tipo_tx_cod"),
        F.when(k % 37 == 0, F.lit(None).cast("string"))
         .when(k % 31 == 0, (F.col("o_custkey") % 100).cast("string"))
         .otherwise(F.lpad(tarjeta.cast("string"), 16, "0")).alias("numero_tarjeta"),
    )


def raw_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Card versions (raw_tarjetas): one version per order of the card."""
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    even = k % 2 == 0
    st = F.col("o_orderstatus")
    return o.select(
        card_id(F.col("o_custkey"), k).alias("tarjeta_id"),
        F.col("o_custkey").alias("cliente_id"),
        _pick((F.col("o_custkey") % 4).cast("int"), CARD_TYPES).alias("tipo_tarjeta"),
        F.when(k % 13 == 0, F.lit("Z"))
         .when(st == "F", F.when(even, "A").otherwise("01"))
         .when(st == "O", F.when(even, "B").otherwise("02"))
         .when(st == "P", F.when(even, "C").otherwise("03")).alias("estado_cod"),
        F.col("o_orderdate").alias("_ingest_timestamp"),
        k.alias("version_id"),
    )


def account_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account change feed (raw_cuentas CDC rows) from ``events``."""
    e = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    et = F.col("event_type")
    return e.select(
        F.col("user_id").alias("cuenta_id"),
        F.col("value").cast("decimal(18,2)").alias("saldo"),
        et.alias("estado"),
        F.when(eid % 4999 == 2400, "TRUNCATE").when(et == "error", "D")
         .when(et == "signup", "I").otherwise("U").alias("operacion"),
        F.col("ts").alias("_ingest_timestamp"),
        eid.alias("_change_id"),
        F.concat(F.lit("b"), (eid / 1000).cast("bigint").cast("string")).alias("_batch_id"),
        F.lit("core_replica").alias("_source_system"),
    )


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat request log from ``events``."""
    e = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return e.select(
        eid.alias("request_id"),
        F.concat(F.lit("S"), F.col("user_id").cast("string")).alias("session_id"),
        F.when(eid % 19 == 0, F.lit("C")).otherwise(customer_code(F.col("user_id"))).alias("customer_id"),
        F.col("ts"),
        F.when(eid % 17 == 0, F.lit("Basic abc"))
         .otherwise(F.concat(F.lit("Bearer tok"), eid.cast("string"))).alias("authorization"),
        F.when(eid % 23 == 0, F.lit("   ")).when(eid % 29 == 0, F.repeat(F.lit("x"), 2001))
         .when(eid % 31 == 0, F.lit(""))
         .otherwise(F.concat(F.lit("consulta "), F.col("event_type"), F.lit(" "), F.col("props")))
         .alias("message"),
    )


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decoded token claims per request."""
    e = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    cust = customer_code(F.col("user_id"))
    epoch = epoch_seconds(F.col("ts"))
    return e.select(
        eid.alias("request_id"),
        F.when(eid % 11 == 0, customer_code(F.col("user_id") + 1)).otherwise(cust).alias("sub"),
        F.concat(F.lit("O"), eid.cast("string")).alias("oid"),
        F.when(eid % 7 == 0, cust).alias("extension_customer_id"),
        _pick((eid % 4).cast("int") - 1,
              ["banking.read", "banking.agent", "banking.loans.read banking.cards.read"]).alias("scp"),
        F.when(eid % 13 == 0, epoch - 1).otherwise(epoch + 3600).alias("exp"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chat messages (session_id, turn, role, text) from ``conversations``."""
    c = read_table(spark, sf_dir, "conversations")
    return c.select(F.col("conv_id").alias("session_id"), "turn", "role", "text")


def severities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Harm-classifier scores per message (the hosted classifier is not built).

    Levels 0..2 from id arithmetic; every 9th text has no verdict (service error).
    """
    c = read_table(spark, sf_dir, "conversations")
    x = F.col("conv_id") * 100 + F.col("turn")
    none = x % 9 == 0

    def lvl(e: Column) -> Column:
        return F.when(none, F.lit(None).cast("int")).otherwise(e.cast("int"))

    return c.select(
        F.col("conv_id").alias("session_id"), "turn",
        lvl(F.floor((x * 7 % 11) / 4)).alias("hate"),
        lvl(F.floor((x * 3 % 13) / 5)).alias("violence"),
        lvl(F.floor((x % 17) / 8)).alias("self_harm"),
        lvl(F.floor((x * 5 % 19) / 9)).alias("sexual"),
    )


def cache_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cache puts / invalidations / requests from ``events``."""
    e = read_table(spark, sf_dir, "events")
    et = F.col("event_type")
    kind = F.when(et == "purchase", "put").when(et == "error", "invalidate").otherwise("request")
    return (e.select(
        F.col("event_id").alias("event_id"),
        customer_code(F.col("user_id")).alias("customer_id"),
        F.when(et == "error", F.lit(None).cast("string"))
         .otherwise(_pick((F.col("event_id") % 3).cast("int"), ["balance", "cards", "loans"])).alias("data_type"),
        F.col("ts"), kind.alias("kind"), F.col("props").alias("value")))


def documents_index(spark: SparkSession, sf_dir: str, ids: DataFrame | None = None) -> DataFrame:
    """Knowledge documents with vectors (vector null when no embedding exists), all or those of ``ids`` (id as text)."""
    d = read_table(spark, sf_dir, "documents")
    if ids is not None:                                # before the join with the vectors, which moves the texts
        d = d.join(ids.select(F.col("id").alias("__id")), F.col("doc_id").cast("string") == F.col("__id"), "left_semi")
    v = read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"), F.col("embedding").alias("content_vector"))
    return (d.join(v, "doc_id", "left").select(
        F.col("doc_id").cast("string").alias("id"),
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("title"),
        F.col("text").alias("content"), "source",
        F.col("lang").alias("product_type"), "content_vector",
        F.col("doc_id").cast("string").alias("chunk_id")))


def knowledge_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Knowledge documents without vectors (what keyword search reads)."""
    d = read_table(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("id"), F.col("text").alias("content"))


def search_queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retrieval queries: every ``benchmark`` item, with the vector of the same id."""
    b = read_table(spark, sf_dir, "benchmark")
    v = read_table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    return b.select(F.col("item_id").alias("query_id"), F.col("text").alias("query_text")).join(
        v, "query_id", "left")


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    return o.select(
        F.col("o_custkey").alias("customer_id"),
        F.concat(F.lit("LN"), F.lpad(k.cast("string"), 10, "0")).alias("loan_id"),
        F.when(F.col("o_orderstatus") == "F", "Personal")
         .when(F.col("o_orderstatus") == "O", "Vehicular").alias("loan_type"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("outstanding_balance"),
        ((k % 500) * 10 + 150).cast("decimal(18,2)").alias("monthly_payment"),
        (F.lit(5.0) + (k % 20) / 2.0).alias("annual_rate"),
        (k % 36).cast("int").alias("remaining_installments"),
        F.date_add(F.to_date("o_orderdate"), 30).alias("next_due_date"),
        _pick((k % 2).cast("int"), ["PEN", "USD"]).alias("currency"),
    )


def eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    ok = F.col("c_acctbal") > 0
    return c.select(
        F.col("c_custkey").alias("customer_id"),
        ok.alias("eligible"),
        (F.col("c_acctbal") * 2).cast("decimal(18,2)").alias("max_amount"),
        (F.lit(12.5) + F.col("c_custkey") % 10).cast("double").alias("min_rate"),
        (12 * (1 + F.col("c_custkey") % 5)).cast("int").alias("max_term_months"),
        F.lit("PEN").alias("currency"),
        F.when(~ok & (F.col("c_custkey") % 2 == 1), F.lit("Saldo insuficiente")).alias("reason"),
    )


def product_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deposit accounts as the core API lists them (every 13th number too short to show)."""
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    bal = F.col("c_acctbal").cast("decimal(18,2)")
    return c.select(
        k.alias("customer_id"),
        _pick((F.col("c_nationkey") % 4).cast("int"), CURRENCIES).alias("currency"),
        F.when(k % 13 == 0, (k % 1000).cast("string"))
         .otherwise(F.lpad(k.cast("string"), 10, "0")).alias("account_number"),
        bal.alias("available_balance"),
        (bal + 100).alias("total_balance"),
    )


def movements(silver_txns: DataFrame) -> DataFrame:
    """Account movements (credit positive, others negative) from silver transactions."""
    credit = F.col("tipo_transaccion_desc") == "CREDITO"
    return silver_txns.select(
        F.col("cuenta_id").alias("customer_id"), F.col("moneda").alias("currency"),
        F.col("transaccion_id").alias("movement_id"), F.to_date("fecha_transaccion").alias("date"),
        F.when(credit, "credit").otherwise("debit").alias("type"),
        F.col("tipo_transaccion_desc").alias("description"),
        F.when(credit, F.col("monto")).otherwise(-F.col("monto")).alias("amount"))


def credit_cards(silver_cards: DataFrame) -> DataFrame:
    """Credit card products from the current card rows."""
    t = F.col("tarjeta_id")
    limit = (t % 9000).cast("decimal(18,2)")
    used = ((t % 9000) * (t % 7) / 10.0).cast("decimal(18,2)")
    return silver_cards.select(
        F.col("cliente_id").alias("customer_id"),
        t.alias("card_id"),
        F.when(t % 13 == 0, (t % 1000).cast("string"))
         .otherwise(F.lpad(t.cast("string"), 16, "0")).alias("card_number"),
        F.col("tipo_tarjeta").alias("card_type"),
        F.when(F.col("estado_tarjeta") != "DESCONOCIDO", F.col("estado_tarjeta")).alias("status"),
        F.when(t % 5 != 0, F.lit("PEN")).alias("currency"),
        limit.alias("credit_limit"), used.alias("used_balance"),
        (limit - used).alias("available_balance"),
        F.when(t % 11 != 0, F.make_date(F.lit(2001), F.lit(8), (t % 28 + 1).cast("int"))).alias("cut_date"),
        (used * F.lit(0.05).cast("decimal(3,2)")).cast("decimal(18,2)").alias("minimum_payment"),
        used.alias("total_payment"),
    )


def card_movements(silver_txns: DataFrame) -> DataFrame:
    """Card purchases (debit and service payments) from silver transactions."""
    k = F.col("transaccion_id")
    return (silver_txns.filter(F.col("tipo_transaccion_desc").isin("DEBITO", "PAGO_SERVICIO")).select(
        (F.col("tarjeta_id") / 2).cast("bigint").alias("customer_id"),
        k.alias("movement_id"),
        F.to_date("fecha_transaccion").alias("date"),
        F.when(k % 7 != 0, F.concat(F.lit("Comercio "), (k % 50).cast("string"))).alias("merchant"),
        F.col("monto").alias("amount"), F.col("moneda").alias("currency"),
        F.when(k % 5 != 0, (k % 12 + 1).cast("int")).alias("installments")))


def request_severities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classifier scores per request (same arithmetic as ``severities``, on the event id)."""
    e = read_table(spark, sf_dir, "events")
    x = F.col("event_id")
    none = x % 9 == 0

    def lvl(c: Column) -> Column:
        return F.when(none, F.lit(None).cast("int")).otherwise(c.cast("int"))

    return e.select(
        x.alias("request_id"),
        lvl(F.floor((x * 7 % 11) / 4)).alias("hate"),
        lvl(F.floor((x * 3 % 13) / 5)).alias("violence"),
        lvl(F.floor((x % 17) / 8)).alias("self_harm"),
        lvl(F.floor((x * 5 % 19) / 9)).alias("sexual"),
    )


def replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model replies per request with the classifier's scores (every 19th call failed, every 8th reply is unscored)."""
    e = read_table(spark, sf_dir, "events")
    x = F.col("event_id")
    lvl = lambda c: F.when(x % 8 == 0, F.lit(None).cast("int")).otherwise(c.cast("int"))
    return e.select(x.alias("request_id"), F.concat(F.lit("respuesta "), F.col("props")).alias("reply"), (x % 19 == 0).alias("llm_error"),
                    lvl(F.floor((x % 23) / 11)).alias("hate"), lvl(F.floor((x % 29) / 14)).alias("violence"),
                    lvl(F.lit(0)).alias("self_harm"), lvl(F.lit(1)).alias("sexual"))


def account_history_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change feed of the account master: every account is inserted on 2000-01-01; every third is updated
    (100 more) and every seventeenth deleted a month later."""
    a = accounts(spark, sf_dir)
    k = F.col("cuenta_id")
    at = lambda t: F.lit(t).cast("timestamp_ntz")
    first = a.withColumns({"operacion": F.lit("I"), "_ingest_timestamp": at("2000-01-01 00:00:00"), "_change_id": k * 2})
    later = (a.filter((k % 3 == 0) | (k % 17 == 0))
             .withColumns({"saldo_inicial": (F.col("saldo_inicial") + 100).cast("decimal(18,2)"), "operacion": F.when(k % 17 == 0, "D").otherwise("U"),
                           "_ingest_timestamp": at("2000-02-01 00:00:00"), "_change_id": k * 2 + 1}))
    return first.unionByName(later)


def stage_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-request stage results of the chat pipeline (inputs of P19)."""
    e = read_table(spark, sf_dir, "events")
    x = F.col("event_id")
    return e.select(x.alias("request_id"), (x % 13 != 0).alias("token_valid"), (x % 7 == 0).alias("input_blocked"),
                    (x % 19 == 0).alias("llm_error"), (x % 23 == 0).alias("output_blocked"))


def accounts_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Account rows as the source database returns them (raw_cuentas before stamping)."""
    return accounts(spark, sf_dir).withColumn(
        "fecha_apertura", F.timestamp_add("DAY", (F.col("cuenta_id") % 3650).cast("int"),
                                          F.lit("2012-01-01 00:00:00").cast("timestamp_ntz"))
    ).withColumn("operacion", F.lit("I"))


def function_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Model metadata per request: the list of called tools (some names missing)."""
    e = read_table(spark, sf_dir, "events")
    et = F.col("event_type")
    tool = (F.when(et == "view", "get_account_balance").when(et == "purchase", "get_card_movements")
            .when(et == "click", "get_credit_cards"))
    calls = F.array(F.struct(tool.alias("name")),
                    F.struct(F.when(F.col("event_id") % 2 == 0, F.lit("get_loans")).alias("name")))
    return e.select(F.col("event_id").alias("request_id"),
                    F.when(et == "error", F.array().cast("array<struct<name:string>>")).otherwise(calls)
                    .alias("function_calls"))
