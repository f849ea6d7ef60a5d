"""DuckDB oracle SQL per query key.

Each string runs on the driver tables registered as views (region nation
customer supplier part orders lineitem events documents embeddings pages
benchmark labels conversations). The fixture mapping of
``lakebank/sources/fixtures.py`` is restated here as CTE text, so Spark and
the oracle share no code. Money is summed as DECIMAL and cast to DOUBLE once
at the end, matching the Spark side.
"""

from __future__ import annotations

import re

from lakebank.operators import sessions, views

AS_OF = "2001-08-01"
PROCESSED_AT = "2001-08-02 00:00:00"


def _case_mod(expr: str, values: list[str]) -> str:
    whens = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {expr} {whens} END"


CUR = ["PEN", "USD", "EUR", "GBP"]

ACCOUNTS = f"""SELECT c_custkey AS cuenta_id,
  {_case_mod('c_nationkey % 3', ['AHORRO', 'CORRIENTE', 'PLAZO_FIJO'])} AS tipo_producto,
  c_mktsegment AS segmento_cliente,
  {_case_mod('c_nationkey % 4', CUR)} AS moneda,
  CAST(c_acctbal AS DECIMAL(18,2)) AS saldo_inicial
FROM customer
UNION ALL
SELECT s_suppkey + 1000000000 AS cuenta_id, 'CORRIENTE' AS tipo_producto, 'EMPRESA' AS segmento_cliente,
  {_case_mod('s_nationkey % 4', CUR)} AS moneda, CAST(s_acctbal AS DECIMAL(18,2)) AS saldo_inicial
FROM supplier"""

CURRENT_ACCOUNTS = f"""SELECT cuenta_id, tipo_producto, segmento_cliente, moneda,
  CAST(CASE WHEN cuenta_id % 3 = 0 THEN saldo_inicial + 100 ELSE saldo_inicial END AS DECIMAL(18,2)) AS saldo_inicial
FROM ({ACCOUNTS}) a WHERE cuenta_id % 17 <> 0"""

RAW_TXN = f"""SELECT o_orderkey AS transaccion_id,
  CASE WHEN o_orderkey % 89 = 0 THEN NULL ELSE o_custkey END AS cuenta_id,
  o_custkey * 2 + o_orderkey % 2 AS tarjeta_id,
  CASE WHEN o_orderkey % 97 = 0 THEN 'N/A' WHEN o_orderkey % 101 = 0 THEN '0'
       ELSE CAST(o_totalprice AS VARCHAR) END AS monto,
  {_case_mod('o_orderkey % 4', CUR)} AS moneda,
  o_orderdate AS fecha_transaccion,
  CASE WHEN o_orderkey % 53 = 0 THEN NULL
       WHEN substr(o_orderpriority, 1, 1) = '1' THEN 'CR' WHEN substr(o_orderpriority, 1, 1) = '2' THEN 'DB'
       WHEN substr(o_orderpriority, 1, 1) = '3' THEN 'TF' WHEN substr(o_orderpriority, 1, 1) = '4' THEN 'PG'
       ELSE 'XX' END AS tipo_tx_cod,
  CASE WHEN o_orderkey % 37 = 0 THEN NULL WHEN o_orderkey % 31 = 0 THEN CAST(o_custkey % 100 AS VARCHAR)
       ELSE lpad(CAST(o_custkey * 2 + o_orderkey % 2 AS VARCHAR), 16, '0') END AS numero_tarjeta
FROM orders"""

TX_LABEL = """CASE tipo_tx_cod WHEN 'CR' THEN 'CREDITO' WHEN 'DB' THEN 'DEBITO' WHEN 'TF' THEN 'TRANSFERENCIA'
  WHEN 'PG' THEN 'PAGO_SERVICIO' ELSE 'OTROS' END"""

PAN_MASK = """CASE WHEN numero_tarjeta IS NULL THEN NULL WHEN length(numero_tarjeta) < 4 THEN '****-****-****-****'
  ELSE '****-****-****-' || right(numero_tarjeta, 4) END"""

SILVER_UNCHECKED = f"""SELECT transaccion_id, cuenta_id, tarjeta_id, TRY_CAST(monto AS DECIMAL(18,2)) AS monto, moneda,
  CAST(fecha_transaccion AS TIMESTAMP) AS fecha_transaccion, tipo_tx_cod, {TX_LABEL} AS tipo_transaccion_desc,
  {PAN_MASK} AS numero_tarjeta_masked, TIMESTAMP '{PROCESSED_AT}' AS _silver_timestamp
FROM ({RAW_TXN}) r"""

SILVER = f"""SELECT * FROM ({SILVER_UNCHECKED}) u
WHERE coalesce(monto IS NOT NULL AND monto != 0, false) AND coalesce(cuenta_id IS NOT NULL, false)"""

RAW_CARDS = """SELECT o_custkey * 2 + o_orderkey % 2 AS tarjeta_id, o_custkey AS cliente_id,
  CASE o_custkey % 4 WHEN 0 THEN 'VISA' WHEN 1 THEN 'MASTERCARD' WHEN 2 THEN 'AMEX' END AS tipo_tarjeta,
  CASE WHEN o_orderkey % 13 = 0 THEN 'Z'
       WHEN o_orderstatus = 'F' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'A' ELSE '01' END
       WHEN o_orderstatus = 'O' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'B' ELSE '02' END
       WHEN o_orderstatus = 'P' THEN CASE WHEN o_orderkey % 2 = 0 THEN 'C' ELSE '03' END END AS estado_cod,
  o_orderdate AS _ingest_timestamp, o_orderkey AS version_id
FROM orders"""

CARD_STATE = """CASE WHEN estado_cod IN ('A', '01') THEN 'ACTIVA' WHEN estado_cod IN ('B', '02') THEN 'BLOQUEADA'
  WHEN estado_cod IN ('C', '03') THEN 'CANCELADA' ELSE 'DESCONOCIDO' END"""

DEDUP_CARDS = f"""SELECT tarjeta_id, cliente_id, tipo_tarjeta, estado_cod, _ingest_timestamp, version_id FROM (
  SELECT *, row_number() OVER (PARTITION BY tarjeta_id ORDER BY _ingest_timestamp DESC, version_id DESC) AS rn
  FROM ({RAW_CARDS}) r) x WHERE rn = 1"""

SILVER_CARDS = f"SELECT *, {CARD_STATE} AS estado_tarjeta FROM ({DEDUP_CARDS}) d"

CHANGES = """SELECT user_id AS cuenta_id, CAST(value AS DECIMAL(18,2)) AS saldo, event_type AS estado,
  CASE WHEN event_id % 4999 = 2400 THEN 'TRUNCATE' WHEN event_type = 'error' THEN 'D'
       WHEN event_type = 'signup' THEN 'I' ELSE 'U' END AS operacion,
  ts AS _ingest_timestamp, event_id AS _change_id
FROM events"""

DAILY_MOVEMENTS = f"""SELECT cuenta_id, CAST(fecha_transaccion AS DATE) AS fecha_corte,
  sum(CASE WHEN tipo_transaccion_desc = 'CREDITO' THEN monto ELSE 0 END) AS total_creditos,
  sum(CASE WHEN tipo_transaccion_desc = 'DEBITO' THEN -monto ELSE 0 END) AS total_debitos,
  count(*) AS num_transacciones
FROM ({SILVER}) s GROUP BY 1, 2"""

CARD_MONTH = f"""SELECT tarjeta_id, strftime(fecha_transaccion, '%Y-%m') AS anio_mes, count(*) AS num_compras,
  CAST(sum(monto) AS DOUBLE) AS monto_total_consumido,
  CAST(sum(monto) AS DOUBLE) / count(monto) AS ticket_promedio,
  count(DISTINCT CAST(fecha_transaccion AS DATE)) AS dias_activos
FROM ({SILVER}) s WHERE tipo_transaccion_desc IN ('DEBITO', 'PAGO_SERVICIO') GROUP BY 1, 2"""


def scd1_sql(where: str = "TRUE") -> str:
    return f"""WITH ch AS (SELECT * FROM ({CHANGES}) c WHERE {where}),
lt AS (SELECT _ingest_timestamp AS tts, _change_id AS tid FROM ch WHERE operacion = 'TRUNCATE'
       ORDER BY tts DESC, tid DESC LIMIT 1),
live AS (SELECT ch.* FROM ch LEFT JOIN lt ON TRUE
         WHERE (operacion <> 'TRUNCATE' OR operacion IS NULL)
           AND (lt.tts IS NULL OR ch._ingest_timestamp > lt.tts
                OR (ch._ingest_timestamp = lt.tts AND ch._change_id > lt.tid))),
rk AS (SELECT *, row_number() OVER (PARTITION BY cuenta_id ORDER BY _ingest_timestamp DESC, _change_id DESC) AS rn
       FROM live)
SELECT cuenta_id, saldo, estado, operacion FROM rk WHERE rn = 1 AND (operacion <> 'D' OR operacion IS NULL)"""


ORACLE: dict[str, str] = {}

ORACLE["gold_daily_balances"] = f"""
SELECT coalesce(dm.fecha_corte, DATE '{AS_OF}') AS fecha_corte, a.cuenta_id, a.tipo_producto, a.segmento_cliente,
  a.moneda, CAST(a.saldo_inicial + coalesce(dm.total_creditos, 0) + coalesce(dm.total_debitos, 0) AS DOUBLE) AS saldo_cierre,
  CAST(dm.total_creditos AS DOUBLE) AS total_creditos, CAST(dm.total_debitos AS DOUBLE) AS total_debitos,
  dm.num_transacciones
FROM ({CURRENT_ACCOUNTS}) a LEFT JOIN ({DAILY_MOVEMENTS}) dm ON a.cuenta_id = dm.cuenta_id"""

ORACLE["gold_daily_balances_cumulative"] = f"""
SELECT coalesce(dm.fecha_corte, DATE '{AS_OF}') AS fecha_corte, a.cuenta_id, a.tipo_producto, a.segmento_cliente,
  a.moneda, CAST(a.saldo_inicial + sum(coalesce(dm.total_creditos, 0) + coalesce(dm.total_debitos, 0))
    OVER (PARTITION BY a.cuenta_id ORDER BY dm.fecha_corte ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    AS DOUBLE) AS saldo_cierre,
  CAST(dm.total_creditos AS DOUBLE) AS total_creditos, CAST(dm.total_debitos AS DOUBLE) AS total_debitos,
  dm.num_transacciones
FROM ({CURRENT_ACCOUNTS}) a LEFT JOIN ({DAILY_MOVEMENTS}) dm ON a.cuenta_id = dm.cuenta_id"""

ORACLE["agg_daily_movements"] = f"""
SELECT cuenta_id, fecha_corte, CAST(total_creditos AS DOUBLE) AS total_creditos,
  CAST(total_debitos AS DOUBLE) AS total_debitos, num_transacciones FROM ({DAILY_MOVEMENTS}) dm"""

ORACLE["join_left_balances"] = f"""
SELECT a.cuenta_id, a.tipo_producto, a.segmento_cliente, a.moneda, CAST(a.saldo_inicial AS DOUBLE) AS saldo_inicial,
  dm.fecha_corte, CAST(dm.total_creditos AS DOUBLE) AS total_creditos,
  CAST(dm.total_debitos AS DOUBLE) AS total_debitos, dm.num_transacciones
FROM ({ACCOUNTS}) a LEFT JOIN ({DAILY_MOVEMENTS}) dm ON a.cuenta_id = dm.cuenta_id"""

ORACLE["agg_card_month"] = CARD_MONTH

ORACLE["join_inner_cards"] = f"""
SELECT u.*, c.tipo_tarjeta, c.estado_tarjeta, c.cliente_id
FROM ({CARD_MONTH}) u JOIN ({SILVER_CARDS}) c ON u.tarjeta_id = c.tarjeta_id"""

ORACLE["gold_card_usage"] = f"""
SELECT u.*, c.tipo_tarjeta, c.estado_tarjeta, c.cliente_id, CAST(u.dias_activos AS DOUBLE) / 30.0 AS tasa_actividad
FROM ({CARD_MONTH}) u JOIN ({SILVER_CARDS}) c ON u.tarjeta_id = c.tarjeta_id"""

ORACLE["agg_watermark"] = """
SELECT coalesce(max(o_orderdate), TIMESTAMP '2020-01-01 00:00:00') AS watermark FROM orders"""

ORACLE["silver_casts"] = f"""
SELECT transaccion_id, CAST(TRY_CAST(monto AS DECIMAL(18,2)) AS DOUBLE) AS monto,
  CAST(fecha_transaccion AS TIMESTAMP) AS fecha_transaccion FROM ({RAW_TXN}) r"""

ORACLE["code_map"] = f"SELECT transaccion_id, tipo_tx_cod, {TX_LABEL} AS tipo_transaccion_desc FROM ({RAW_TXN}) r"

ORACLE["mask_pan"] = f"SELECT transaccion_id, {PAN_MASK} AS numero_tarjeta_masked FROM ({RAW_TXN}) r"

ORACLE["silver_transactions"] = f"""
SELECT transaccion_id, cuenta_id, tarjeta_id, CAST(monto AS DOUBLE) AS monto, moneda, fecha_transaccion,
  tipo_tx_cod, tipo_transaccion_desc, numero_tarjeta_masked, _silver_timestamp,
  CAST(year(fecha_transaccion) AS INTEGER) AS year_partition, CAST(month(fecha_transaccion) AS INTEGER) AS month_partition,
  TIMESTAMP '{PROCESSED_AT}' AS _ingest_timestamp, 'mainframe_sql_replica' AS _source_system
FROM ({SILVER}) s"""

ORACLE["dq_drop"] = f"SELECT transaccion_id, cuenta_id, CAST(monto AS DOUBLE) AS monto FROM ({SILVER}) s"

ORACLE["dq_warn"] = f"""
SELECT transaccion_id, moneda, coalesce(moneda IN ('PEN', 'USD', 'EUR'), false) AS moneda_valida
FROM ({SILVER_UNCHECKED}) u"""

ORACLE["dq_fail"] = f"SELECT tarjeta_id, version_id FROM ({RAW_CARDS}) r"


def _rule(name, action, pred):
    p = f"coalesce({pred}, false)"
    return (f"SELECT '{name}' AS rule, '{action}' AS action, CAST(count_if({p}) AS BIGINT) AS passed_records, "
            f"CAST(count_if(NOT {p}) AS BIGINT) AS failed_records FROM u")


ORACLE["dq_report"] = f"""WITH u AS ({SILVER_UNCHECKED})
{_rule('monto_valido', 'drop', 'monto IS NOT NULL AND monto != 0')}
UNION ALL {_rule('cuenta_existe', 'drop', 'cuenta_id IS NOT NULL')}
UNION ALL {_rule('moneda_valida', 'warn', "moneda IN ('PEN', 'USD', 'EUR')")}"""

ORACLE["dedup_latest"] = DEDUP_CARDS

ORACLE["code_set_map"] = f"SELECT tarjeta_id, version_id, estado_cod, {CARD_STATE} AS estado_tarjeta FROM ({RAW_CARDS}) r"

ORACLE["silver_cards"] = SILVER_CARDS

ORACLE["filter_in"] = f"""
SELECT transaccion_id, tarjeta_id, tipo_transaccion_desc, CAST(monto AS DOUBLE) AS monto
FROM ({SILVER}) s WHERE tipo_transaccion_desc IN ('DEBITO', 'PAGO_SERVICIO')"""

ORACLE["project_columns"] = f"""
SELECT cuenta_id, tipo_producto, segmento_cliente, moneda, CAST(saldo_inicial AS DOUBLE) AS saldo_inicial
FROM ({ACCOUNTS}) a"""

ORACLE["cdc_scd2"] = f"""
WITH ch AS ({CHANGES}),
tr AS (SELECT _ingest_timestamp AS tts, _change_id AS tid FROM ch WHERE operacion = 'TRUNCATE'),
sq AS (SELECT *, lead(_ingest_timestamp) OVER (PARTITION BY cuenta_id ORDER BY _ingest_timestamp, _change_id) AS nxt
       FROM ch WHERE operacion <> 'TRUNCATE' OR operacion IS NULL)
SELECT cuenta_id, CAST(saldo AS DOUBLE) AS saldo, estado, operacion, _ingest_timestamp AS __START_AT,
  CASE WHEN nxt IS NULL THEN nt WHEN nt IS NULL THEN nxt ELSE least(nxt, nt) END AS __END_AT
FROM (SELECT s.*, (SELECT min(tts) FROM tr WHERE tts > s._ingest_timestamp
                   OR (tts = s._ingest_timestamp AND tid > s._change_id)) AS nt FROM sq s) x
WHERE operacion <> 'D' OR operacion IS NULL"""

ORACLE["cdc_scd1"] = f"SELECT cuenta_id, CAST(saldo AS DOUBLE) AS saldo, estado, operacion FROM ({scd1_sql()}) s"

ORACLE["change_feed"] = f"""
WITH b AS ({scd1_sql("_ingest_timestamp < TIMESTAMP '2024-01-16 00:00:00'")}), a AS ({scd1_sql()}),
j AS (SELECT coalesce(a.cuenta_id, b.cuenta_id) AS k, b.saldo AS b_saldo, b.estado AS b_estado,
        b.operacion AS b_op, a.saldo AS a_saldo, a.estado AS a_estado, a.operacion AS a_op,
        b.cuenta_id IS NOT NULL AS hb, a.cuenta_id IS NOT NULL AS ha,
        (b.saldo IS NOT DISTINCT FROM a.saldo AND b.estado IS NOT DISTINCT FROM a.estado
         AND b.operacion IS NOT DISTINCT FROM a.operacion) AS same
      FROM b FULL OUTER JOIN a ON a.cuenta_id = b.cuenta_id)
SELECT k AS cuenta_id, CAST(a_saldo AS DOUBLE) AS saldo, a_estado AS estado, a_op AS operacion,
  'insert' AS _change_type FROM j WHERE ha AND NOT hb
UNION ALL SELECT k, CAST(b_saldo AS DOUBLE), b_estado, b_op, 'delete' FROM j WHERE hb AND NOT ha
UNION ALL SELECT k, CAST(b_saldo AS DOUBLE), b_estado, b_op, 'update_preimage' FROM j WHERE ha AND hb AND NOT same
UNION ALL SELECT k, CAST(a_saldo AS DOUBLE), a_estado, a_op, 'update_postimage' FROM j WHERE ha AND hb AND NOT same"""

ORACLE["src_derived_partitions"] = f"""
SELECT transaccion_id, fecha_transaccion, CAST(year(fecha_transaccion) AS INTEGER) AS year_partition,
  CAST(month(fecha_transaccion) AS INTEGER) AS month_partition FROM ({RAW_TXN}) r"""

ORACLE["src_incremental"] = f"""
SELECT transaccion_id, fecha_transaccion, CAST(year(fecha_transaccion) AS INTEGER) AS year_partition,
  CAST(month(fecha_transaccion) AS INTEGER) AS month_partition FROM ({RAW_TXN}) r
WHERE fecha_transaccion > (SELECT coalesce(max(o_orderdate), TIMESTAMP '2020-01-01')
                           FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00')
  AND fecha_transaccion <= TIMESTAMP '2001-06-30 00:00:00'"""

ORACLE["ingest_metadata"] = f"""
SELECT cuenta_id, tipo_producto, segmento_cliente, moneda, CAST(saldo_inicial AS DOUBLE) AS saldo_inicial,
  TIMESTAMP '{PROCESSED_AT}' AS _ingest_timestamp, 'mainframe_sql_replica' AS _source_system,
  'batch-0001' AS _batch_id FROM ({ACCOUNTS}) a"""


# ---------------------------------------------------------------- product views

def _money(x: str) -> str:
    return f"format('{{:,.2f}}', CAST(coalesce({x}, 0) AS DOUBLE))"


def _mask_last4(x: str, prefix: str) -> str:
    return (f"CASE WHEN length(coalesce({x}, '')) >= 4 THEN '{prefix}' || right({x}, 4) ELSE '****' END")


PRODUCT_ACCOUNTS = f"""SELECT c_custkey AS customer_id, {_case_mod('c_nationkey % 4', CUR)} AS currency,
  CASE WHEN c_custkey % 13 = 0 THEN CAST(c_custkey % 1000 AS VARCHAR)
       ELSE lpad(CAST(c_custkey AS VARCHAR), 10, '0') END AS account_number,
  CAST(c_acctbal AS DECIMAL(18,2)) AS available_balance, CAST(c_acctbal AS DECIMAL(18,2)) + 100 AS total_balance
FROM customer"""

MOVEMENTS = f"""SELECT cuenta_id AS customer_id, moneda AS currency, transaccion_id AS movement_id,
  CAST(fecha_transaccion AS DATE) AS date,
  CASE WHEN tipo_transaccion_desc = 'CREDITO' THEN 'credit' ELSE 'debit' END AS type,
  tipo_transaccion_desc AS description,
  CASE WHEN tipo_transaccion_desc = 'CREDITO' THEN monto ELSE -monto END AS amount
FROM ({SILVER}) s"""


def top_movements_sql(n: int) -> str:
    return f"""SELECT customer_id, currency, pos, movement_id, date, type, amount,
  '• ' || coalesce(CAST(date AS VARCHAR), 'N/A') || ' | ' || coalesce(description, 'Sin descripción') || ' | '
  || CASE WHEN type = 'credit' THEN '+' ELSE '-' END || {_money('abs(amount)')} || ' PEN' AS line
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, currency ORDER BY date DESC, movement_id DESC) AS pos
      FROM ({MOVEMENTS}) m WHERE currency = 'PEN') x WHERE pos <= {n}"""


BALANCE_LINES = f"""SELECT customer_id, currency, account_number,
  {_mask_last4('account_number', '****')} AS masked,
  '- Cuenta ' || {_mask_last4('account_number', '****')} || ': Disponible: ' || {_money('available_balance')}
  || ' PEN | Total: ' || {_money('total_balance')} || ' PEN' AS line
FROM ({PRODUCT_ACCOUNTS}) a WHERE currency = 'PEN'"""

ORACLE["mask_account"] = f"""SELECT customer_id, account_number, {_mask_last4('account_number', '****')} AS masked
FROM ({PRODUCT_ACCOUNTS}) a"""

ORACLE["view_account_balance"] = BALANCE_LINES

ORACLE["account_movements_topn"] = f"""SELECT customer_id, currency, pos, movement_id, date, type,
  CAST(amount AS DOUBLE) AS amount FROM ({top_movements_sql(5)}) t"""

ORACLE["view_account_movements"] = f"""SELECT customer_id, currency, pos, movement_id, date, type,
  CAST(amount AS DOUBLE) AS amount, line FROM ({top_movements_sql(10)}) t"""

ORACLE["statement_text"] = f"""
WITH g AS (SELECT customer_id, count(*) AS n, string_agg(line, chr(10) ORDER BY pos) AS body
           FROM ({top_movements_sql(5)}) t GROUP BY 1)
SELECT c.cuenta_id AS customer_id, coalesce(g.n, 0) AS n_items,
  CASE WHEN g.customer_id IS NULL THEN 'No hay movimientos recientes en tu cuenta PEN.'
       ELSE 'Últimos ' || g.n || ' movimientos en PEN:' || chr(10) || g.body END AS text
FROM ({ACCOUNTS}) c LEFT JOIN g ON g.customer_id = c.cuenta_id"""

ORACLE["account_balance_text"] = f"""
WITH g AS (SELECT customer_id, count(*) AS n, string_agg(line, chr(10) ORDER BY account_number) AS body
           FROM ({BALANCE_LINES}) t GROUP BY 1)
SELECT c.cuenta_id AS customer_id, coalesce(g.n, 0) AS n_items,
  CASE WHEN g.customer_id IS NULL THEN 'No se encontraron cuentas en PEN para el cliente.'
       ELSE 'Saldos de cuentas en PEN:' || chr(10) || g.body END AS text
FROM ({ACCOUNTS}) c LEFT JOIN g ON g.customer_id = c.cuenta_id"""

CARDS = f"""SELECT cliente_id AS customer_id, tarjeta_id AS card_id,
  CASE WHEN tarjeta_id % 13 = 0 THEN CAST(tarjeta_id % 1000 AS VARCHAR)
       ELSE lpad(CAST(tarjeta_id AS VARCHAR), 16, '0') END AS card_number,
  tipo_tarjeta AS card_type, CASE WHEN estado_tarjeta <> 'DESCONOCIDO' THEN estado_tarjeta END AS status,
  CASE WHEN tarjeta_id % 5 <> 0 THEN 'PEN' END AS currency,
  CAST(tarjeta_id % 9000 AS DECIMAL(18,2)) AS credit_limit,
  CAST((tarjeta_id % 9000) * (tarjeta_id % 7) / 10.0 AS DECIMAL(18,2)) AS used_balance,
  CAST(tarjeta_id % 9000 AS DECIMAL(18,2)) - CAST((tarjeta_id % 9000) * (tarjeta_id % 7) / 10.0 AS DECIMAL(18,2))
    AS available_balance,
  CASE WHEN tarjeta_id % 11 <> 0 THEN make_date(2001, 8, CAST(tarjeta_id % 28 + 1 AS INTEGER)) END AS cut_date,
  CAST(CAST((tarjeta_id % 9000) * (tarjeta_id % 7) / 10.0 AS DECIMAL(18,2)) * CAST(0.05 AS DECIMAL(3,2))
       AS DECIMAL(18,2)) AS minimum_payment,
  CAST((tarjeta_id % 9000) * (tarjeta_id % 7) / 10.0 AS DECIMAL(18,2)) AS total_payment
FROM ({SILVER_CARDS}) c"""

UTIL = """CASE WHEN CAST(coalesce(credit_limit, 0) AS DOUBLE) > 0
  THEN CAST(coalesce(used_balance, 0) AS DOUBLE) / CAST(coalesce(credit_limit, 0) AS DOUBLE) * 100.0 ELSE 0.0 END"""

CARDS_VIEW = f"""SELECT customer_id, card_id, {_mask_last4('card_number', '**** **** **** ')} AS masked,
  coalesce(card_type, 'VISA') AS card_type, coalesce(status, 'ACTIVA') AS status,
  coalesce(currency, 'PEN') AS currency, {_money('credit_limit')} AS credit_limit,
  {_money('used_balance')} AS used_balance, {UTIL} AS utilization_pct,
  format('{{:,.1f}}', {UTIL}) AS utilization, {_money('available_balance')} AS available_balance,
  coalesce(CAST(cut_date AS VARCHAR), 'N/A') AS cut_date, {_money('minimum_payment')} AS minimum_payment,
  {_money('total_payment')} AS total_payment
FROM ({CARDS}) c"""

ORACLE["view_credit_cards"] = CARDS_VIEW

ORACLE["card_utilization"] = f"""SELECT card_id, CAST(credit_limit AS DOUBLE) AS credit_limit,
  CAST(used_balance AS DOUBLE) AS used_balance,
  CASE WHEN CAST(credit_limit AS DOUBLE) > 0 THEN CAST(used_balance AS DOUBLE) / CAST(credit_limit AS DOUBLE) * 100.0
       ELSE 0.0 END AS utilization_pct FROM ({CARDS}) c"""

ORACLE["default_fill"] = f"SELECT card_id, card_type, status, currency, cut_date FROM ({CARDS_VIEW}) v"

CARD_MOVEMENTS = f"""SELECT tarjeta_id // 2 AS customer_id, transaccion_id AS movement_id,
  CAST(fecha_transaccion AS DATE) AS date,
  CASE WHEN transaccion_id % 7 <> 0 THEN 'Comercio ' || CAST(transaccion_id % 50 AS VARCHAR) END AS merchant,
  monto AS amount, moneda AS currency,
  CASE WHEN transaccion_id % 5 <> 0 THEN CAST(transaccion_id % 12 + 1 AS INTEGER) END AS installments
FROM ({SILVER}) s WHERE tipo_transaccion_desc IN ('DEBITO', 'PAGO_SERVICIO')"""


def card_movements_sql(n: int) -> str:
    return f"""SELECT customer_id, movement_id, coalesce(CAST(date AS VARCHAR), 'N/A') AS date,
  coalesce(merchant, 'Comercio') AS merchant, {_money('amount')} AS amount, coalesce(currency, 'PEN') AS currency,
  coalesce(installments, 1) AS installments, {n} AS days
FROM ({CARD_MOVEMENTS}) m
WHERE date >= DATE '{AS_OF}' - INTERVAL {n} DAY AND date <= DATE '{AS_OF}'"""


ORACLE["view_card_movements"] = card_movements_sql(30)
ORACLE["view_card_movements_capped"] = card_movements_sql(90)

LOANS = f"""SELECT o_custkey AS customer_id, 'LN' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS loan_id,
  CASE o_orderstatus WHEN 'F' THEN 'Personal' WHEN 'O' THEN 'Vehicular' END AS loan_type,
  CAST(o_totalprice AS DECIMAL(18,2)) AS outstanding_balance,
  CAST((o_orderkey % 500) * 10 + 150 AS DECIMAL(18,2)) AS monthly_payment,
  5.0::DOUBLE + (o_orderkey % 20) / 2.0::DOUBLE AS annual_rate,
  CAST(o_orderkey % 36 AS INTEGER) AS remaining_installments,
  CAST(o_orderdate AS DATE) + INTERVAL 30 DAY AS next_due_date,
  CASE o_orderkey % 2 WHEN 0 THEN 'PEN' WHEN 1 THEN 'USD' END AS currency
FROM orders"""

ORACLE["view_loans"] = f"""SELECT customer_id, left(coalesce(loan_id, 'N/A'), 8) AS loan_ref,
  coalesce(loan_type, 'Personal') AS loan_type, {_money('outstanding_balance')} AS outstanding_balance,
  coalesce(currency, 'PEN') AS currency, {_money('monthly_payment')} AS monthly_payment,
  format('{{:,.2f}}', coalesce(annual_rate, 0.0)) AS annual_rate,
  coalesce(remaining_installments, 0) AS remaining_installments,
  coalesce(CAST(CAST(next_due_date AS DATE) AS VARCHAR), 'N/A') AS next_due_date
FROM ({LOANS}) l"""

ELIG = """SELECT c_custkey AS customer_id, c_acctbal > 0 AS eligible, CAST(c_acctbal * 2 AS DECIMAL(18,2)) AS max_amount,
  CAST(12.5 + c_custkey % 10 AS DOUBLE) AS min_rate, CAST(12 * (1 + c_custkey % 5) AS INTEGER) AS max_term_months,
  'PEN' AS currency, CASE WHEN NOT (c_acctbal > 0) AND c_custkey % 2 = 1 THEN 'Saldo insuficiente' END AS reason
FROM customer"""

ORACLE["view_loan_eligibility"] = f"""SELECT customer_id, coalesce(eligible, false) AS eligible,
  CASE WHEN coalesce(eligible, false) THEN {_money('max_amount')} END AS max_amount,
  CASE WHEN coalesce(eligible, false) THEN coalesce(currency, 'PEN') END AS currency,
  CASE WHEN coalesce(eligible, false) THEN format('{{:,.2f}}', coalesce(min_rate, 0.0)) END AS min_rate,
  CASE WHEN coalesce(eligible, false) THEN coalesce(max_term_months, 0) END AS max_term_months,
  CASE WHEN NOT coalesce(eligible, false) THEN coalesce(reason, 'No disponible') END AS reason
FROM ({ELIG}) e"""

ORACLE["view_transfer_limits"] = f"""
WITH d AS (SELECT cuenta_id AS customer_id, CAST(fecha_transaccion AS DATE) AS day, sum(monto) AS daily_used
           FROM ({SILVER}) s WHERE tipo_transaccion_desc = 'TRANSFERENCIA' GROUP BY 1, 2)
SELECT customer_id, day, CAST(daily_used AS DOUBLE) AS daily_used, CAST(20000 AS DOUBLE) AS daily_limit,
  CAST(sum(daily_used) OVER (PARTITION BY customer_id, date_trunc('month', day) ORDER BY day
       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DOUBLE) AS monthly_used,
  CAST(200000 AS DOUBLE) AS monthly_limit, CAST(greatest(20000 - daily_used, 0) AS DOUBLE) AS daily_available
FROM d"""


def _fill(template: str, **given: str) -> str:
    """SQL for a fixed text with its names replaced by columns."""
    parts = re.split(r"\{(\w+)\}", template)
    return " || ".join(f"'{x}'" if i % 2 == 0 else f"CAST({given.get(x, x)} AS VARCHAR)" for i, x in enumerate(parts))


def _texts(lines: str, order: str, heading: str, empty: str) -> str:
    return f"""WITH g AS (SELECT customer_id, count(*) AS n, string_agg(line, chr(10) ORDER BY {order}) AS body FROM ({lines}) t GROUP BY 1)
SELECT c.cuenta_id AS customer_id, coalesce(g.n, 0) AS n_items,
  CASE WHEN g.customer_id IS NULL THEN '{empty}' ELSE '{heading}' || chr(10) || g.body END AS text
FROM ({ACCOUNTS}) c LEFT JOIN g ON g.customer_id = c.cuenta_id"""


ORACLE["credit_cards_text"] = _texts(f"SELECT *, {_fill(views.CARD_ITEM)} AS line FROM ({CARDS_VIEW}) v", "card_id",
                                     views.CARDS_HEADING, views.CARDS_EMPTY)
ORACLE["card_movements_text"] = _texts(
    f"SELECT *, {_fill(views.CARD_MOVEMENT_ITEM)} AS line FROM ({card_movements_sql(90)}) v", "date DESC, movement_id",
    views.CARD_MOVEMENTS_HEADING.format(days=90), views.CARD_MOVEMENTS_EMPTY.format(days=90))
ORACLE["loans_text"] = _texts(f"SELECT *, {_fill(views.LOAN_ITEM)} AS line FROM ({ORACLE['view_loans']}) v",
                              "loan_ref, next_due_date, line", views.LOANS_HEADING, views.LOANS_EMPTY)
ORACLE["loan_eligibility_text"] = f"""SELECT c.cuenta_id AS customer_id,
  CASE WHEN v.eligible THEN {_fill(views.OFFER_TEXT)} ELSE {_fill(views.NO_OFFER_TEXT, reason="coalesce(reason, 'No disponible')")} END AS text
FROM ({ACCOUNTS}) c LEFT JOIN ({ORACLE['view_loan_eligibility']}) v ON v.customer_id = c.cuenta_id"""
ORACLE["transfer_limits_text"] = f"""WITH u AS (
  SELECT cuenta_id, sum(CASE WHEN CAST(fecha_transaccion AS DATE) = DATE '2001-07-16' THEN monto END) AS d, sum(monto) AS m
  FROM ({SILVER}) s WHERE tipo_transaccion_desc = 'TRANSFERENCIA' AND CAST(fecha_transaccion AS DATE) BETWEEN DATE '2001-07-01' AND DATE '2001-07-16'
  GROUP BY 1)
SELECT c.cuenta_id AS customer_id, {_fill(views.TRANSFER_TEXT, daily_used=_money('d'), daily_limit=_money('20000'), monthly_used=_money('m'),
                                          monthly_limit=_money('200000'), daily_available=_money('greatest(20000 - coalesce(d, 0), 0)'))} AS text
FROM ({ACCOUNTS}) c LEFT JOIN u ON u.cuenta_id = c.cuenta_id"""


# ---------------------------------------------------------------- sessions and cache

MESSAGES = "SELECT conv_id AS session_id, turn, role, text FROM conversations"


def history_trim_sql(cap: int) -> str:
    return f"""WITH m AS ({MESSAGES}),
n AS (SELECT session_id, count(*) AS n FROM m GROUP BY 1),
mm AS (SELECT m.*, n.n FROM m JOIN n ON m.session_id = n.session_id),
k AS (SELECT session_id, turn, role, text, 0 AS g FROM mm WHERE n <= {cap}
      UNION ALL SELECT session_id, turn, role, text, 0 FROM mm WHERE n > {cap} AND role = 'system'
      UNION ALL SELECT session_id, turn, role, text, 1 FROM (
          SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY turn DESC) AS rn
          FROM mm WHERE n > {cap} AND (role <> 'system' OR role IS NULL)) x
        WHERE rn <= {cap - 1} AND role IN ('user', 'assistant'))
SELECT session_id, turn, role, text, row_number() OVER (PARTITION BY session_id ORDER BY g, turn) AS pos FROM k"""


ORACLE["history_trim"] = history_trim_sql(5)
ORACLE["history_trim_20"] = history_trim_sql(20)

ORACLE["session_history"] = f"""SELECT session_id, count(*) AS n_messages, string_agg(role, ',' ORDER BY pos) AS roles,
  md5(string_agg(text, chr(10) ORDER BY pos)) AS digest
FROM ({history_trim_sql(5)}) h WHERE role IN ('system', 'user', 'assistant') GROUP BY 1"""

SYSTEM_PROMPT_SQL = sessions.SYSTEM_PROMPT.replace("{rag_context}", sessions.NO_CONTEXT)

ORACLE["prompt_assembly"] = f"""WITH m AS ({MESSAGES}),
u AS (SELECT session_id, turn FROM m WHERE role = 'user'),
p AS (SELECT u.session_id, u.turn AS ask, m.turn, m.role, m.text,
        count(*) OVER (PARTITION BY u.session_id, u.turn) AS n,
        row_number() OVER (PARTITION BY u.session_id, u.turn, coalesce(m.role, '') = 'system' ORDER BY m.turn DESC) AS rn
      FROM u JOIN m ON m.session_id = u.session_id AND m.turn < u.turn),
h AS (SELECT session_id, ask AS turn, count(*) AS n_prior,
        md5(string_agg(role || ': ' || text, chr(10) ORDER BY n > 20 AND role <> 'system', p.turn)) AS prior_md5
      FROM p WHERE role IN ('system', 'user', 'assistant') AND (role = 'system' OR n <= 20 OR rn <= 19) GROUP BY 1, 2),
x AS (SELECT u.*, coalesce(n_prior, 0) AS n_prior, prior_md5 FROM u LEFT JOIN h ON h.session_id = u.session_id AND h.turn = u.turn)
SELECT session_id, turn, n_prior, n_prior = 0 AS system_added,
  n_prior + 1 + CASE WHEN n_prior = 0 THEN 1 ELSE 0 END AS prompt_size,
  CASE WHEN n_prior = 0 THEN '{SYSTEM_PROMPT_SQL}' END AS system_text, prior_md5
FROM x"""


def session_ttl_sql(ttl: int) -> str:
    return f"""WITH e AS (SELECT user_id, ts, event_id, coalesce(event_type = 'error', false) AS lo FROM events),
p AS (SELECT *, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pt,
             lag(lo) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pl FROM e),
s AS (SELECT *, CAST(sum(CASE WHEN pt IS NULL OR date_diff('microsecond', pt, ts) >= {ttl * 1_000_000} OR pl
                              THEN 1 ELSE 0 END)
                 OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_no FROM p)
SELECT user_id, session_no, min(ts) AS started_at, max(ts) AS last_activity, count(*) AS n_events,
  CASE WHEN arg_max(lo, (ts, event_id)) THEN 'logout' ELSE 'ttl' END AS ended_by,
  CASE WHEN arg_max(lo, (ts, event_id)) THEN max(ts) ELSE max(ts) + INTERVAL {ttl} SECOND END AS expires_at
FROM s GROUP BY 1, 2"""


ORACLE["session_ttl"] = session_ttl_sql(1800)
ORACLE["session_ttl_12h"] = session_ttl_sql(43200)

CACHE_EVENTS = """SELECT event_id, 'C' || lpad(CAST(user_id AS VARCHAR), 6, '0') AS customer_id,
  CASE WHEN event_type = 'error' THEN NULL
       ELSE CASE event_id % 3 WHEN 0 THEN 'balance' WHEN 1 THEN 'cards' WHEN 2 THEN 'loans' END END AS data_type,
  ts, CASE event_type WHEN 'purchase' THEN 'put' WHEN 'error' THEN 'invalidate' ELSE 'request' END AS kind
FROM events"""


def ttl_lookup_sql(ttl: int) -> str:
    return f"""WITH ce AS ({CACHE_EVENTS}),
ev AS (SELECT event_id, customer_id, data_type, ts, kind FROM ce WHERE kind <> 'invalidate'
       UNION ALL SELECT event_id, customer_id, t.data_type, ts, kind FROM ce,
         (SELECT unnest(['balance', 'cards', 'loans']) AS data_type) t WHERE kind = 'invalidate'),
r AS (SELECT *, max(CASE WHEN kind = 'put' THEN (ts, event_id) END) OVER w AS put,
             max(CASE WHEN kind = 'invalidate' THEN (ts, event_id) END) OVER w AS inv
      FROM ev WINDOW w AS (PARTITION BY customer_id, data_type ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING))
SELECT event_id, customer_id, data_type, ts, put[1] AS last_put, inv[1] AS last_invalidation,
  coalesce(put IS NOT NULL AND (inv IS NULL OR inv < put)
           AND date_diff('microsecond', put[1], ts) < {ttl * 1_000_000}, false) AS hit
FROM r WHERE kind = 'request'"""


ORACLE["ttl_lookup"] = ttl_lookup_sql(300)
ORACLE["ttl_lookup_1d"] = ttl_lookup_sql(86400)


# ---------------------------------------------------------------- security and guardrails

CUST = "'C' || lpad(CAST(user_id AS VARCHAR), 6, '0')"
REQUESTS = f"""SELECT event_id AS request_id, 'S' || CAST(user_id AS VARCHAR) AS session_id,
  CASE WHEN event_id % 19 = 0 THEN 'C' ELSE {CUST} END AS customer_id, ts,
  CASE WHEN event_id % 17 = 0 THEN 'Basic abc' ELSE 'Bearer tok' || CAST(event_id AS VARCHAR) END AS "authorization",
  CASE WHEN event_id % 23 = 0 THEN '   ' WHEN event_id % 29 = 0 THEN repeat('x', 2001) WHEN event_id % 31 = 0 THEN ''
       ELSE 'consulta ' || event_type || ' ' || props END AS message
FROM events"""

EPOCH = "date_diff('second', TIMESTAMP '1970-01-01 00:00:00', ts)"
CLAIMS = f"""SELECT event_id AS request_id,
  CASE WHEN event_id % 11 = 0 THEN 'C' || lpad(CAST(user_id + 1 AS VARCHAR), 6, '0') ELSE {CUST} END AS sub,
  'O' || CAST(event_id AS VARCHAR) AS oid,
  CASE WHEN event_id % 7 = 0 THEN {CUST} END AS extension_customer_id,
  CASE event_id % 4 WHEN 1 THEN 'banking.read' WHEN 2 THEN 'banking.agent'
       WHEN 3 THEN 'banking.loans.read banking.cards.read' END AS scp,
  CASE WHEN event_id % 13 = 0 THEN {EPOCH} - 1 ELSE {EPOCH} + 3600 END AS exp
FROM events"""

ORACLE["scope_flags"] = f"""SELECT request_id, array_to_string(s, ' ') AS scopes,
  list_contains(s, 'banking.agent') OR list_contains(s, 'banking.read') AS has_scope,
  list_contains(s, 'banking.loans.read') OR list_contains(s, 'banking.read') AS can_query_loans,
  list_contains(s, 'banking.cards.read') OR list_contains(s, 'banking.read') AS can_query_cards
FROM (SELECT request_id, string_split(coalesce(scp, 'banking.read'), ' ') AS s FROM ({CLAIMS}) c) x"""

ORACLE["claim_match"] = f"""SELECT r.request_id, r.customer_id,
  coalesce(r.customer_id IN (coalesce(c.sub, ''), coalesce(c.oid, ''), coalesce(c.extension_customer_id, '')),
           false) AS matched
FROM ({REQUESTS}) r JOIN ({CLAIMS}) c ON r.request_id = c.request_id"""

ORACLE["request_check"] = f"""SELECT request_id,
  CASE WHEN message IS NULL OR length(message) < 1 OR length(message) > 2000 THEN 422
       WHEN NOT coalesce(starts_with("authorization", 'Bearer '), false) THEN 401
       WHEN coalesce(length(customer_id), 0) < 3 THEN 400 ELSE 200 END AS status,
  CASE WHEN coalesce(starts_with("authorization", 'Bearer '), false)
       THEN trim(regexp_replace("authorization", '^Bearer ', '')) END AS token,
  trim(message) AS message_clean, coalesce(length(trim(message)) = 0, false) AS is_blank
FROM ({REQUESTS}) r"""

STAGES = """SELECT event_id AS request_id, event_id % 13 <> 0 AS token_valid, event_id % 7 = 0 AS input_blocked,
  event_id % 19 = 0 AS llm_error, event_id % 23 = 0 AS output_blocked FROM events"""

OUTCOMES = f"""SELECT request_id,
  CASE WHEN NOT coalesce(token_valid, false) THEN 'unauthorized' WHEN coalesce(input_blocked, false) THEN 'content_blocked'
       WHEN coalesce(llm_error, false) THEN 'llm_error' WHEN coalesce(output_blocked, false) THEN 'output_blocked'
       ELSE 'ok' END AS outcome,
  CASE WHEN NOT coalesce(token_valid, false) THEN 'UNAUTHORIZED'
       WHEN coalesce(input_blocked, false) THEN 'CONTENT_BLOCKED' END AS error
FROM ({STAGES}) s"""

ORACLE["chat_outcome"] = f"""SELECT request_id, outcome, error,
  CASE WHEN error = 'UNAUTHORIZED' THEN 401 WHEN error = 'CONTENT_BLOCKED' THEN 422 ELSE 200 END AS http_status
FROM ({OUTCOMES}) o"""

ORACLE["request_outcome"] = f"""SELECT http_status, count(*) AS n FROM (
  SELECT CASE WHEN error = 'UNAUTHORIZED' THEN 401 WHEN error = 'CONTENT_BLOCKED' THEN 422 ELSE 200 END AS http_status
  FROM ({OUTCOMES}) o) x GROUP BY 1"""

REF_PATTERNS = ["número completo de tarjeta", "clave secreta", "pin bancario", "contraseña", "cvv",
                "clave dinámica"]
TEST_PATTERNS = ["thwh", "ouè", "anan", "eaux"]


def _first_pattern(text: str, patterns: list[str]) -> str:
    whens = " ".join(f"WHEN contains(lower({text}), '{p}') THEN '{p}'" for p in patterns)
    return f"CASE {whens} END"


def guard_patterns_sql(patterns: list[str]) -> str:
    fp = _first_pattern("text", patterns)
    return f"""SELECT session_id, turn, {fp} AS pattern,
  CASE WHEN {fp} IS NOT NULL THEN 'Patrón bancario sensible detectado: ''' || {fp} || '''' END AS pattern_reason
FROM ({MESSAGES}) m"""


ORACLE["guard_patterns"] = guard_patterns_sql(REF_PATTERNS)
ORACLE["guard_patterns_custom"] = guard_patterns_sql(TEST_PATTERNS)


def _lvl(e: str) -> str:
    return f"CASE WHEN (conv_id * 100 + turn) % 9 = 0 THEN NULL ELSE CAST(floor({e}) AS INTEGER) END"


SEVERITIES = f"""SELECT conv_id AS session_id, turn,
  {_lvl('((conv_id * 100 + turn) * 7 % 11) / 4')} AS hate,
  {_lvl('((conv_id * 100 + turn) * 3 % 13) / 5')} AS violence,
  {_lvl('((conv_id * 100 + turn) % 17) / 8')} AS self_harm,
  {_lvl('((conv_id * 100 + turn) * 5 % 19) / 9')} AS sexual
FROM conversations"""

SEV_DECISION = f"""SELECT *,
  CASE WHEN nv THEN 'service_error'
       WHEN mx >= 2 THEN printf('Categoría ''%s'' con severidad %d', cat, mx) ELSE 'OK' END AS severity_reason,
  NOT nv AND mx >= 2 AS severity_blocked, CASE WHEN NOT nv THEN mx END AS max_severity
FROM (SELECT *, CASE WHEN coalesce(hate, 0) = mx THEN 'hate' WHEN coalesce(violence, 0) = mx THEN 'violence'
                     WHEN coalesce(self_harm, 0) = mx THEN 'self_harm' ELSE 'sexual' END AS cat
      FROM (SELECT *, greatest(coalesce(hate, 0), coalesce(violence, 0), coalesce(self_harm, 0),
                               coalesce(sexual, 0)) AS mx,
                   hate IS NULL AND violence IS NULL AND self_harm IS NULL AND sexual IS NULL AS nv
            FROM sv) a) b"""

ORACLE["guard_severity"] = f"""WITH sv AS ({SEVERITIES})
SELECT session_id, turn, max_severity, severity_blocked, severity_reason FROM ({SEV_DECISION}) d"""


def guard_sql(direction: str) -> str:
    fp = _first_pattern("m.text", TEST_PATTERNS)
    pat = f"{fp} IS NOT NULL" if direction == "input" else "false"
    reason = f"'Patrón bancario sensible detectado: ''' || {fp} || ''''" if direction == "input" else "NULL"
    return f"""WITH sv AS (SELECT m.session_id, m.turn, m.text, s.hate, s.violence, s.self_harm, s.sexual
            FROM ({MESSAGES}) m LEFT JOIN ({SEVERITIES}) s ON m.session_id = s.session_id AND m.turn = s.turn),
d AS ({SEV_DECISION.replace('FROM sv', 'FROM sv m')})
SELECT session_id, turn, ({pat}) OR severity_blocked AS is_blocked,
  CASE WHEN {pat} THEN {reason} ELSE severity_reason END AS reason
FROM d m"""


ORACLE["guard_input"] = guard_sql("input")
ORACLE["guard_output"] = guard_sql("output")


# ---------------------------------------------------------------- retrieval

TOKS = "list_filter(regexp_split_to_array(lower({c}), '[^\\p{{L}}\\p{{N}}]+'), lambda t: length(t) > 0)"

Q_VEC = """SELECT b.item_id AS query_id, e.embedding AS qv FROM benchmark b JOIN embeddings e ON e.vec_id = b.item_id"""
C_VEC = """SELECT CAST(d.doc_id AS VARCHAR) AS id, e.embedding AS v
FROM documents d JOIN embeddings e ON e.vec_id = d.doc_id"""


def knn_sql(k: int) -> str:
    return f"""WITH s AS (SELECT q.query_id, c.id,
         list_dot_product(CAST(q.qv AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS score
       FROM ({Q_VEC}) q, ({C_VEC}) c)
SELECT query_id, id, score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id ASC) AS rank FROM s) x
WHERE rank <= {k}"""


def bm25_sql(k: int) -> str:
    dt = TOKS.format(c="text")
    return f"""WITH d AS (SELECT CAST(doc_id AS VARCHAR) AS id, {dt} AS toks FROM documents),
dl AS (SELECT id, len(toks) AS dl FROM d),
stats AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl),
qt AS (SELECT DISTINCT query_id, term FROM (SELECT item_id AS query_id, unnest({dt}) AS term FROM benchmark) q),
post AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest(toks) AS term FROM d) x
         WHERE term IN (SELECT term FROM qt) GROUP BY 1, 2),
dfreq AS (SELECT term, count(*) AS df FROM post GROUP BY 1),
sc AS (SELECT qt.query_id, post.id,
         sum(ln(1.0 + (stats.n - dfreq.df + 0.5) / (dfreq.df + 0.5)) * CAST(post.tf AS DOUBLE) * 2.2
             / (CAST(post.tf AS DOUBLE) + 1.2 * (0.25 + 0.75 * dl.dl / stats.avgdl))) AS raw_score
       FROM post JOIN dfreq ON post.term = dfreq.term JOIN dl ON dl.id = post.id
         JOIN qt ON qt.term = post.term, stats GROUP BY 1, 2)
SELECT query_id, id, raw_score AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(raw_score, 9) DESC, id ASC) AS rank FROM sc) x
WHERE rank <= {k}"""


ORACLE["knn_topk"] = f"SELECT query_id, id, round(score, 6) AS score, rank FROM ({knn_sql(3)}) t"
ORACLE["keyword_topk"] = f"SELECT query_id, id, round(score, 6) AS score, rank FROM ({bm25_sql(3)}) t"

HYBRID = f"""SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rrf_score DESC, id ASC) AS rank FROM (
    SELECT coalesce(v.query_id, k.query_id) AS query_id, coalesce(v.id, k.id) AS id,
      v.rank AS vector_rank, k.rank AS keyword_rank, v.score AS vector_score,
      coalesce(1.0::DOUBLE / (60 + v.rank), 0.0) + coalesce(1.0::DOUBLE / (60 + k.rank), 0.0) AS rrf_score
    FROM ({knn_sql(3)}) v FULL OUTER JOIN ({bm25_sql(1 << 40)}) k ON v.query_id = k.query_id AND v.id = k.id) f) x
WHERE rank <= 3"""

ORACLE["hybrid_topk"] = f"""SELECT query_id, id, rank, vector_rank, keyword_rank, round(rrf_score, 6) AS rrf_score
FROM ({HYBRID}) h"""

FALLBACK = f"""SELECT * FROM (SELECT *, coalesce(nullif(vector_score, 0.0), rrf_score * 30.0, 0.0) AS score
  FROM ({HYBRID}) h) x WHERE score >= 0.6"""

ORACLE["score_fallback_filter"] = f"SELECT query_id, rank, id, round(score, 6) AS score FROM ({FALLBACK}) f"

ORACLE["rag_context"] = f"""WITH h AS (SELECT f.query_id, f.rank, f.score, d.text AS content
           FROM ({FALLBACK}) f JOIN documents d ON CAST(d.doc_id AS VARCHAR) = f.id),
p AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY rank) AS pos FROM h),
g AS (SELECT query_id, count(*) AS n, string_agg(chr(10) || '[Fuente ' || pos || ' | Relevancia: '
        || format('{{:,.2f}}', score) || ']' || chr(10) || regexp_replace(content, '^\\s+|\\s+$', '', 'g'),
        chr(10) ORDER BY pos) AS body FROM p GROUP BY 1)
SELECT b.item_id AS query_id, coalesce(g.n, 0) AS n_hits,
  CASE WHEN g.query_id IS NULL THEN ''
       ELSE '--- Información de la base de conocimiento del banco ---' || chr(10) || g.body || chr(10)
            || '--- Fin del contexto ---' END AS context
FROM benchmark b LEFT JOIN g ON g.query_id = b.item_id"""

DOC_INDEX = """SELECT CAST(d.doc_id AS VARCHAR) AS id, 'doc-' || CAST(d.doc_id AS VARCHAR) AS title, d.text AS content,
  d.source, d.lang AS product_type, CAST(d.doc_id AS VARCHAR) AS chunk_id, e.vec_id IS NOT NULL AS has_vector
FROM documents d LEFT JOIN embeddings e ON e.vec_id = d.doc_id"""

UPSERT_BATCH = """SELECT CAST(item_id * 7 AS VARCHAR) AS id, 'faq-' || CAST(item_id AS VARCHAR) AS title, text AS content,
  'faq' AS source, 'faq' AS product_type, 1 AS _seq FROM benchmark
UNION ALL SELECT CAST(item_id * 7 AS VARCHAR), 'faq-v2-' || CAST(item_id AS VARCHAR), text, 'faq', 'faq', 2
  FROM benchmark WHERE item_id % 3 = 0
UNION ALL SELECT 'new-' || CAST(item_id AS VARCHAR), 'faq-' || CAST(item_id AS VARCHAR), text, 'faq', 'faq', 1
  FROM benchmark"""

ORACLE["doc_upsert"] = f"""WITH b AS (SELECT id, title, content, source, product_type FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY _seq DESC) AS rn FROM ({UPSERT_BATCH}) u) x WHERE rn = 1)
SELECT t.id, t.title, t.content, t.source, t.product_type, t.chunk_id, t.has_vector FROM ({DOC_INDEX}) t
WHERE t.id NOT IN (SELECT id FROM b)
UNION ALL SELECT id, title, content, source, product_type, id, false FROM b"""


# ---------------------------------------------------------------- streaming

ORACLE["stream_cdc_target"] = ORACLE["cdc_scd2"]



def session_stream_sql(batch: str) -> str:
    """Every session of the batch rules; a customer's last one is still open unless a logout ended it."""
    return f"""SELECT user_id, started_at, last_activity, n_events,
  CASE WHEN ended_by = 'ttl' AND session_no = max(session_no) OVER (PARTITION BY user_id) THEN 'open' ELSE ended_by END AS ended_by,
  expires_at FROM ({batch}) s"""


ORACLE["session_stream"] = session_stream_sql(session_ttl_sql(1800).replace("event_type = 'error'", "false"))
ORACLE["session_stream_logout"] = session_stream_sql(session_ttl_sql(1800))


# ---------------------------------------------------------------- sinks and catalog

ORACLE["sink_partitioned"] = f"""SELECT transaccion_id, fecha_transaccion, CAST(year(fecha_transaccion) AS INTEGER) AS year_partition,
  CAST(month(fecha_transaccion) AS INTEGER) AS month_partition, tipo_tx_cod
FROM ({RAW_TXN}) r"""

ORACLE["scan_table"] = ORACLE["project_columns"]


# ---------------------------------------------------------------- remaining CDC keys and composites

def scd2_sql(where: str = "TRUE") -> str:
    return f"""WITH ch AS (SELECT * FROM ({CHANGES}) c WHERE {where}),
tr AS (SELECT _ingest_timestamp AS tts, _change_id AS tid FROM ch WHERE operacion = 'TRUNCATE'),
sq AS (SELECT *, lead(_ingest_timestamp) OVER (PARTITION BY cuenta_id ORDER BY _ingest_timestamp, _change_id) AS nxt
       FROM ch WHERE operacion <> 'TRUNCATE' OR operacion IS NULL)
SELECT cuenta_id, CAST(saldo AS DOUBLE) AS saldo, estado, operacion, _ingest_timestamp AS __START_AT,
  CASE WHEN nxt IS NULL THEN nt WHEN nt IS NULL THEN nxt ELSE least(nxt, nt) END AS __END_AT
FROM (SELECT s.*, (SELECT min(tts) FROM tr WHERE tts > s._ingest_timestamp
                   OR (tts = s._ingest_timestamp AND tid > s._change_id)) AS nt FROM sq s) x
WHERE operacion <> 'D' OR operacion IS NULL"""


ORACLE["cdc_delete"] = f"""SELECT h.* FROM ({scd2_sql()}) h
WHERE EXISTS (SELECT 1 FROM ({CHANGES}) c WHERE c.operacion = 'D' AND c.cuenta_id = h.cuenta_id AND c._ingest_timestamp = h.__END_AT)"""
ORACLE["cdc_truncate"] = f"""SELECT * FROM ({scd2_sql()}) h
WHERE __END_AT IN (SELECT _ingest_timestamp FROM ({CHANGES}) c WHERE operacion = 'TRUNCATE')"""
ORACLE["silver_accounts"] = ORACLE["cdc_scd2"]

CHANGES_B = CHANGES.replace("ts AS _ingest_timestamp, event_id AS _change_id",
                            "ts AS _ingest_timestamp, event_id AS _change_id, 'b' || CAST(event_id // 1000 AS VARCHAR) AS _batch_id")
ORACLE["cdc_except_columns"] = f"""WITH ch AS ({CHANGES_B}),
lt AS (SELECT _ingest_timestamp AS tts, _change_id AS tid FROM ch WHERE operacion = 'TRUNCATE'
       ORDER BY tts DESC, tid DESC LIMIT 1),
live AS (SELECT ch.* FROM ch LEFT JOIN lt ON TRUE
         WHERE (operacion <> 'TRUNCATE' OR operacion IS NULL)
           AND (lt.tts IS NULL OR ch._ingest_timestamp > lt.tts
                OR (ch._ingest_timestamp = lt.tts AND ch._change_id > lt.tid))),
rk AS (SELECT *, row_number() OVER (PARTITION BY cuenta_id ORDER BY _ingest_timestamp DESC, _change_id DESC) AS rn
       FROM live)
SELECT cuenta_id, CAST(saldo AS DOUBLE) AS saldo, estado, operacion, _batch_id FROM rk
WHERE rn = 1 AND (operacion <> 'D' OR operacion IS NULL)"""

ORACLE["bronze_accounts"] = f"""SELECT a.cuenta_id, a.tipo_producto, a.segmento_cliente, a.moneda,
  CAST(a.saldo_inicial AS DOUBLE) AS saldo_inicial,
  TIMESTAMP '2012-01-01 00:00:00' + INTERVAL (a.cuenta_id % 3650) DAY AS fecha_apertura, 'I' AS operacion,
  CAST(year(TIMESTAMP '2012-01-01 00:00:00' + INTERVAL (a.cuenta_id % 3650) DAY) AS INTEGER) AS year_partition,
  TIMESTAMP '{PROCESSED_AT}' AS _ingest_timestamp, 'mainframe_sql_replica' AS _source_system,
  'batch-0001' AS _batch_id
FROM ({ACCOUNTS}) a"""

ORACLE["bronze_transactions"] = f"""SELECT r.*, CAST(year(fecha_transaccion) AS INTEGER) AS year_partition,
  CAST(month(fecha_transaccion) AS INTEGER) AS month_partition,
  TIMESTAMP '{PROCESSED_AT}' AS _ingest_timestamp, 'mainframe_sql_replica' AS _source_system
FROM ({RAW_TXN}) r
WHERE fecha_transaccion > (SELECT coalesce(max(o_orderdate), TIMESTAMP '2020-01-01')
                           FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00')
  AND fecha_transaccion <= TIMESTAMP '2001-06-30 00:00:00'"""

ORACLE["bronze_cards"] = f"""SELECT tarjeta_id, cliente_id, tipo_tarjeta, estado_cod, _ingest_timestamp AS fecha_version, version_id,
  CAST(year(_ingest_timestamp) AS INTEGER) AS year_partition, CAST(month(_ingest_timestamp) AS INTEGER) AS month_partition,
  TIMESTAMP '{PROCESSED_AT}' AS _ingest_timestamp, 'mainframe_sql_replica' AS _source_system, 'batch-0001' AS _batch_id
FROM ({RAW_CARDS}) r"""

ORACLE["session_ids"] = """SELECT event_id AS request_id, event_id % 41 <> 0 AS given, event_id % 41 = 0 AS is_new,
  CASE WHEN event_id % 41 <> 0 THEN 'S' || CAST(user_id AS VARCHAR) END AS session_id FROM events"""

ORACLE["json_roundtrip"] = """SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
  CASE WHEN props IS NULL THEN NULL ELSE '{"k":' || coalesce(CAST(CAST(json_extract(props, '$.k') AS BIGINT) AS VARCHAR), 'null') || '}' END AS json
FROM events"""

ORACLE["called_functions"] = """SELECT event_id AS request_id,
  CAST(CASE WHEN event_type = 'error' THEN 0 ELSE 2 END AS BIGINT) AS n_calls,
  CASE WHEN event_type = 'error' THEN ''
       ELSE coalesce(CASE event_type WHEN 'view' THEN 'get_account_balance' WHEN 'purchase' THEN 'get_card_movements'
                                     WHEN 'click' THEN 'get_credit_cards' END, '')
            || ',' || CASE WHEN event_id % 2 = 0 THEN 'get_loans' ELSE '' END END AS functions_called
FROM events"""


# ---------------------------------------------------------------- sequential rate limit (recursive SQL)

def rate_limit_sql(src: str, limit: int, window: int) -> str:
    """Accepted-only sliding window, replayed per customer by a recursive CTE
    that carries the accepted timestamps (depth = requests per customer)."""
    kept = f"list_filter(r.acc, lambda x: x > e.ts - INTERVAL {window} SECOND)"
    return f"""WITH RECURSIVE ev AS (
  SELECT request_id, customer_id, ts,
         row_number() OVER (PARTITION BY customer_id ORDER BY ts, request_id) AS rn FROM ({src}) s),
r AS (
  SELECT customer_id, rn, request_id, [ts] AS acc, true AS accepted FROM ev WHERE rn = 1
  UNION ALL
  SELECT e.customer_id, e.rn, e.request_id,
    CASE WHEN len({kept}) >= {limit} THEN {kept} ELSE list_append({kept}, e.ts) END,
    len({kept}) < {limit}
  FROM r JOIN ev e ON e.customer_id = r.customer_id AND e.rn = r.rn + 1)
SELECT ev.request_id, ev.customer_id, ev.ts, r.accepted,
  CASE WHEN NOT r.accepted THEN 'RATE_LIMIT_EXCEEDED' END AS error_reason
FROM ev JOIN r ON r.customer_id = ev.customer_id AND r.rn = ev.rn"""


_REQ3 = f"SELECT request_id, customer_id, ts FROM ({REQUESTS}) q"
ORACLE["rate_limit"] = rate_limit_sql(_REQ3, 30, 60)
ORACLE["rate_limit_day2"] = rate_limit_sql(_REQ3, 2, 86400)
ORACLE["rate_limit_stream"] = f"SELECT *, false AS late FROM ({ORACLE['rate_limit_day2']}) b"


def _rlvl(e: str) -> str:
    return f"CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST(floor({e}) AS INTEGER) END"


REQUEST_SEVERITIES = f"""SELECT event_id AS request_id,
  {_rlvl('(event_id * 7 % 11) / 4')} AS hate, {_rlvl('(event_id * 3 % 13) / 5')} AS violence,
  {_rlvl('(event_id % 17) / 8')} AS self_harm, {_rlvl('(event_id * 5 % 19) / 9')} AS sexual
FROM events"""

_CHECKED = f"""SELECT *, CASE WHEN message IS NULL OR length(message) < 1 OR length(message) > 2000 THEN 422
       WHEN NOT coalesce(starts_with("authorization", 'Bearer '), false) THEN 401
       WHEN coalesce(length(customer_id), 0) < 3 THEN 400 ELSE 200 END AS check_status,
  trim(message) AS message_clean
FROM ({REQUESTS}) q"""

_FP = _first_pattern("message_clean", REF_PATTERNS)

ORACLE["chat_audit"] = f"""WITH chk AS ({_CHECKED}),
rl AS ({rate_limit_sql("SELECT request_id, customer_id, ts FROM chk WHERE check_status = 200", 2, 3600)}),
sv AS (SELECT chk.*, rl.accepted, c.sub, c.oid, c.extension_customer_id, c.exp,
         s.hate, s.violence, s.self_harm, s.sexual
       FROM chk LEFT JOIN rl ON rl.request_id = chk.request_id
         LEFT JOIN ({CLAIMS}) c ON c.request_id = chk.request_id
         LEFT JOIN ({REQUEST_SEVERITIES}) s ON s.request_id = chk.request_id),
d AS ({SEV_DECISION.replace('FROM sv', 'FROM sv m')}),
t AS (SELECT *,
  exp IS NULL AND sub IS NULL AND oid IS NULL AND extension_customer_id IS NULL AS no_claims,
  NOT coalesce(accepted, true) AS limited,
  {_FP} AS pattern
  FROM d),
u AS (SELECT *,
  CASE WHEN no_claims THEN 'JWT_VALIDATION_SKIPPED'
       WHEN coalesce(exp <= {EPOCH}, true) THEN 'TOKEN_EXPIRED'
       WHEN NOT coalesce(customer_id IN (coalesce(sub, ''), coalesce(oid, ''), coalesce(extension_customer_id, '')),
                         false) THEN 'CUSTOMER_ID_MISMATCH' END AS token_error
  FROM t),
v AS (SELECT *, NOT limited AND (no_claims OR token_error IS NULL) AS token_valid,
  pattern IS NOT NULL OR severity_blocked AS is_blocked, request_id % 19 = 0 AS llm_error,
  request_id % 8 <> 0 AND (floor((request_id % 23) / 11) >= 2 OR floor((request_id % 29) / 14) >= 2) AS output_blocked FROM u)
SELECT request_id, customer_id, ts, check_status,
  CASE WHEN check_status = 200 THEN CASE WHEN limited THEN 'RATE_LIMIT_EXCEEDED' ELSE token_error END END
    AS security_error,
  CASE WHEN check_status = 200 THEN CASE WHEN NOT token_valid THEN 'unauthorized'
       WHEN is_blocked THEN 'content_blocked' WHEN llm_error THEN 'llm_error' WHEN output_blocked THEN 'output_blocked' ELSE 'ok' END END AS outcome,
  CASE WHEN check_status = 200 THEN CASE WHEN pattern IS NOT NULL
       THEN 'Patrón bancario sensible detectado: ''' || pattern || '''' ELSE severity_reason END END AS guard_reason,
  CASE WHEN check_status <> 200 THEN check_status WHEN NOT token_valid THEN 401 WHEN is_blocked THEN 422
       ELSE 200 END AS http_status
FROM v"""



# ---------------------------------------------------------------- other forms of the same rows

ORACLE["join_left_balances_bucketed"] = ORACLE["join_left_balances"]
ORACLE["dq_observed"] = ORACLE["dq_report"]
ORACLE["change_feed_digests"] = ORACLE["change_feed"]
ORACLE["session_window"] = f"""SELECT user_id, started_at, last_activity, n_events, expires_at
FROM ({session_ttl_sql(1800).replace("event_type = 'error'", "false")}) s"""
