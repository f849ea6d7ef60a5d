"""Customer product views (V1-V7) and per-customer statement text.

The reference answers one customer per call through an HTTP API. Here each
view runs over all customers at once (filter by ``customer_id`` for one):
projections with defaults and masks, a per-(customer, currency) top-N for the
movement list, and a statement text assembled from a bounded list per group.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakebank.functions.expr import mask_account, mask_card, money, utilization_pct

# Reply texts and defaults as the reference writes them.
BALANCE_HEADING = "Saldos de cuentas en {currency}:"
BALANCE_EMPTY = "No se encontraron cuentas en {currency} para el cliente."
MOVEMENTS_EMPTY = "No hay movimientos recientes en tu cuenta {currency}."
NO_DESCRIPTION = "Sin descripción"
NA = "N/A"
DEFAULT_CARD_TYPE = "VISA"
DEFAULT_CARD_STATUS = "ACTIVA"
DEFAULT_CURRENCY = "PEN"
DEFAULT_MERCHANT = "Comercio"
DEFAULT_INSTALLMENTS = 1
DEFAULT_LOAN_TYPE = "Personal"
DEFAULT_REASON = "No disponible"
CARDS_HEADING = "Tus tarjetas de crédito digitales:"
CARDS_EMPTY = "No tienes tarjetas de crédito digitales activas."
CARD_ITEM = """
📱 Tarjeta: {masked} ({card_type})
   Estado: {status}
   Límite: {credit_limit} {currency}
   Usado: {used_balance} ({utilization}%)
   Disponible: {available_balance}
   Fecha de corte: {cut_date}
   Pago mínimo: {minimum_payment}
   Pago total: {total_payment}"""
CARD_MOVEMENTS_HEADING = "Últimos movimientos de tarjeta ({days} días):"
CARD_MOVEMENTS_EMPTY = "No hay movimientos en tus tarjetas en los últimos {days} días."
CARD_MOVEMENT_ITEM = "• {date} | {merchant} | {amount} {currency} | {installments} cuota(s)"
LOANS_HEADING = "Tus préstamos digitales activos:"
LOANS_EMPTY = "No tienes préstamos digitales activos."
LOAN_ITEM = """
💰 Préstamo #{loan_ref}...
   Tipo: {loan_type}
   Saldo pendiente: {outstanding_balance} {currency}
   Cuota mensual: {monthly_payment}
   Tasa TEA: {annual_rate}%
   Cuotas restantes: {remaining_installments}
   Próximo vencimiento: {next_due_date}"""
OFFER_TEXT = """¡Tienes una oferta pre-aprobada!
   Monto máximo: {max_amount} {currency}
   Tasa desde: {min_rate}% TEA
   Plazo máximo: {max_term_months} meses
   ¿Deseas solicitar el préstamo ahora? Puedo guiarte en el proceso."""
NO_OFFER_TEXT = ("En este momento no calificas para un nuevo préstamo digital. Motivo: {reason}. "
                 "Si tienes dudas, puedes contactar a un asesor.")
TRANSFER_TEXT = """Tus límites de transferencia:
   Diario usado: {daily_used} / {daily_limit} PEN
   Mensual usado: {monthly_used} / {monthly_limit} PEN
   Disponible hoy: {daily_available} PEN"""
MAX_MOVEMENTS = 10
MAX_CARD_DAYS = 90
LOAN_ID_CHARS = 8


def fill(template: str, **given: Column) -> Column:
    """A fixed text with its ``{names}`` replaced by ``given`` columns or those of that name."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[F.lit(x) if i % 2 == 0 else given.get(x, F.col(x)).cast("string") for i, x in enumerate(parts)])


def account_balance_lines(accounts: DataFrame, currency: str = DEFAULT_CURRENCY) -> DataFrame:
    """V1: accounts of each customer in ``currency`` with masked number and balances."""
    a = accounts.filter(F.col("currency") == currency)
    line = F.format_string("- Cuenta %s: Disponible: %s %s | Total: %s %s",
                           mask_account("account_number"),
                           money(F.coalesce("available_balance", F.lit(0))), F.lit(currency),
                           money(F.coalesce("total_balance", F.lit(0))), F.lit(currency))
    return a.select("customer_id", "currency", "account_number",
                    mask_account("account_number").alias("masked"), line.alias("line"))


def top_movements(movements: DataFrame, currency: str = DEFAULT_CURRENCY, limit: int = 5) -> DataFrame:
    """Newest ``min(limit, 10)`` movements per customer in ``currency``.

    ``row_number() <= n`` is planned as a WindowGroupLimit that also runs
    before the shuffle, so a hot customer ships at most n rows per map task.
    """
    n = min(limit, MAX_MOVEMENTS)
    w = Window.partitionBy("customer_id", "currency").orderBy(F.desc("date"), F.desc("movement_id"))
    top = (movements.filter(F.col("currency") == currency)
           .withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= n)
           .withColumn("pos", F.col("__rn").cast("long")).drop("__rn"))
    sign = F.when(F.col("type") == "credit", F.lit("+")).otherwise(F.lit("-"))
    line = F.format_string("• %s | %s | %s%s %s",
                           F.coalesce(F.col("date").cast("string"), F.lit(NA)),
                           F.coalesce("description", F.lit(NO_DESCRIPTION)),
                           sign, money(F.abs(F.coalesce("amount", F.lit(0)))), F.lit(currency))
    return top.select("customer_id", "currency", "pos", "movement_id", "date", "type", "amount",
                      line.alias("line"))


def statement_text(customers: DataFrame, lines: DataFrame, heading: Column, empty: str,
                   key: str = "customer_id", order: str = "pos") -> DataFrame:
    """One text per customer -- heading + lines in order, or ``empty``.

    The line list per customer is already bounded (top-N or the customer's
    accounts), so ``collect_list`` never gathers an unbounded group. The outer
    join from the customer list keeps customers with no lines.
    """
    g = (lines.groupBy(key)
         .agg(F.sort_array(F.collect_list(F.struct(F.col(order).alias("o"), F.col("line").alias("l"))))
              .alias("items"), F.count(F.lit(1)).alias("n_items")))
    j = customers.select(key).distinct().join(g, key, "left")
    body = F.concat_ws("\n", heading, F.concat_ws("\n", F.transform("items", lambda x: x["l"])))
    return j.select(key, F.coalesce("n_items", F.lit(0)).alias("n_items"),
                    F.when(F.col("items").isNull(), F.lit(empty)).otherwise(body).alias("text"))


def account_balance_text(accounts: DataFrame, customers: DataFrame, currency: str = DEFAULT_CURRENCY) -> DataFrame:
    lines = account_balance_lines(accounts, currency).withColumn("pos", F.col("account_number"))
    return statement_text(customers, lines, F.lit(BALANCE_HEADING.format(currency=currency)),
                          BALANCE_EMPTY.format(currency=currency))


def movements_text(movements: DataFrame, customers: DataFrame, currency: str = DEFAULT_CURRENCY,
                   limit: int = 5) -> DataFrame:
    top = top_movements(movements, currency, limit)
    heading = F.format_string("Últimos %d movimientos en %s:", F.col("n_items"), F.lit(currency))
    return statement_text(customers, top, heading, MOVEMENTS_EMPTY.format(currency=currency))


def credit_cards_view(cards: DataFrame) -> DataFrame:
    """V3: per card mask, defaults, utilisation %, formatted amounts."""
    util = utilization_pct(F.coalesce("used_balance", F.lit(0)), F.coalesce("credit_limit", F.lit(0)))
    return cards.select(
        "customer_id", "card_id",
        mask_card("card_number").alias("masked"),
        F.coalesce("card_type", F.lit(DEFAULT_CARD_TYPE)).alias("card_type"),
        F.coalesce("status", F.lit(DEFAULT_CARD_STATUS)).alias("status"),
        F.coalesce("currency", F.lit(DEFAULT_CURRENCY)).alias("currency"),
        money(F.coalesce("credit_limit", F.lit(0))).alias("credit_limit"),
        money(F.coalesce("used_balance", F.lit(0))).alias("used_balance"),
        util.alias("utilization_pct"),
        F.format_number(util, 1).alias("utilization"),
        money(F.coalesce("available_balance", F.lit(0))).alias("available_balance"),
        F.coalesce(F.col("cut_date").cast("string"), F.lit(NA)).alias("cut_date"),
        money(F.coalesce("minimum_payment", F.lit(0))).alias("minimum_payment"),
        money(F.coalesce("total_payment", F.lit(0))).alias("total_payment"))


def card_movements_view(card_movements: DataFrame, as_of: str, last_n_days: int = 30) -> DataFrame:
    """V4: purchases of the last ``min(n, 90)`` days up to ``as_of`` (pushed-down date range)."""
    n = min(last_n_days, MAX_CARD_DAYS)
    day = F.lit(as_of).cast("date")
    m = card_movements.filter((F.col("date") >= F.date_sub(day, n)) & (F.col("date") <= day))
    return m.select(
        "customer_id", "movement_id", F.coalesce(F.col("date").cast("string"), F.lit(NA)).alias("date"),
        F.coalesce("merchant", F.lit(DEFAULT_MERCHANT)).alias("merchant"),
        money(F.coalesce("amount", F.lit(0))).alias("amount"),
        F.coalesce("currency", F.lit(DEFAULT_CURRENCY)).alias("currency"),
        F.coalesce("installments", F.lit(DEFAULT_INSTALLMENTS)).alias("installments"),
        F.lit(n).alias("days"))


def loans_view(loans: DataFrame) -> DataFrame:
    """V5: loan id cut to 8 characters, defaults and formatted figures."""
    return loans.select(
        "customer_id",
        F.left(F.coalesce("loan_id", F.lit(NA)), F.lit(LOAN_ID_CHARS)).alias("loan_ref"),
        F.coalesce("loan_type", F.lit(DEFAULT_LOAN_TYPE)).alias("loan_type"),
        money(F.coalesce("outstanding_balance", F.lit(0))).alias("outstanding_balance"),
        F.coalesce("currency", F.lit(DEFAULT_CURRENCY)).alias("currency"),
        money(F.coalesce("monthly_payment", F.lit(0))).alias("monthly_payment"),
        F.format_number(F.coalesce("annual_rate", F.lit(0.0)), 2).alias("annual_rate"),
        F.coalesce("remaining_installments", F.lit(0)).alias("remaining_installments"),
        F.coalesce(F.col("next_due_date").cast("string"), F.lit(NA)).alias("next_due_date"))


def loan_eligibility_view(elig: DataFrame) -> DataFrame:
    """V6: offer fields when eligible, else the reason (default 'No disponible')."""
    ok = F.coalesce("eligible", F.lit(False))
    return elig.select(
        "customer_id", ok.alias("eligible"),
        F.when(ok, money(F.coalesce("max_amount", F.lit(0)))).alias("max_amount"),
        F.when(ok, F.coalesce("currency", F.lit(DEFAULT_CURRENCY))).alias("currency"),
        F.when(ok, F.format_number(F.coalesce("min_rate", F.lit(0.0)), 2)).alias("min_rate"),
        F.when(ok, F.coalesce("max_term_months", F.lit(0))).alias("max_term_months"),
        F.when(~ok, F.coalesce("reason", F.lit(DEFAULT_REASON))).alias("reason"))


DAILY_TRANSFER_LIMIT = 20000
MONTHLY_TRANSFER_LIMIT = 200000


def transfer_limits(silver_txns: DataFrame, daily_limit: float = DAILY_TRANSFER_LIMIT,
                    monthly_limit: float = MONTHLY_TRANSFER_LIMIT) -> DataFrame:
    """V7: transfer use per customer and day against the limits.

    ``daily_used`` is the day's transfer total; ``monthly_used`` the
    month-to-date total (a running sum over the few days of one customer-month,
    after a partial aggregation per day).
    """
    day = (silver_txns.filter(F.col("tipo_transaccion_desc") == "TRANSFERENCIA")
           .groupBy(F.col("cuenta_id").alias("customer_id"), F.to_date("fecha_transaccion").alias("day"))
           .agg(F.sum("monto").alias("daily_used")))
    w = (Window.partitionBy("customer_id", F.trunc("day", "month")).orderBy("day")
         .rowsBetween(Window.unboundedPreceding, 0))
    dl = F.lit(daily_limit).cast("decimal(18,2)")
    ml = F.lit(monthly_limit).cast("decimal(18,2)")
    return day.select("customer_id", "day", "daily_used", dl.alias("daily_limit"),
                      F.sum("daily_used").over(w).alias("monthly_used"), ml.alias("monthly_limit"),
                      F.greatest(dl - F.col("daily_used"), F.lit(0)).alias("daily_available"))


def credit_cards_text(cards: DataFrame, customers: DataFrame) -> DataFrame:
    """G6 over V3: one text per customer of the list."""
    lines = credit_cards_view(cards).select("customer_id", F.col("card_id").alias("pos"), fill(CARD_ITEM).alias("line"))
    return statement_text(customers, lines, F.lit(CARDS_HEADING), CARDS_EMPTY)


def card_movements_text(card_movements: DataFrame, customers: DataFrame, as_of: str, last_n_days: int = 30) -> DataFrame:
    """G6 over V4: newest purchases first."""
    n = str(min(last_n_days, MAX_CARD_DAYS))
    order = F.struct((-F.unix_date("when")).alias("d"), F.col("movement_id"))
    seen = card_movements_view(card_movements, as_of, last_n_days).withColumn("when", F.to_date("date"))
    lines = seen.select("customer_id", order.alias("pos"), fill(CARD_MOVEMENT_ITEM).alias("line"))
    return statement_text(customers, lines, F.lit(CARD_MOVEMENTS_HEADING.format(days=n)), CARD_MOVEMENTS_EMPTY.format(days=n))


def loans_text(loans: DataFrame, customers: DataFrame) -> DataFrame:
    """G6 over V5, in order of the loan id."""
    lines = loans_view(loans).withColumn("line", fill(LOAN_ITEM))
    keyed = lines.withColumn("pos", F.struct("loan_ref", "next_due_date", "line"))
    return statement_text(customers, keyed, F.lit(LOANS_HEADING), LOANS_EMPTY)


def loan_eligibility_text(elig: DataFrame, customers: DataFrame) -> DataFrame:
    """G6 over V6: the offer, or why there is none; a customer without an answer is not eligible."""
    j = customers.select("customer_id").distinct().join(loan_eligibility_view(elig), "customer_id", "left")
    no = fill(NO_OFFER_TEXT, reason=F.coalesce("reason", F.lit(DEFAULT_REASON)))
    return j.select("customer_id", F.when(F.col("eligible"), fill(OFFER_TEXT)).otherwise(no).alias("text"))


def transfer_limits_text(silver_txns: DataFrame, customers: DataFrame, as_of: str,
                         daily_limit: float = DAILY_TRANSFER_LIMIT, monthly_limit: float = MONTHLY_TRANSFER_LIMIT) -> DataFrame:
    """G6 over V7: every customer of the list, with nothing used where no transfer is on record for the day or month."""
    day = F.lit(as_of).cast("date")
    on = F.to_date("fecha_transaccion")
    used = (silver_txns.filter((F.col("tipo_transaccion_desc") == "TRANSFERENCIA") & (on >= F.trunc(day, "month")) & (on <= day))
            .groupBy(F.col("cuenta_id").alias("customer_id"))
            .agg(F.sum(F.when(on == day, F.col("monto"))).alias("d"), F.sum("monto").alias("m")))
    j = customers.select("customer_id").distinct().join(used, "customer_id", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0).cast("decimal(18,2)"))
    limit = lambda x: F.lit(x).cast("decimal(18,2)")
    return j.select("customer_id", fill(
        TRANSFER_TEXT, daily_used=money(zero("d")), daily_limit=money(limit(daily_limit)), monthly_used=money(zero("m")),
        monthly_limit=money(limit(monthly_limit)),
        daily_available=money(F.greatest(limit(daily_limit) - zero("d"), F.lit(0)))).alias("text"))
