"""Scalar column expressions (all built-in, JVM-side, codegen-friendly).

No Python UDF lives here: every helper returns a ``Column`` composed of
``pyspark.sql.functions`` so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results depend on.
# Transaction code -> label (P2), card state code sets -> label.
TX_CODE_LABELS = {
    "CR": "CREDITO",
    "DB": "DEBITO",
    "TF": "TRANSFERENCIA",
    "PG": "PAGO_SERVICIO",
}
TX_CODE_DEFAULT = "OTROS"
CARD_STATE_LABELS = {
    "ACTIVA": ["A", "01"],
    "BLOQUEADA": ["B", "02"],
    "CANCELADA": ["C", "03"],
}
CARD_STATE_DEFAULT = "DESCONOCIDO"
PAN_MASK_PREFIX = "****-****-****-"
PAN_MASK_FULL = "****-****-****-****"
ACCOUNT_MASK_PREFIX = "****"
CARD_DISPLAY_MASK_PREFIX = "**** **** **** "
SHORT_MASK = "****"

_EPOCH_NTZ = "1970-01-01 00:00:00"


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(ts: str | Column) -> Column:
    """Whole seconds since 1970 of a wall-clock timestamp, independent of the session zone."""
    return F.timestamp_diff("SECOND", F.lit(_EPOCH_NTZ).cast("timestamp_ntz"),
                            col_(ts).cast("timestamp_ntz"))


def code_map(c: str | Column, mapping: Mapping[str, str] = TX_CODE_LABELS,
             default: str = TX_CODE_DEFAULT) -> Column:
    """Equality code -> label chain; null and unknown codes take ``default``."""
    c = col_(c)
    expr = None
    for code, label in mapping.items():
        expr = (F.when(c == code, label) if expr is None else expr.when(c == code, label))
    return expr.otherwise(default)


def code_set_map(c: str | Column, mapping: Mapping[str, Sequence[str]] = CARD_STATE_LABELS,
                 default: str = CARD_STATE_DEFAULT) -> Column:
    """Code-set membership -> label chain, first matching set wins."""
    c = col_(c)
    expr = None
    for label, codes in mapping.items():
        cond = c.isin(*codes)
        expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr.otherwise(default)


def mask_pan(c: str | Column) -> Column:
    """PCI mask keeping the last four digits.

    Null stays null; a value shorter than four characters is masked fully (the
    plain ``substring(-4, 4)`` would reveal it whole).
    """
    c = col_(c)
    return (F.when(c.isNull(), F.lit(None).cast("string"))
            .when(F.length(c) < 4, F.lit(PAN_MASK_FULL))
            .otherwise(F.concat(F.lit(PAN_MASK_PREFIX), F.right(c, F.lit(4)))))


def mask_last4(c: str | Column, prefix: str = ACCOUNT_MASK_PREFIX) -> Column:
    """``prefix`` + last four when length >= 4, else ``****``; null counts as empty (P5)."""
    c = F.coalesce(col_(c), F.lit(""))
    return F.when(F.length(c) >= 4, F.concat(F.lit(prefix), F.right(c, F.lit(4)))).otherwise(
        F.lit(SHORT_MASK))


def mask_account(c: str | Column) -> Column:
    return mask_last4(c, ACCOUNT_MASK_PREFIX)


def mask_card(c: str | Column) -> Column:
    return mask_last4(c, CARD_DISPLAY_MASK_PREFIX)


def money(c: str | Column) -> Column:
    """Thousands-separated, two decimals (Python ``,.2f``)."""
    return F.format_number(col_(c), 2)


def utilization_pct(used: str | Column, limit: str | Column) -> Column:
    """``used / limit * 100`` when limit > 0, else 0, as double."""
    used, limit = col_(used).cast("double"), col_(limit).cast("double")
    return F.when(F.coalesce(limit, F.lit(0.0)) > 0, used / limit * 100.0).otherwise(F.lit(0.0))


def first_match(text: str | Column, patterns: Sequence[str]) -> Column:
    """First pattern (list order) contained in lower(text), or null.

    A ``CASE WHEN contains(..)`` chain: same first-hit rule as a loop over the
    list, but compiled into the stage's generated code (no per-row lambda)."""
    low = F.lower(col_(text))
    expr = None
    for p in patterns:
        lit = F.lit(p.lower())
        expr = F.when(F.contains(low, lit), lit) if expr is None else expr.when(F.contains(low, lit), lit)
    return expr if expr is not None else F.lit(None).cast("string")


def scopes(scp: str | Column, default: str = "banking.read") -> Column:
    """Scope list from the space-separated ``scp`` claim; null -> ``default``."""
    return F.split(F.coalesce(col_(scp), F.lit(default)), " ")


def epoch_micros(ts: str | Column) -> Column:
    """Microseconds since 1970 of a wall-clock timestamp, independent of the session zone."""
    return F.timestamp_diff("MICROSECOND", F.lit(_EPOCH_NTZ).cast("timestamp_ntz"), col_(ts).cast("timestamp_ntz"))


def ntz_to_instant(ts: str | Column) -> Column:
    """Wall-clock timestamp -> TIMESTAMP instant read as UTC (what watermarks need)."""
    return F.timestamp_micros(epoch_micros(ts))


def instant_to_ntz(ts: str | Column) -> Column:
    """Inverse of ``ntz_to_instant``."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(col_(ts)), F.lit(_EPOCH_NTZ).cast("timestamp_ntz"))
