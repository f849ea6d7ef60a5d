"""Silver cleanup: casts, code labels, PAN masking, latest-version dedup.

P1-P6 are single-stage projections (no shuffle). W1 keeps the newest record
per key with ``max_by`` over a struct instead of a ``row_number`` window: the
aggregate runs partially on the map side, so a key holding a third of all
rows is reduced to one row per map task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakebank.functions.expr import code_map, code_set_map, mask_pan


def silver_casts(df: DataFrame, amount: str = "monto", ts: str = "fecha_transaccion") -> DataFrame:
    """Money to decimal(18,2) and date to timestamp.

    ``try_cast``: bad text becomes null (and is then caught by the quality
    rules) instead of failing the job under ANSI mode. Timestamps stay
    wall-clock (``timestamp_ntz``), as the source database stores them.
    """
    return df.withColumns({
        amount: F.col(amount).try_cast("decimal(18,2)"),
        ts: F.col(ts).try_cast("timestamp_ntz"),
    })


def label_codes(df: DataFrame, code: str = "tipo_tx_cod", out: str = "tipo_transaccion_desc") -> DataFrame:
    """Legacy transaction code -> label."""
    return df.withColumn(out, code_map(code))


def mask_card_number(df: DataFrame, pan: str = "numero_tarjeta",
                     out: str = "numero_tarjeta_masked") -> DataFrame:
    """Mask the PAN and drop the raw number so it never persists."""
    return df.withColumn(out, mask_pan(pan)).drop(pan)


def stamp_processing(df: DataFrame, processed_at: str, col: str = "_silver_timestamp") -> DataFrame:
    """Processing time as an argument (P6); pass ``None`` for current_timestamp()."""
    v = F.current_timestamp() if processed_at is None else F.lit(processed_at).cast("timestamp_ntz")
    return df.withColumn(col, v)


def dedup_latest(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Newest row per key.

    ``order_by`` columns are compared left to right, the last one being the
    required tie-breaker. Implemented as ``max_by(struct(row), struct(order))``
    so it pre-aggregates map-side (skew-safe) and needs one shuffle.
    """
    cols = [c for c in df.columns if c not in keys]
    latest = F.max_by(F.struct(*cols), F.struct(*order_by)).alias("__r")
    return df.groupBy(*keys).agg(latest).select(*keys, *[F.col(f"__r.{c}").alias(c) for c in cols])


def card_state(df: DataFrame, code: str = "estado_cod", out: str = "estado_tarjeta") -> DataFrame:
    """Card state code -> label."""
    return df.withColumn(out, code_set_map(code))
