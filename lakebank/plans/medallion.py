"""Bronze -> silver -> gold compositions (X1-X7) over the fixture tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakebank.operators import cdc, clean, kpi
from lakebank.operators.quality import (apply_expectations, expect, expect_or_drop,
                                        expect_or_fail)
from lakebank.sources import fixtures, ingest

# Quality rules of the silver tables (fixed values from the reference).
SILVER_TXN_RULES = [
    expect_or_drop("monto_valido", "monto IS NOT NULL AND monto != 0"),
    expect_or_drop("cuenta_existe", "cuenta_id IS NOT NULL"),
    expect("moneda_valida", "moneda IN ('PEN', 'USD', 'EUR')"),
]
SILVER_CARD_RULES = [expect_or_fail("tarjeta_id_not_null", "tarjeta_id IS NOT NULL")]
CDC_EXCEPT_COLUMNS = ["_ingest_timestamp", "_batch_id", "_source_system"]

PROCESSED_AT = "2001-08-02 00:00:00"


def bronze_transactions(spark: SparkSession, sf_dir: str, ingested_at: str = PROCESSED_AT) -> DataFrame:
    """Raw transactions with year/month partitions and ingest metadata (X2 without the cursor)."""
    raw = fixtures.raw_transactions(spark, sf_dir)
    return ingest.ingest_metadata(ingest.derive_partitions(raw, "fecha_transaccion"), ingested_at)


def silver_transactions_unchecked(raw: DataFrame, processed_at: str | None = PROCESSED_AT) -> DataFrame:
    """P1 + P2 + P4 + P6 before the quality rules."""
    df = clean.silver_casts(raw)
    df = clean.label_codes(df)
    df = clean.mask_card_number(df)
    return clean.stamp_processing(df, processed_at)


def silver_transactions(raw: DataFrame, processed_at: str | None = PROCESSED_AT) -> DataFrame:
    """Cleaned transactions with drop/warn rules applied."""
    return apply_expectations(silver_transactions_unchecked(raw, processed_at), SILVER_TXN_RULES)


def silver_cards(raw_cards: DataFrame) -> DataFrame:
    """Newest version per card, state label, fail rule on null ids."""
    checked = apply_expectations(raw_cards, SILVER_CARD_RULES)
    latest = clean.dedup_latest(checked, ["tarjeta_id"], ["_ingest_timestamp", "version_id"])
    return clean.card_state(latest)


def silver_accounts(changes: DataFrame) -> DataFrame:
    """SCD-2 history of the account change feed."""
    return cdc.apply_changes(changes, keys=["cuenta_id"], sequence_by=["_ingest_timestamp", "_change_id"],
                             op_col="operacion", except_columns=CDC_EXCEPT_COLUMNS + ["_change_id"],
                             scd_type=2)


def silver_txns_for(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_transactions(fixtures.raw_transactions(spark, sf_dir))


def account_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SCD-2 history of the account master; gold reads its current rows."""
    return cdc.apply_changes(fixtures.account_history_changes(spark, sf_dir), keys=["cuenta_id"],
                             sequence_by=["_ingest_timestamp", "_change_id"], except_columns=["operacion"])


def gold_daily_balances(spark: SparkSession, sf_dir: str, as_of: str = fixtures.AS_OF) -> DataFrame:
    """X6 over the fixtures (SCD-2 accounts, current rows + silver transactions)."""
    return kpi.gold_daily_balances(account_history(spark, sf_dir), silver_txns_for(spark, sf_dir), as_of)


def gold_card_usage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X7 over the fixtures."""
    return kpi.gold_card_usage(silver_txns_for(spark, sf_dir), silver_cards(fixtures.raw_cards(spark, sf_dir)))


def cast_money(df: DataFrame) -> DataFrame:
    """Decimal columns to double for comparison outputs (exact decimals first, one rounding)."""
    return df.select(*[F.col(f.name).cast("double").alias(f.name)
                       if f.dataType.typeName() == "decimal" else F.col(f.name)
                       for f in df.schema.fields])
