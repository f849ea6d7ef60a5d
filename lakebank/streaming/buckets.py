"""Keyed state by bucket of customers, for stateful operators with a small state per customer.

A call of Python, a slice of Arrow and a state row per customer cost far more than
the customer's few rows. Customers are dealt into ``BUCKETS`` groups by hash: a
group holds all rows of its customers and one state row with an array per field.
Raise the number with the customers (some hundred per bucket): a micro-batch
rewrites the state of the buckets it touches. It stays fixed for a checkpoint.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 1024


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).alias("__bucket")


def text_of(column: str, kind: T.DataType) -> Column:
    """The column as text, exact: pandas would turn whole numbers beside a null into floats."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("string")
    return F.base64(column) if isinstance(kind, T.BinaryType) else F.col(column).cast("string")


def from_text(text: str | Column, kind: T.DataType) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(c.cast("long"))
    return F.unbase64(c) if isinstance(kind, T.BinaryType) else c.cast(kind)


def order_of(id_col: str, kind: T.DataType) -> Column:
    """What ties in time are sorted by; null ids come last."""
    return F.coalesce(F.col(id_col).cast("long"), F.lit(2**63 - 1)) if isinstance(kind, T.IntegralType) else F.col(id_col)


def by_customer(pdfs: Iterator[pd.DataFrame]) -> tuple[pd.DataFrame, list[tuple[str | None, int, int]]]:
    """Rows of one bucket and micro-batch, sorted by customer, time and id, and (key, begin, end) of each customer."""
    rows = pd.concat(list(pdfs), ignore_index=True)
    code, keys = pd.factorize(rows["__key"], use_na_sentinel=False)
    rows = rows.assign(__code=code).sort_values(["__code", "__us", "__id"], kind="stable")
    ends = rows["__code"].value_counts(sort=False).sort_index().cumsum().tolist()
    return rows, [(None if pd.isna(k) else k, a, b) for k, a, b in zip(keys.tolist(), [0, *ends], ends)]
