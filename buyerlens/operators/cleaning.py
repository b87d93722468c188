"""Cleaning operators: parsing, keep-first deduplication, null and range filters."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from buyerlens.contracts import ORDERS
from buyerlens.functions.scalars import as_date

TIMESTAMP_COLUMNS = [f.name for f in ORDERS.fields if f.type == "timestamp"]


def parse_timestamps(orders: DataFrame) -> DataFrame:
    """Cast the order timestamps that are present; unreadable text becomes null."""
    parsed = {
        name: F.col(name).try_cast("timestamp")
        for name in TIMESTAMP_COLUMNS if name in orders.columns
    }
    return orders.withColumns(parsed)


def keep_first(df: DataFrame, keys: list[str], order_by: list[Column] | None = None) -> DataFrame:
    """One row per key: the first in ``order_by``, then in all other columns.

    The ``= 1`` filter on the row number lets Spark keep one row per key and task
    before the shuffle, so a key with very many copies costs one row per task."""
    rest = [F.col(c).asc_nulls_first() for c in df.columns if c not in keys]
    window = Window.partitionBy(*keys).orderBy(*(order_by or []), *rest)
    if not rest and not order_by:
        return df.dropDuplicates(keys)
    return df.withColumn("_row", F.row_number().over(window)).where("_row = 1").drop("_row")


# columns of the month that a row was delivered in; the first of several copies is that of the earliest
MONTH = ("year", "month")


def delivered_months(df: DataFrame) -> list[str]:
    return list(MONTH) if all(c in df.columns for c in MONTH) else []


def _dedup(df: DataFrame, keys: list[str], required: list[str]) -> DataFrame:
    # rows without a key are dropped in any case; dropping them first keeps a
    # large null group out of the shuffle
    months = delivered_months(df)
    first = keep_first(df.dropna(subset=keys), keys, [F.col(c).asc_nulls_first() for c in months])
    return first.drop(*months).dropna(subset=required)


def clean_orders(orders: DataFrame) -> DataFrame:
    return _dedup(parse_timestamps(orders), ["order_id"], ["customer_id", "order_purchase_timestamp"])


def clean_order_items(items: DataFrame) -> DataFrame:
    return with_price(_dedup(items, ["order_id", "order_item_id"], ["price"]))


def with_price(items: DataFrame) -> DataFrame:
    """Items with a price, and a freight if they have the column, of at least zero."""
    cleaned = items.where("price >= 0")
    # a null freight fails the comparison and is dropped as well; NaN would pass it
    return cleaned.where("freight_value >= 0 AND NOT isnan(freight_value)") if "freight_value" in items.columns else cleaned


def clean_order_payments(payments: DataFrame) -> DataFrame:
    cleaned = _dedup(payments, ["order_id", "payment_sequential"], ["payment_value"])
    return cleaned.where("payment_value >= 0")


def clean_customers(customers: DataFrame) -> DataFrame:
    return _dedup(customers, ["customer_id"], ["customer_unique_id"])


def observation_window(
    orders: DataFrame,
    as_of: str | date,
    window_days: int = 365,
    statuses: tuple[str, ...] = ("delivered",),
) -> DataFrame:
    """Orders of the given statuses in the window that ends at 23:59:59 of ``as_of``."""
    end = F.lit(f"{as_date(as_of).isoformat()} 23:59:59").cast("timestamp")
    start = end - F.expr(f"INTERVAL '{int(window_days)}' DAY")
    ts = F.col("order_purchase_timestamp")
    return orders.where((ts >= start) & (ts <= end) & F.col("order_status").isin(list(statuses)))
