"""Joins of the cleaned sources and the payment aggregate they need."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buyerlens.functions.scalars import money, money_sum


def restrict_children(children: DataFrame, orders: DataFrame) -> DataFrame:
    """Child rows of surviving orders."""
    return children.join(orders.select("order_id"), "order_id", "left_semi")


def payment_per_order(payments: DataFrame, rows: str | None = None) -> DataFrame:
    """Total, mean installments, number of types and most frequent type per order.

    Counting per (order, type) first makes the distinct count and the mode plain
    aggregates. Ties of the mode go to the smallest text. ``rows`` names a further
    column for the number of payments."""
    by_type = (
        payments.where(F.col("order_id").isNotNull())
        .groupBy("order_id", "payment_type")
        .agg(
            money_sum(F.col("payment_value")).alias("units"),
            F.sum("payment_installments").alias("installments"),
            F.count("payment_installments").alias("n_installments"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    typed = F.col("payment_type").isNotNull()
    return by_type.groupBy("order_id").agg(
        money(F.sum("units")).alias("payment_value_total"),
        F.try_divide(F.sum("installments"), F.sum("n_installments")).alias("payment_installments_avg"),
        F.count("payment_type").alias("payment_types_nunique"),
        F.min_by("payment_type", F.when(typed, F.struct(-F.col("n"), F.col("payment_type")))).alias(
            "payment_type_mode"
        ),
        *([F.sum("n").alias(rows)] if rows else []),
    )


def join_sources(orders: DataFrame, customers: DataFrame, items: DataFrame, payments: DataFrame) -> DataFrame:
    """Enriched items: item, order, customer and payment aggregate on one row."""
    dimension = customers.select("customer_id", "customer_unique_id", "customer_state")
    return (
        items.join(orders, "order_id", "inner")
        .join(payment_per_order(payments), "order_id", "left")
        .join(dimension, "customer_id", "inner")
    )
