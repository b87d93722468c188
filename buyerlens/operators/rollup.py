"""Two-level aggregation: items to orders, orders to customers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buyerlens.functions import scalars as S
from buyerlens.operators.joins import payment_per_order


def order_rollup(enriched: DataFrame) -> DataFrame:
    """One row per (customer, order) from enriched items.

    Payment columns and state are equal on all rows of an order, so ``max`` is
    their first non-null value."""
    keyed = enriched.where("customer_unique_id IS NOT NULL AND order_id IS NOT NULL")
    return keyed.groupBy("customer_unique_id", "order_id").agg(
        F.min("order_purchase_timestamp").alias("order_purchase_timestamp"),
        S.money_sum(F.col("price")).alias("item_units"),
        F.count("order_item_id").alias("items_count"),
        S.money_sum(F.col("freight_value")).alias("freight_units"),
        F.max("payment_value_total").alias("payment_value_total"),
        F.max("payment_installments_avg").alias("payment_installments_avg"),
        F.max("payment_type_mode").alias("payment_type_mode"),
        F.max("customer_state").alias("customer_state"),
    )


def order_rollup_from_sources(
    orders: DataFrame, customers: DataFrame, items: DataFrame, payments: DataFrame
) -> DataFrame:
    """The same rows as :func:`order_rollup` over the join, without building the
    item-level join: items are summed per order before they meet the orders."""
    per_order = items.where("order_id IS NOT NULL").groupBy("order_id").agg(
        S.money_sum(F.col("price")).alias("item_units"),
        F.count("order_item_id").alias("items_count"),
        S.money_sum(F.col("freight_value")).alias("freight_units"),
    )
    return (
        orders.select("order_id", "customer_id", "order_purchase_timestamp")
        .join(per_order, "order_id")
        .join(payment_per_order(payments).drop("payment_types_nunique"), "order_id", "left")
        .join(customers.select("customer_id", "customer_unique_id", "customer_state"), "customer_id")
        .drop("customer_id")
    )


def preferred_payment(order_level: DataFrame) -> DataFrame:
    """Most frequent payment type over the orders of a customer."""
    return (
        order_level.where("payment_type_mode IS NOT NULL")
        .groupBy("customer_unique_id")
        .agg(F.mode("payment_type_mode", True).alias("preferred_payment_type"))
    )


def customer_rfm(order_level: DataFrame, as_of: str | date) -> DataFrame:
    """Recency, frequency, monetary value and behaviour per customer.

    The input has one row per order, so the order count is a plain count and the
    preferred payment type needs no join of its own."""
    with_state = F.col("customer_state").isNotNull()
    grouped = order_level.groupBy("customer_unique_id").agg(
        F.count(F.lit(1)).cast("int").alias("frequency"),
        F.sum("item_units").alias("units"),
        F.sum("items_count").alias("items"),
        F.sum("freight_units").alias("freight"),
        F.avg("payment_installments_avg").alias("avg_installments"),
        F.min("order_purchase_timestamp").alias("first_purchase"),
        F.max("order_purchase_timestamp").alias("last_purchase"),
        F.mode("payment_type_mode", True).alias("preferred_payment_type"),
        F.min_by("customer_state", F.when(with_state, F.col("order_id"))).alias("customer_state"),
    )
    n = F.col("frequency")
    age = S.age_days(F.col("first_purchase"), F.col("last_purchase"))
    return grouped.select(
        "customer_unique_id",
        S.elapsed_days_floor(as_of, F.col("last_purchase")).alias("recency_days"),
        "frequency",
        S.money(F.col("units")).alias("monetary"),
        (S.money(F.col("units")) / n).alias("avg_ticket"),
        (F.col("items") / n).alias("avg_items_per_order"),
        (S.money(F.col("freight")) / n).alias("avg_freight"),
        "avg_installments",
        "preferred_payment_type",
        "customer_state",
        age.alias("customer_age_days"),
        S.avg_days_between(age, n).alias("avg_days_between_orders"),
        "first_purchase",
        "last_purchase",
    )
