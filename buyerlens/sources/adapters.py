"""Views of the star-schema test tables in the shape of the retail contracts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Sources:
    orders: DataFrame
    customers: DataFrame
    items: DataFrame
    payments: DataFrame


_SCHEMAS: dict[str, T.StructType] = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; its schema is read from the files once per process."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def _shift(ts: Column, seconds: Column) -> Column:
    return F.timestamp_micros(F.unix_micros(ts) + seconds.cast("bigint") * 1_000_000)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose key ends in 9 share the unique id of their neighbour."""
    key = F.col("c_custkey")
    owner = F.when(key % 10 == 9, key - 1).otherwise(key)
    return read_table(spark, sf_dir, "customer").select(
        key.cast("string").alias("customer_id"),
        F.concat(F.lit("u"), F.lpad(owner.cast("string"), 9, "0")).alias("customer_unique_id"),
        F.lpad(key.cast("string"), 5, "0").alias("customer_zip_code_prefix"),
        F.col("c_mktsegment").alias("customer_city"),
        F.lpad(F.col("c_nationkey").cast("string"), 2, "0").alias("customer_state"),
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("o_orderkey")
    day = F.col("o_orderdate").cast("timestamp")
    purchased = _shift(day, (key * 7919) % 86400)
    shipped = F.col("o_orderstatus") == "F"
    return read_table(spark, sf_dir, "orders").select(
        key.cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.when(shipped, "delivered").when(F.col("o_orderstatus") == "O", "shipped")
        .otherwise("processing").alias("order_status"),
        purchased.alias("order_purchase_timestamp"),
        F.when(key % 10 != 0, _shift(purchased, (key * 31) % 7200 - 30)).alias("order_approved_at"),
        F.when(shipped, _shift(day, F.lit(2 * 86400))).alias("order_delivered_carrier_date"),
        F.when(shipped, _shift(day, F.lit(7 * 86400))).alias("order_delivered_customer_date"),
        _shift(day, F.lit(14 * 86400)).alias("order_estimated_delivery_date"),
    )


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("l_suppkey").cast("string").alias("seller_id"),
        F.col("l_shipdate").cast("timestamp").alias("shipping_limit_date"),
        F.col("l_extendedprice").alias("price"),
        F.round(F.col("l_quantity") * 0.5, 2).alias("freight_value"),
    )


def order_payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    # whole cents, half up: the product of two decimals has no double to round
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    percent = F.lit(100) - F.round(F.col("l_discount") * 100).cast("bigint")
    paid = F.floor((cents * percent + 50) / 100) / 100
    return read_table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("l_linenumber").alias("payment_sequential"),
        F.when(F.col("l_returnflag") == "R", "credit_card")
        .when(F.col("l_returnflag") == "A", "boleto").otherwise("voucher").alias("payment_type"),
        (F.col("l_partkey") % 10 + 1).cast("int").alias("payment_installments"),
        paid.alias("payment_value"),
    )


def retail(spark: SparkSession, sf_dir: str) -> Sources:
    return Sources(
        orders(spark, sf_dir), customers(spark, sf_dir),
        order_items(spark, sf_dir), order_payments(spark, sf_dir),
    )


def purchase_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases of the event table as one-item orders at item grain."""
    return (
        read_table(spark, sf_dir, "events")
        .where(F.col("event_type") == "purchase")
        .select(
            F.col("event_id").cast("string").alias("order_id"),
            F.col("user_id").cast("string").alias("customer_unique_id"),
            F.col("ts").cast("timestamp").alias("order_purchase_timestamp"),
            F.lit(1).alias("order_item_id"),
            F.col("value").alias("price"),
            F.lit(0.0).alias("freight_value"),
            F.lit(None).cast("double").alias("payment_value_total"),
            F.lit(None).cast("double").alias("payment_installments_avg"),
            F.lit(None).cast("string").alias("payment_type_mode"),
            F.lit(None).cast("string").alias("customer_state"),
        )
    )


def labelled_points(spark: SparkSession, sf_dir: str, dims: int = 64) -> DataFrame:
    """Embeddings as scalar double columns ``x0 … x{dims-1}`` with their label."""
    return read_table(spark, sf_dir, "embeddings").select(
        "vec_id", "label",
        *[F.col("embedding")[i].cast("double").alias(f"x{i}") for i in range(dims)],
    )


def dimension_count(spark: SparkSession, sf_dir: str) -> int:
    return read_table(spark, sf_dir, "embeddings").select(F.size("embedding")).first()[0]
