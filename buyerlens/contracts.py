"""Table contracts: schema, keys, allowed values and the declared quality checks.

The lists, names and thresholds below are fixed values.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Allowed texts of the categorical columns.
ORDER_STATUSES = (
    "delivered", "shipped", "invoiced", "processing",
    "created", "approved", "canceled", "unavailable",
)
PAYMENT_TYPES = ("credit_card", "boleto", "voucher", "debit_card", "not_defined")

TYPES = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "float": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
}


@dataclass(frozen=True)
class Field:
    name: str
    type: str
    nullable: bool = False
    allowed: tuple[str, ...] = ()


@dataclass(frozen=True)
class Check:
    """A declared check: a SQL aggregate and the comparison it must satisfy.

    With ``per`` the measure is taken per value of that column and the smallest
    one is compared. ``{now}`` is filled in by the caller."""

    name: str
    severity: str
    measure: str
    condition: str
    per: str | None = None


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    parent: str
    parent_columns: tuple[str, ...]


@dataclass(frozen=True)
class Contract:
    name: str
    fields: tuple[Field, ...]
    primary_key: tuple[str, ...]
    partitioned_by: tuple[str, ...]
    checks: tuple[Check, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    consumers: tuple[str, ...] = field(default=())

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, TYPES[f.type], True) for f in self.fields])

    @property
    def landing_schema(self) -> T.StructType:
        """Landing text keeps timestamps as text; they are parsed when cleaned."""
        return T.StructType([
            T.StructField(f.name, TYPES["string" if f.type == "timestamp" else f.type], True)
            for f in self.fields
        ])


def _non_negative(column: str) -> Check:
    return Check(f"non_negative:{column}", "error", f"count_if({column} < 0)", "= 0")


def _positive(column: str) -> Check:
    return Check(f"positive:{column}", "error", f"count_if({column} <= 0)", "= 0")


_ROWS = Check("row_count_min", "error", "count(*)", ">= 1")

ORDERS = Contract(
    "orders",
    (
        Field("order_id", "string"),
        Field("customer_id", "string"),
        Field("order_status", "string", allowed=ORDER_STATUSES),
        Field("order_purchase_timestamp", "timestamp"),
        Field("order_approved_at", "timestamp", nullable=True),
        Field("order_delivered_carrier_date", "timestamp", nullable=True),
        Field("order_delivered_customer_date", "timestamp", nullable=True),
        Field("order_estimated_delivery_date", "timestamp", nullable=True),
    ),
    ("order_id",),
    ("year", "month"),
    (
        _ROWS,
        Check("delivered_ratio", "warn", "avg(CASE WHEN order_status = 'delivered' THEN 1.0D ELSE 0.0D END)", ">= 0.80"),
        Check("purchase_not_in_future", "error", "count_if(order_purchase_timestamp > {now})", "= 0"),
        Check("approved_after_purchase", "warn", "count_if(order_approved_at < order_purchase_timestamp)", "= 0"),
    ),
    (ForeignKey(("customer_id",), "customers", ("customer_id",)),),
    ("feature_store_rfm", "training_pipeline", "scoring_pipeline"),
)

CUSTOMERS = Contract(
    "customers",
    (
        Field("customer_id", "string"),
        Field("customer_unique_id", "string"),
        Field("customer_zip_code_prefix", "string"),
        Field("customer_city", "string"),
        Field("customer_state", "string"),
    ),
    ("customer_id",),
    ("snapshot",),
    (
        _ROWS,
        Check("unique_id_coverage", "warn", "count(DISTINCT customer_unique_id) / count(*)", ">= 0.90"),
        Check("length_eq_2:customer_state", "error", "count_if(length(customer_state) <> 2)", "= 0"),
    ),
    (),
    ("feature_store_rfm", "scoring_pipeline", "serving_api"),
)

ORDER_ITEMS = Contract(
    "order_items",
    (
        Field("order_id", "string"),
        Field("order_item_id", "integer"),
        Field("product_id", "string"),
        Field("seller_id", "string"),
        Field("shipping_limit_date", "timestamp", nullable=True),
        Field("price", "float"),
        Field("freight_value", "float"),
    ),
    ("order_id", "order_item_id"),
    ("year", "month"),
    (
        _ROWS,
        Check("price_positive_ratio", "error", "avg(CASE WHEN price > 0 THEN 1.0D ELSE 0.0D END)", ">= 0.99"),
        _positive("order_item_id"),
        _non_negative("price"),
        _non_negative("freight_value"),
    ),
    (ForeignKey(("order_id",), "orders", ("order_id",)),),
    ("feature_store_rfm",),
)

ORDER_PAYMENTS = Contract(
    "order_payments",
    (
        Field("order_id", "string"),
        Field("payment_sequential", "integer"),
        Field("payment_type", "string", allowed=PAYMENT_TYPES),
        Field("payment_installments", "integer"),
        Field("payment_value", "float"),
    ),
    ("order_id", "payment_sequential"),
    ("year", "month"),
    (
        _ROWS,
        Check("payment_value_positive_ratio", "error", "avg(CASE WHEN payment_value > 0 THEN 1.0D ELSE 0.0D END)", ">= 0.99"),
        _positive("payment_sequential"),
        _non_negative("payment_installments"),
        _non_negative("payment_value"),
    ),
    (ForeignKey(("order_id",), "orders", ("order_id",)),),
    ("feature_store_rfm",),
)

CUSTOMER_FEATURES = Contract(
    "customer_features",
    (
        Field("customer_unique_id", "string"),
        Field("as_of_date", "string"),
        Field("recency_days", "integer"),
        Field("frequency", "integer"),
        Field("monetary", "float"),
        Field("r_score", "integer"),
        Field("f_score", "integer"),
        Field("m_score", "integer"),
        Field("rfm_score", "string"),
        Field("avg_ticket", "float"),
        Field("avg_items_per_order", "float"),
        Field("avg_freight", "float", nullable=True),
        Field("avg_installments", "float", nullable=True),
        Field("preferred_payment_type", "string", nullable=True),
        Field("customer_state", "string", nullable=True),
        Field("customer_age_days", "integer"),
        Field("avg_days_between_orders", "float", nullable=True),
        Field("first_purchase", "timestamp"),
        Field("last_purchase", "timestamp"),
        Field("feature_set_version", "string"),
        Field("built_at", "timestamp"),
    ),
    ("customer_unique_id", "as_of_date"),
    ("feature_set_version", "as_of_date"),
    (
        Check("one_row_per_customer", "error",
              "count(*) - count(DISTINCT struct(as_of_date, customer_unique_id))", "= 0"),
        Check("frequency_positive", "error", "min(frequency)", ">= 1"),
        Check("recency_non_negative", "error", "min(recency_days)", ">= 0"),
        Check("monetary_non_negative", "error", "min(monetary)", ">= 0"),
        Check("min_customers", "warn", "count(*)", ">= 100"),
    ),
    (),
    ("scoring_pipeline", "training_pipeline", "feature_store_rfm"),
)

CUSTOMER_SEGMENTS = Contract(
    "customer_segments",
    (
        Field("customer_unique_id", "string"),
        Field("as_of_date", "string"),
        Field("recency_days", "integer"),
        Field("frequency", "integer"),
        Field("monetary", "float"),
        Field("r_score", "integer", nullable=True),
        Field("f_score", "integer", nullable=True),
        Field("m_score", "integer", nullable=True),
        Field("segment_id", "integer"),
        Field("segment_label", "string"),
        Field("model_name", "string"),
        Field("model_version", "string"),
        Field("feature_set_version", "string"),
        Field("scored_at", "timestamp"),
    ),
    ("customer_unique_id", "as_of_date"),
    ("as_of_date",),
    (
        Check("one_row_per_customer", "error",
              "count(*) - count(DISTINCT struct(as_of_date, customer_unique_id))", "= 0"),
        Check("segment_coverage", "error", "count(segment_label) / count(*)", "= 1"),
        Check("min_customers", "warn", "count(*)", ">= 1000"),
        Check("segment_cardinality", "error", "count(DISTINCT segment_id)", "BETWEEN 3 AND 10"),
        Check("no_empty_segment", "warn", "count(*)", ">= 50", per="segment_id"),
        Check("freshness_48h", "sla", "(unix_micros({now}) - unix_micros(max(scored_at))) / 3600000000D", "<= 48"),
    ),
    (),
    ("serving_api", "marketing_campaigns", "crm_export"),
)

CONTRACTS = {
    c.name: c
    for c in (ORDERS, CUSTOMERS, ORDER_ITEMS, ORDER_PAYMENTS, CUSTOMER_FEATURES, CUSTOMER_SEGMENTS)
}
INCREMENTAL_DATASETS = ("orders", "order_items", "order_payments")
FEATURE_COLUMNS = CUSTOMER_FEATURES.columns
SEGMENT_COLUMNS = CUSTOMER_SEGMENTS.columns
FEATURE_SET_VERSION = "1.0.0"
