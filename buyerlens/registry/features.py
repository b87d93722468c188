"""Queries on cleaning, joins, aggregation and ranking."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buyerlens.functions import scalars as S
from buyerlens.operators import cleaning, joins, ranking, rollup
from buyerlens.oracle_base import (
    AS_OF, CLEAN, EVENTS, EVENTS_AS_OF, RFM_COLUMNS, SOURCES, enriched, features_cte, r6, ts_text,
)
from buyerlens.oracle_base import rollup as rollup_cte
from buyerlens.plans import feature_table as plan
from buyerlens.registry import register
from buyerlens.session import checkpointed
from buyerlens.sources import adapters

ROUNDED = [
    "monetary", "avg_ticket", "avg_items_per_order", "avg_freight", "avg_installments",
    "avg_days_between_orders",
]


def text(ts: str) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss").alias(ts)


def rounded(df: DataFrame) -> DataFrame:
    """Six places for doubles (half-way values upwards), text for timestamps, no run time stamps."""
    kept = [c for c in df.columns if c not in ("built_at", "scored_at")]
    types = dict(df.dtypes)
    return df.select(*[
        F.round(F.col(c) + 1e-9, 6).alias(c) if types[c] == "double" else text(c) if types[c] == "timestamp" else F.col(c)
        for c in kept
    ])


_ORDER_TEXTS = ", ".join(
    f"{ts_text(c)} AS {c}" for c in cleaning.TIMESTAMP_COLUMNS
)


@register("clean_orders", f"WITH {CLEAN} SELECT order_id, customer_id, order_status, {_ORDER_TEXTS} FROM ord")
def clean_orders(spark, sf_dir):
    return rounded(cleaning.clean_orders(adapters.orders(spark, sf_dir)))


@register("clean_items", f"""WITH {CLEAN}
SELECT order_id, order_item_id, product_id, seller_id, {ts_text('shipping_limit_date')} AS shipping_limit_date,
  {r6('price')} AS price, {r6('freight_value')} AS freight_value FROM item""")
def clean_items(spark, sf_dir):
    return rounded(cleaning.clean_order_items(adapters.order_items(spark, sf_dir)))


@register("clean_payments", f"""WITH {CLEAN}
SELECT order_id, payment_sequential, payment_type, payment_installments,
  {r6('payment_value')} AS payment_value FROM pay""")
def clean_payments(spark, sf_dir):
    return rounded(cleaning.clean_order_payments(adapters.order_payments(spark, sf_dir)))


@register("clean_customers", f"WITH {CLEAN} SELECT * FROM cust")
def clean_customers(spark, sf_dir):
    return cleaning.clean_customers(adapters.customers(spark, sf_dir))


@register("parse_timestamps", f"""WITH {SOURCES}, texts AS (
  SELECT order_id, CASE WHEN CAST(order_id AS BIGINT) % 13 = 0 THEN 'bad ' || order_id
    ELSE {ts_text('order_purchase_timestamp')} END AS t FROM ord_src)
SELECT order_id, {ts_text('TRY_CAST(t AS TIMESTAMP)')} AS order_purchase_timestamp FROM texts""")
def parse_timestamps(spark, sf_dir):
    """Every thirteenth order carries an unreadable timestamp text."""
    orders = adapters.orders(spark, sf_dir).select("order_id", "order_purchase_timestamp")
    broken = F.col("order_id").cast("bigint") % 13 == 0
    texts = orders.withColumn(
        "order_purchase_timestamp",
        F.when(broken, F.concat(F.lit("bad "), "order_id")).otherwise(text("order_purchase_timestamp")),
    )
    return rounded(cleaning.parse_timestamps(texts))


@register("window_orders", f"""WITH {CLEAN}, {enriched()}
SELECT order_id, customer_id, {ts_text('order_purchase_timestamp')} AS order_purchase_timestamp FROM ord_f""")
def window_orders(spark, sf_dir):
    orders = cleaning.clean_orders(adapters.orders(spark, sf_dir))
    kept = cleaning.observation_window(orders, AS_OF)
    return rounded(kept.select("order_id", "customer_id", "order_purchase_timestamp"))


@register("payment_per_order", f"""WITH {CLEAN},
mode AS (
  SELECT order_id, payment_type FROM (SELECT order_id, payment_type, count(*) AS n FROM pay GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY n DESC, payment_type) = 1)
SELECT p.order_id, {r6('sum(CAST(payment_value AS DECIMAL(18,2)))::DOUBLE')} AS payment_value_total,
  {r6('avg(payment_installments)')} AS payment_installments_avg,
  count(DISTINCT p.payment_type) AS payment_types_nunique, any_value(m.payment_type) AS payment_type_mode
FROM pay p JOIN mode m ON p.order_id = m.order_id GROUP BY p.order_id""")
def payment_per_order(spark, sf_dir):
    payments = cleaning.clean_order_payments(adapters.order_payments(spark, sf_dir))
    return rounded(joins.payment_per_order(payments))


_ENRICHED = f"""order_id, order_item_id, product_id, seller_id, {r6('price')} AS price,
  {r6('freight_value')} AS freight_value, customer_id, order_status,
  {ts_text('order_purchase_timestamp')} AS order_purchase_timestamp, customer_unique_id, customer_state,
  {r6('payment_value_total')} AS payment_value_total, {r6('payment_installments_avg')} AS payment_installments_avg,
  payment_types_nunique, payment_type_mode"""
_ENRICHED_COLUMNS = [
    "order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value", "customer_id",
    "order_status", "order_purchase_timestamp", "customer_unique_id", "customer_state",
    "payment_value_total", "payment_installments_avg", "payment_types_nunique", "payment_type_mode",
]


@register("orders_enriched", f"WITH {CLEAN}, {enriched()} SELECT {_ENRICHED} FROM enriched")
def orders_enriched(spark, sf_dir):
    items = plan.enriched_items(adapters.retail(spark, sf_dir), AS_OF)
    return rounded(items.select(*_ENRICHED_COLUMNS))


def _order_level(spark, sf_dir) -> DataFrame:
    kept = plan.windowed_sources(adapters.retail(spark, sf_dir), AS_OF)
    return rollup.order_rollup_from_sources(kept.orders, kept.customers, kept.items, kept.payments)


@register("order_rollup", f"""WITH {features_cte()}
SELECT customer_unique_id, order_id, {ts_text('order_purchase_timestamp')} AS order_purchase_timestamp,
  {r6('monetary_items')} AS monetary_items, items_count, {r6('freight_sum')} AS freight_sum,
  {r6('payment_value_total')} AS payment_value_total, {r6('payment_installments_avg')} AS payment_installments_avg,
  payment_type_mode, customer_state FROM order_level""")
def order_rollup(spark, sf_dir):
    """From the enriched items; ``customer_rfm`` uses the path that skips them."""
    level = rollup.order_rollup(plan.enriched_items(adapters.retail(spark, sf_dir), AS_OF))
    return rounded(
        level.withColumn("monetary_items", S.money(F.col("item_units")))
        .withColumn("freight_sum", S.money(F.col("freight_units"))).drop("item_units", "freight_units")
    )


@register("customer_rfm", f"WITH {features_cte()} SELECT {RFM_COLUMNS} FROM rfm")
def customer_rfm(spark, sf_dir):
    return rounded(rollup.customer_rfm(_order_level(spark, sf_dir), AS_OF))


@register("preferred_payment", f"WITH {features_cte()} SELECT * FROM pref")
def preferred_payment(spark, sf_dir):
    return rollup.preferred_payment(_order_level(spark, sf_dir))


@register("rfm_quintiles", f"""WITH {features_cte()}
SELECT customer_unique_id, r_score, f_score, m_score, rfm_score FROM feat""")
def rfm_quintiles(spark, sf_dir):
    customers = checkpointed(rollup.customer_rfm(_order_level(spark, sf_dir), AS_OF))
    return plan.score_customers(customers).select(
        "customer_unique_id", "r_score", "f_score", "m_score", "rfm_score"
    )


def _percent_quintile(column: str, order: str) -> str:
    # doubled average rank: rows before + rows up to and including the ties + 1
    doubled = (
        f"(rank() OVER (ORDER BY {order}) - 1 + rank() OVER (ORDER BY {order}) - 1"
        f" + count(*) OVER (PARTITION BY {column}) + 1)"
    )
    return (
        f"CAST(1 + ({doubled} * 5 > 2 * count(*) OVER ())::INT + ({doubled} * 5 > 4 * count(*) OVER ())::INT"
        f" + ({doubled} * 5 > 6 * count(*) OVER ())::INT + ({doubled} * 5 > 8 * count(*) OVER ())::INT AS INTEGER)"
    )


@register("rfm_pct_quintiles", f"""WITH {features_cte()}
SELECT customer_unique_id, {_percent_quintile('recency_days', 'recency_days DESC')} AS r_score,
  {_percent_quintile('frequency', 'frequency')} AS f_score,
  {_percent_quintile('monetary', 'monetary')} AS m_score FROM rfm""")
def rfm_pct_quintiles(spark, sf_dir):
    customers = checkpointed(rollup.customer_rfm(_order_level(spark, sf_dir), AS_OF))
    scored = ranking.add_percent_rank_quintiles(customers, {
        "r_score": ("recency_days", False), "f_score": ("frequency", True), "m_score": ("monetary", True),
    })
    return scored.select("customer_unique_id", "r_score", "f_score", "m_score")


_FEATURES = RFM_COLUMNS + ", as_of_date, r_score, f_score, m_score, rfm_score, feature_set_version"


@register("feature_table", f"WITH {features_cte()} SELECT {_FEATURES} FROM feat")
def feature_table(spark, sf_dir):
    return rounded(plan.feature_table(adapters.retail(spark, sf_dir), AS_OF))


@register("enriched_pipeline", f"WITH {features_cte()} SELECT {_FEATURES} FROM feat")
def enriched_pipeline(spark, sf_dir):
    """The feature table by way of the item-level join."""
    items = plan.enriched_items(adapters.retail(spark, sf_dir), AS_OF)
    return rounded(plan.features_from_enriched(items, AS_OF))


@register("event_rfm", f"""WITH {EVENTS}, {rollup_cte(EVENTS_AS_OF, source='ev')}
SELECT {_FEATURES} FROM feat""")
def event_rfm(spark, sf_dir):
    """RFM of the purchase events in a window of 30 days."""
    purchases = adapters.purchase_events(spark, sf_dir).withColumn("order_status", F.lit("delivered"))
    items = cleaning.observation_window(purchases, EVENTS_AS_OF, 30)
    return rounded(plan.features_from_enriched(items, EVENTS_AS_OF))


@register("sample_rows", """SELECT vec_id, label FROM embeddings
QUALIFY row_number() OVER (ORDER BY ('0x' || substr(md5('42|' || vec_id), 1, 13))::BIGINT, vec_id::VARCHAR)
  <= (SELECT greatest(CAST(floor(count(*) * 0.8) AS BIGINT), 2) FROM embeddings)""")
def sample_rows(spark, sf_dir):
    """Reproducible sample of 80 % of the labelled points."""
    points = adapters.read_table(spark, sf_dir, "embeddings").select("vec_id", "label")
    return ranking.sample_fraction(points, "vec_id", 0.8, 42)


@register("last_row_per_key", """SELECT CAST(user_id AS VARCHAR) AS customer_unique_id,
  strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_type, (round(value + 1e-9, 6) + 0.0) AS value
FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY events.ts DESC, event_type DESC, value DESC) = 1""")
def last_row_per_key(spark, sf_dir):
    """Latest event of every user."""
    events = adapters.read_table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("customer_unique_id"),
        F.col("ts").cast("timestamp").alias("ts"), "event_type", "value",
    )
    return rounded(ranking.last_per_key(events, ["customer_unique_id"], ["ts"]))
