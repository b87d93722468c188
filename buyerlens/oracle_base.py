"""DuckDB text shared by the oracle queries: the same tables, written independently."""

from __future__ import annotations

AS_OF = "2001-08-02"
PRIOR = "2000-12-31"
EVENTS_AS_OF = "2024-01-31"


def r6(expression: str) -> str:
    """Six places; the nudge makes both engines round half-way values upwards."""
    return f"(round(CAST({expression} AS DOUBLE) + 1e-9, 6) + 0.0)"


def ts_text(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S')"


SOURCES = """
ord_src AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS customer_id,
    CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'processing' END AS order_status,
    o_orderdate + to_seconds((o_orderkey * 7919) % 86400) AS order_purchase_timestamp,
    CASE WHEN o_orderkey % 10 <> 0 THEN
      o_orderdate + to_seconds((o_orderkey * 7919) % 86400 + (o_orderkey * 31) % 7200 - 30) END AS order_approved_at,
    CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 2 DAY END AS order_delivered_carrier_date,
    CASE WHEN o_orderstatus = 'F' THEN o_orderdate + INTERVAL 7 DAY END AS order_delivered_customer_date,
    o_orderdate + INTERVAL 14 DAY AS order_estimated_delivery_date
  FROM orders),
cust_src AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id,
    concat('u', lpad(CAST(CASE WHEN c_custkey % 10 = 9 THEN c_custkey - 1 ELSE c_custkey END AS VARCHAR), 9, '0')) AS customer_unique_id,
    lpad(CAST(c_custkey AS VARCHAR), 5, '0') AS customer_zip_code_prefix,
    c_mktsegment AS customer_city,
    lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS customer_state
  FROM customer),
item_src AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS order_item_id,
    CAST(l_partkey AS VARCHAR) AS product_id, CAST(l_suppkey AS VARCHAR) AS seller_id,
    l_shipdate AS shipping_limit_date, l_extendedprice AS price, round(l_quantity * 0.5, 2) AS freight_value
  FROM lineitem),
pay_src AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS order_id, l_linenumber AS payment_sequential,
    CASE l_returnflag WHEN 'R' THEN 'credit_card' WHEN 'A' THEN 'boleto' ELSE 'voucher' END AS payment_type,
    CAST(1 + l_partkey % 10 AS INTEGER) AS payment_installments,
    ((CAST(round(l_extendedprice * 100) AS BIGINT) * (100 - CAST(round(l_discount * 100) AS BIGINT)) + 50) // 100) / 100.0 AS payment_value
  FROM lineitem)"""

CLEAN = SOURCES + """,
ord AS (
  SELECT * FROM ord_src WHERE order_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY customer_id, order_status, order_purchase_timestamp) = 1),
cust AS (
  SELECT * FROM cust_src QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY customer_unique_id) = 1),
item AS (
  SELECT * FROM (
    SELECT * FROM item_src QUALIFY row_number() OVER (PARTITION BY order_id, order_item_id
      ORDER BY product_id NULLS FIRST, seller_id NULLS FIRST, shipping_limit_date NULLS FIRST,
        price NULLS FIRST, freight_value NULLS FIRST) = 1)
  WHERE price >= 0 AND freight_value >= 0),
pay AS (
  SELECT * FROM (
    SELECT * FROM pay_src QUALIFY row_number() OVER (PARTITION BY order_id, payment_sequential
      ORDER BY payment_type NULLS FIRST, payment_installments NULLS FIRST, payment_value NULLS FIRST) = 1)
  WHERE payment_value >= 0)"""


def enriched(as_of: str = AS_OF, suffix: str = "") -> str:
    """CTEs ``ord_f``, ``pay_agg`` and ``enriched`` of one as-of date."""
    s = suffix
    return f"""
ord_f{s} AS (
  SELECT * FROM ord
  WHERE order_purchase_timestamp BETWEEN TIMESTAMP '{as_of} 23:59:59' - INTERVAL 365 DAY AND TIMESTAMP '{as_of} 23:59:59'
    AND order_status = 'delivered'),
pay_f{s} AS (SELECT * FROM pay WHERE order_id IN (SELECT order_id FROM ord_f{s})),
pay_mode{s} AS (
  SELECT order_id, payment_type FROM (
    SELECT order_id, payment_type, count(*) AS n FROM pay_f{s} WHERE payment_type IS NOT NULL GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY n DESC, payment_type) = 1),
pay_agg{s} AS (
  SELECT p.order_id, CAST(sum(CAST(payment_value AS DECIMAL(18,2))) AS DOUBLE) AS payment_value_total,
    avg(payment_installments) AS payment_installments_avg,
    count(DISTINCT p.payment_type) AS payment_types_nunique,
    any_value(m.payment_type) AS payment_type_mode
  FROM pay_f{s} p LEFT JOIN pay_mode{s} m ON p.order_id = m.order_id GROUP BY p.order_id),
enriched{s} AS (
  SELECT i.*, o.* EXCLUDE (order_id), c.customer_unique_id, c.customer_state, a.* EXCLUDE (order_id)
  FROM item i JOIN ord_f{s} o ON i.order_id = o.order_id
  JOIN cust c ON o.customer_id = c.customer_id
  LEFT JOIN pay_agg{s} a ON i.order_id = a.order_id)"""


def rollup(as_of: str = AS_OF, suffix: str = "", source: str | None = None, version: str = "1.0.0") -> str:
    """CTEs ``order_level``, ``rfm`` and ``feat`` on top of enriched items."""
    s = suffix
    enriched_name = source or f"enriched{s}"

    def quintile(order: str) -> str:
        rank = f"row_number() OVER (ORDER BY {order}, customer_unique_id)"
        return f"CASE WHEN count(*) OVER () = 1 THEN 1 ELSE (5 * ({rank} - 1) + count(*) OVER () - 2) // (count(*) OVER () - 1) END"

    def scored(column: str, order: str) -> str:
        return (
            f"CAST(CASE WHEN min({column}) OVER () = max({column}) OVER () THEN 1 "
            f"ELSE greatest(1, {quintile(order)}) END AS INTEGER)"
        )

    return f"""
order_level{s} AS (
  SELECT customer_unique_id, order_id, min(order_purchase_timestamp) AS order_purchase_timestamp,
    CAST(coalesce(sum(CAST(price AS DECIMAL(18,2))), 0) AS DOUBLE) AS monetary_items,
    count(order_item_id) AS items_count,
    CAST(coalesce(sum(CAST(freight_value AS DECIMAL(18,2))), 0) AS DOUBLE) AS freight_sum,
    max(payment_value_total) AS payment_value_total,
    max(payment_installments_avg) AS payment_installments_avg,
    max(payment_type_mode) AS payment_type_mode,
    max(customer_state) AS customer_state
  FROM {enriched_name} GROUP BY customer_unique_id, order_id),
pref{s} AS (
  SELECT customer_unique_id, payment_type_mode AS preferred_payment_type FROM (
    SELECT customer_unique_id, payment_type_mode, count(*) AS n FROM order_level{s}
    WHERE payment_type_mode IS NOT NULL GROUP BY ALL)
  QUALIFY row_number() OVER (PARTITION BY customer_unique_id ORDER BY n DESC, payment_type_mode) = 1),
rfm_raw{s} AS (
  SELECT customer_unique_id,
    CAST(floor((epoch_us(TIMESTAMP '{as_of} 00:00:00') - epoch_us(max(order_purchase_timestamp))) / 86400000000.0) AS INTEGER) AS recency_days,
    CAST(count(DISTINCT order_id) AS INTEGER) AS frequency,
    CAST(sum(CAST(monetary_items AS DECIMAL(18,2))) AS DOUBLE) AS monetary,
    CAST(sum(CAST(monetary_items AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_ticket,
    avg(items_count) AS avg_items_per_order,
    CAST(sum(CAST(freight_sum AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS avg_freight,
    avg(payment_installments_avg) AS avg_installments,
    min(order_purchase_timestamp) AS first_purchase, max(order_purchase_timestamp) AS last_purchase,
    arg_min(customer_state, order_id) FILTER (WHERE customer_state IS NOT NULL) AS customer_state
  FROM order_level{s} GROUP BY customer_unique_id),
rfm{s} AS (
  SELECT r.*, p.preferred_payment_type,
    CAST(floor((epoch_us(last_purchase) - epoch_us(first_purchase)) / 86400000000.0) AS INTEGER) AS customer_age_days,
    CASE WHEN frequency > 1 THEN
      floor((epoch_us(last_purchase) - epoch_us(first_purchase)) / 86400000000.0) / (frequency - 1) END AS avg_days_between_orders
  FROM rfm_raw{s} r LEFT JOIN pref{s} p ON r.customer_unique_id = p.customer_unique_id),
feat{s} AS (
  SELECT *, concat(r_score, f_score, m_score) AS rfm_score, '{as_of}' AS as_of_date, '{version}' AS feature_set_version
  FROM (SELECT *,
      {scored('recency_days', 'recency_days DESC')} AS r_score,
      {scored('frequency', 'frequency')} AS f_score,
      {scored('monetary', 'monetary')} AS m_score
    FROM rfm{s}))"""


RFM_COLUMNS = f"""customer_unique_id, recency_days, frequency, {r6('monetary')} AS monetary,
  {r6('avg_ticket')} AS avg_ticket, {r6('avg_items_per_order')} AS avg_items_per_order,
  {r6('avg_freight')} AS avg_freight, {r6('avg_installments')} AS avg_installments,
  preferred_payment_type, customer_state, customer_age_days,
  {r6('avg_days_between_orders')} AS avg_days_between_orders,
  {ts_text('first_purchase')} AS first_purchase, {ts_text('last_purchase')} AS last_purchase"""

EVENTS = """
ev AS (
  SELECT CAST(event_id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS customer_unique_id,
    ts AS order_purchase_timestamp, 1 AS order_item_id, value AS price, 0.0 AS freight_value,
    CAST(NULL AS DOUBLE) AS payment_value_total, CAST(NULL AS DOUBLE) AS payment_installments_avg,
    CAST(NULL AS VARCHAR) AS payment_type_mode, CAST(NULL AS VARCHAR) AS customer_state
  FROM events WHERE event_type = 'purchase'
    AND ts BETWEEN TIMESTAMP '2024-01-31 23:59:59' - INTERVAL 30 DAY AND TIMESTAMP '2024-01-31 23:59:59')"""


def features_cte(as_of: str = AS_OF) -> str:
    return CLEAN + "," + enriched(as_of) + "," + rollup(as_of)
