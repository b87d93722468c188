"""Queries on partitions, data quality and contracts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buyerlens.contracts import CONTRACTS, CUSTOMER_FEATURES, ORDERS, Contract, Field
from buyerlens.functions import scalars as S
from buyerlens.operators import cleaning, quality
from buyerlens.oracle_base import CLEAN, PRIOR, SOURCES, enriched, r6
from buyerlens.oracle_base import rollup as rollup_cte
from buyerlens.plans import feature_table as plan
from buyerlens.registry import register
from buyerlens.sources import adapters, partitions

_MONTHS = """
months AS (
  SELECT order_id, CAST(substr(t, 1, 4) AS INTEGER) AS year, CAST(substr(t, 6, 2) AS INTEGER) AS month
  FROM (SELECT order_id, strftime(order_purchase_timestamp, '%Y-%m-%d') AS t FROM ord_src)),
observed AS (
  SELECT 'orders' AS dataset, year, month FROM months
  UNION ALL SELECT 'order_items', year, month FROM item_src JOIN months USING (order_id)
  UNION ALL SELECT 'order_payments', year, month FROM pay_src JOIN months USING (order_id))"""


def _dated(spark, sf_dir) -> dict[str, DataFrame]:
    """Every incremental dataset with the year and month it is stored under."""
    months = partitions.order_months(adapters.orders(spark, sf_dir))
    return {
        "orders": partitions.with_month(adapters.orders(spark, sf_dir), "order_purchase_timestamp"),
        "order_items": partitions.inherit_month(adapters.order_items(spark, sf_dir), months),
        "order_payments": partitions.inherit_month(adapters.order_payments(spark, sf_dir), months),
    }


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


@register("partition_counts", f"""WITH {SOURCES}, {_MONTHS}
SELECT dataset, year, month, count(*) AS n_rows FROM observed GROUP BY ALL""")
def partition_counts(spark, sf_dir):
    return _union([partitions.partition_row_counts(df, name) for name, df in _dated(spark, sf_dir).items()])


@register("missing_partitions", f"""WITH {SOURCES}, {_MONTHS},
span AS (SELECT unnest(generate_series(DATE '2000-12-01', DATE '2001-12-01', INTERVAL 1 MONTH)) AS m),
expected AS (
  SELECT d AS dataset, CAST(year(m) AS INTEGER) AS year, CAST(month(m) AS INTEGER) AS month
  FROM span, (VALUES ('orders'), ('order_items'), ('order_payments')) v(d))
SELECT e.dataset, e.year, e.month, printf('%s/%04d-%02d', e.dataset, e.year, e.month) AS partition
FROM expected e ANTI JOIN observed o ON e.dataset = o.dataset AND e.year = o.year AND e.month = o.month""")
def missing_partitions(spark, sf_dir):
    """Months of the year up to 2001-12-31 that a dataset lacks."""
    observed = _union([
        df.select("year", "month").distinct().withColumn("dataset", F.lit(name))
        for name, df in _dated(spark, sf_dir).items()
    ])
    day = spark.range(1).select(F.lit("2001-12-31").cast("date").alias("as_of_date"))
    return partitions.missing_partitions(partitions.months_frame(day, 365), observed)


@register("months_in_window", """WITH days AS (
  SELECT o_orderstatus AS status, CAST(max(o_orderdate) AS DATE) AS as_of_date FROM orders GROUP BY 1),
span AS (
  SELECT status, as_of_date, unnest(generate_series(date_trunc('month', as_of_date - 60), date_trunc('month', as_of_date), INTERVAL 1 MONTH)) AS m
  FROM days)
SELECT status, strftime(as_of_date, '%Y-%m-%d') AS as_of_date, CAST(year(m) AS INTEGER) AS year,
  CAST(month(m) AS INTEGER) AS month, count(o_orderkey) AS n_orders
FROM span LEFT JOIN orders ON o_orderstatus = status AND date_trunc('month', o_orderdate) = m GROUP BY ALL""")
def months_in_window(spark, sf_dir):
    """Months of the 60 days before the last order of each status, with their orders."""
    orders = adapters.read_table(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("status"), F.to_date("o_orderdate").alias("day")
    )
    last = orders.groupBy("status").agg(F.max("day").alias("as_of_date"))
    months = partitions.months_frame(last, 60)
    per_month = orders.groupBy("status", F.year("day").alias("year"), F.month("day").alias("month")).count()
    return (
        last.join(months, "as_of_date").distinct()
        .join(per_month, ["status", "year", "month"], "left")
        .select("status", F.col("as_of_date").cast("string").alias("as_of_date"), "year", "month",
                F.coalesce("count", F.lit(0)).cast("bigint").alias("n_orders"))
    )


@register("child_month_inherit", f"""WITH {SOURCES}, {_MONTHS}
SELECT order_id, order_item_id, year, month, count(*) AS n_rows FROM item_src
JOIN (SELECT m.* FROM months m JOIN ord_src o USING (order_id) WHERE o.order_status = 'delivered') USING (order_id)
GROUP BY ALL""")
def child_month_inherit(spark, sf_dir):
    """Items under the month of their delivered order; other items are orphans here."""
    delivered = adapters.orders(spark, sf_dir).where("order_status = 'delivered'")
    items = partitions.inherit_month(adapters.order_items(spark, sf_dir), partitions.order_months(delivered))
    return items.groupBy("order_id", "order_item_id", "year", "month").agg(F.count(F.lit(1)).alias("n_rows"))


@register("orphan_rows", f"""WITH {SOURCES}
SELECT count(*) AS orphans FROM item_src WHERE order_id NOT IN (SELECT order_id FROM ord_src WHERE order_status = 'delivered')""")
def orphan_rows(spark, sf_dir):
    delivered = adapters.orders(spark, sf_dir).where("order_status = 'delivered'")
    return partitions.orphan_count(adapters.order_items(spark, sf_dir), partitions.order_months(delivered))


@register("default_as_of", """SELECT o_orderstatus AS status, strftime(max(o_orderdate), '%Y-%m-%d') AS interval_end,
  strftime(CAST(max(o_orderdate) AS DATE) - 1, '%Y-%m-%d') AS as_of_date FROM orders GROUP BY 1""")
def default_as_of(spark, sf_dir):
    """The as-of date of a run whose interval ends with the last order of each status."""
    ends = adapters.read_table(spark, sf_dir, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.max("o_orderdate").alias("end"))
    return ends.select(
        "status", F.date_format("end", "yyyy-MM-dd").alias("interval_end"), S.default_as_of(F.col("end")).cast("string").alias("as_of_date"))


# --- data quality ---------------------------------------------------------------

def _blemished(spark, sf_dir) -> DataFrame:
    """Items with the missing-value spellings the null check has to find."""
    return adapters.order_items(spark, sf_dir).select(
        "order_id", "order_item_id",
        F.when(F.col("product_id").cast("bigint") % 50 == 0, "nan").otherwise(F.col("product_id")).alias("product_id"),
        F.when(F.col("seller_id").cast("bigint") % 30 == 0, "  ").otherwise(F.col("seller_id")).alias("seller_id"),
        "shipping_limit_date", "price", F.nullif("freight_value", F.lit(25.0)).alias("freight_value"),
    )


@register("not_null_checks", f"""WITH {SOURCES}, counted AS (
  SELECT count(*) FILTER (WHERE order_id IS NULL) AS a, count(*) FILTER (WHERE order_item_id IS NULL) AS b,
    count(*) FILTER (WHERE CAST(product_id AS BIGINT) % 50 = 0) AS c,
    count(*) FILTER (WHERE CAST(seller_id AS BIGINT) % 30 = 0) AS d,
    count(*) FILTER (WHERE price IS NULL) AS e, count(*) FILTER (WHERE freight_value = 25.0) AS f FROM item_src)
SELECT 'not_null:order_id' AS "check", a AS violations FROM counted
UNION ALL SELECT 'not_null:order_item_id', b FROM counted UNION ALL SELECT 'not_null:product_id', c FROM counted
UNION ALL SELECT 'not_null:seller_id', d FROM counted UNION ALL SELECT 'not_null:price', e FROM counted
UNION ALL SELECT 'not_null:freight_value', f FROM counted""")
def not_null_checks(spark, sf_dir):
    return quality.count_violations(_blemished(spark, sf_dir), CONTRACTS["order_items"], "nulls")


@register("pk_check", f"""WITH {SOURCES}
SELECT 'order_items' AS dataset, (SELECT count(*) FROM item_src) - (SELECT count(*) FROM (SELECT DISTINCT order_id, order_item_id FROM item_src)) AS violations
UNION ALL SELECT 'order_payments', (SELECT count(*) FROM pay_src) - (SELECT count(*) FROM (SELECT DISTINCT order_id, payment_sequential FROM pay_src))
UNION ALL SELECT 'orders', (SELECT count(*) - count(DISTINCT order_id) FROM ord_src)
UNION ALL SELECT 'customers', (SELECT count(*) - count(DISTINCT customer_id) FROM cust_src)""")
def pk_check(spark, sf_dir):
    sources = adapters.retail(spark, sf_dir)
    tables = {"order_items": sources.items, "order_payments": sources.payments,
              "orders": sources.orders, "customers": sources.customers}
    return _union([
        quality.count_violations(df, CONTRACTS[name], "key").select(F.lit(name).alias("dataset"), "violations")
        for name, df in tables.items()
    ])


_LANGUAGES = Contract("documents", (Field("doc_id", "integer"), Field("lang", "string", allowed=("en",))), ("doc_id",), ())


@register("allowed_values_check", f"""WITH {SOURCES},
invalid AS (
  SELECT 'allowed_values:order_status' AS "check", o_orderpriority AS v FROM orders
  WHERE o_orderpriority IS NOT NULL
  UNION ALL SELECT 'allowed_values:lang', lang FROM documents WHERE lang IS NOT NULL AND lang <> 'en'),
few AS (
  SELECT "check", string_agg(v, ', ' ORDER BY v) AS sample FROM (
    SELECT DISTINCT "check", v FROM invalid QUALIFY dense_rank() OVER (PARTITION BY "check" ORDER BY v) <= 5) GROUP BY 1)
SELECT "check", count(*) AS violations, false AS passed,
  concat(count(*), ' inválidos; amostra=[', any_value(sample), ']') AS detail
FROM invalid JOIN few USING ("check") GROUP BY 1""")
def allowed_values_check(spark, sf_dir):
    """Order priorities read as statuses, and languages other than English."""
    statuses = adapters.read_table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_orderpriority").alias("order_status")
    )
    documents = adapters.read_table(spark, sf_dir, "documents").select("doc_id", "lang")
    reports = [quality.validate(statuses, ORDERS), quality.validate(documents, _LANGUAGES)]
    return _union(reports).where("check LIKE 'allowed_values:%'").select("check", "violations", "passed", "detail")


@register("fk_checks", f"""WITH {CLEAN}, good AS (SELECT * FROM ord WHERE order_status = 'delivered'),
all_checks AS (
  SELECT 'fk_orders_customers' AS "check", (SELECT count(*) FROM ord ANTI JOIN cust USING (customer_id)) AS violations
  UNION ALL SELECT 'fk_items_orders', (SELECT count(*) FROM item ANTI JOIN ord USING (order_id))
  UNION ALL SELECT 'fk_payments_orders', (SELECT count(*) FROM pay ANTI JOIN ord USING (order_id))
  UNION ALL SELECT 'fk_items_delivered', (SELECT count(*) FROM item ANTI JOIN good USING (order_id))
  UNION ALL SELECT 'fk_labels_documents', (SELECT count(*) FROM labels ANTI JOIN documents USING (doc_id))
  UNION ALL SELECT 'fk_null_key', (SELECT count(*) FROM ord_src o WHERE NOT EXISTS (
    SELECT 1 FROM good g WHERE g.order_approved_at IS NOT DISTINCT FROM o.order_approved_at)))
SELECT "check", violations, violations = 0 AS passed FROM all_checks""")
def fk_checks(spark, sf_dir):
    """The declared chain, a chain with orphans, and a nullable key where null meets null."""
    sources = adapters.retail(spark, sf_dir)
    orders = cleaning.clean_orders(sources.orders)
    items = cleaning.clean_order_items(sources.items)
    delivered = orders.where("order_status = 'delivered'")
    reports = [
        quality.foreign_key_chain(orders, cleaning.clean_customers(sources.customers), items,
                                  cleaning.clean_order_payments(sources.payments)),
        quality.referential_integrity(items, delivered, ["order_id"], ["order_id"], "fk_items_delivered"),
        quality.referential_integrity(
            adapters.read_table(spark, sf_dir, "labels"), adapters.read_table(spark, sf_dir, "documents"),
            ["doc_id"], ["doc_id"], "fk_labels_documents"),
        quality.referential_integrity(sources.orders, delivered, ["order_approved_at"], ["order_approved_at"],
                                      "fk_null_key"),
    ]
    return _union(reports).select("check", "violations", "passed")


_NOW = "TIMESTAMP '2001-07-01 00:00:00'"


def _measured(rows: list[tuple[str, str, str, str, str, str]]) -> str:
    """Oracle rows ``dataset, check, severity, measure, passed`` from (dataset, table, …) tuples."""
    return " UNION ALL ".join(
        f"SELECT '{dataset}' AS dataset, '{check}' AS \"check\", '{severity}' AS severity, "
        f"{r6(f'CAST({measure} AS DOUBLE)')} AS measure, CAST({measure} AS DOUBLE) {condition} AS passed FROM {table}"
        for dataset, table, check, severity, measure, condition in rows
    )


@register("contract_expressions", "WITH " + SOURCES + " " + _measured([
    ("orders", "ord_src", "row_count_min", "error", "count(*)", ">= 1"),
    ("orders", "ord_src", "delivered_ratio", "warn", "avg((order_status = 'delivered')::INT)", ">= 0.80"),
    ("orders", "ord_src", "purchase_not_in_future", "error", f"count(*) FILTER (WHERE order_purchase_timestamp > {_NOW})", "= 0"),
    ("orders", "ord_src", "approved_after_purchase", "warn", "count(*) FILTER (WHERE order_approved_at < order_purchase_timestamp)", "= 0"),
    ("customers", "cust_src", "row_count_min", "error", "count(*)", ">= 1"),
    ("customers", "cust_src", "unique_id_coverage", "warn", "count(DISTINCT customer_unique_id) / count(*)", ">= 0.90"),
    ("customers", "cust_src", "length_eq_2:customer_state", "error", "count(*) FILTER (WHERE length(customer_state) <> 2)", "= 0"),
    ("order_items", "item_src", "row_count_min", "error", "count(*)", ">= 1"),
    ("order_items", "item_src", "price_positive_ratio", "error", "avg((price > 0)::INT)", ">= 0.99"),
    ("order_items", "item_src", "positive:order_item_id", "error", "count(*) FILTER (WHERE order_item_id <= 0)", "= 0"),
    ("order_items", "item_src", "non_negative:price", "error", "count(*) FILTER (WHERE price < 0)", "= 0"),
    ("order_items", "item_src", "non_negative:freight_value", "error", "count(*) FILTER (WHERE freight_value < 0)", "= 0"),
    ("order_payments", "pay_src", "row_count_min", "error", "count(*)", ">= 1"),
    ("order_payments", "pay_src", "payment_value_positive_ratio", "error", "avg((payment_value > 0)::INT)", ">= 0.99"),
    ("order_payments", "pay_src", "positive:payment_sequential", "error", "count(*) FILTER (WHERE payment_sequential <= 0)", "= 0"),
    ("order_payments", "pay_src", "non_negative:payment_installments", "error", "count(*) FILTER (WHERE payment_installments < 0)", "= 0"),
    ("order_payments", "pay_src", "non_negative:payment_value", "error", "count(*) FILTER (WHERE payment_value < 0)", "= 0"),
]))
def contract_expressions(spark, sf_dir):
    """All declared checks of the four input tables, as seen on 2001-07-01."""
    sources = adapters.retail(spark, sf_dir)
    tables = {"orders": sources.orders, "customers": sources.customers,
              "order_items": sources.items, "order_payments": sources.payments}
    return _union([
        quality.contract_expressions(df, CONTRACTS[name], _NOW).select(
            F.lit(name).alias("dataset"), "check", "severity", F.round(F.col("measure") + 1e-9, 6).alias("measure"), "passed"
        )
        for name, df in tables.items()
    ])


@register("dataset_validation", f"""WITH {SOURCES},
facts AS (
  SELECT (SELECT count(*) FROM pay_src) AS n,
    (SELECT count(*) FROM (SELECT DISTINCT order_id, payment_sequential FROM pay_src)) AS keys,
    (SELECT count(*) FROM pay_src WHERE payment_type NOT IN ('credit_card','boleto','voucher','debit_card','not_defined')) AS bad),
report AS (
  SELECT 'schema_columns' AS "check", 0 AS violations, 'ok' AS detail
  UNION ALL SELECT concat('not_null:', c), 0, 'ok' FROM (VALUES ('order_id'), ('payment_sequential'), ('payment_type'), ('payment_installments'), ('payment_value')) v(c)
  UNION ALL SELECT 'primary_key_unique', n - keys, concat(n - keys, ' duplicatas em PK [''order_id'', ''payment_sequential'']') FROM facts
  UNION ALL SELECT 'allowed_values:payment_type', bad, 'ok' FROM facts
  UNION ALL SELECT 'row_count_min', 0, concat('rows=', n) FROM facts)
SELECT "check", violations = 0 AS passed, 'error' AS severity, violations, detail FROM report""")
def dataset_validation(spark, sf_dir):
    """The full contract report of the payments, which have duplicate keys."""
    return quality.validate(adapters.order_payments(spark, sf_dir), CONTRACTS["order_payments"])


@register("feature_validation", f"""WITH {CLEAN}, {enriched(PRIOR)}, {rollup_cte(PRIOR)},
report AS (
  SELECT 'schema_columns' AS "check", 0 AS violations, 'ok' AS detail
  UNION ALL SELECT concat('not_null:', c), 0, 'ok' FROM (VALUES {", ".join(
      f"('{f.name}')" for f in CUSTOMER_FEATURES.fields if not f.nullable)}) v(c)
  UNION ALL SELECT 'primary_key_unique', 0, 'ok'
  UNION ALL SELECT 'frequency_positive', count(*) FILTER (WHERE frequency < 1), 'ok' FROM feat
  UNION ALL SELECT 'recency_non_negative', count(*) FILTER (WHERE recency_days < 0),
    CASE WHEN count(*) FILTER (WHERE recency_days < 0) = 0 THEN 'ok'
      ELSE concat(count(*) FILTER (WHERE recency_days < 0), ' recency negativas') END FROM feat
  UNION ALL SELECT 'monetary_non_negative', count(*) FILTER (WHERE monetary < 0), 'ok' FROM feat)
SELECT "check", violations = 0 AS passed, 'error' AS severity, violations, detail FROM report""")
def feature_validation(spark, sf_dir):
    """At the end of 2000 some customers bought on the as-of day: recency −1 is reported."""
    return quality.validate_features(plan.feature_table(adapters.retail(spark, sf_dir), PRIOR))


@register("assert_valid_messages", f"""WITH {SOURCES}, facts AS (
  SELECT 'order_payments' AS dataset, (SELECT count(*) FROM pay_src) - (SELECT count(*) FROM (SELECT DISTINCT order_id, payment_sequential FROM pay_src)) AS n,
    ' duplicatas em PK [''order_id'', ''payment_sequential'']' AS text, 'primary_key_unique' AS "check"
  UNION ALL SELECT 'orders', count(*), concat(' nulos em order_status'), 'not_null:order_status' FROM ord_src WHERE order_status = 'processing'
  UNION ALL SELECT 'customers', 0, '', '' )
SELECT dataset, CASE WHEN n > 0 THEN concat('Validação falhou para ', dataset, ': ', "check", ': ', n, text) ELSE 'ok' END AS message FROM facts""")
def assert_valid_messages(spark, sf_dir):
    """What stops a run: payments as they are, orders some of whose statuses are blank, customers without fault."""
    sources = adapters.retail(spark, sf_dir)
    blank = F.when(F.col("order_status") == "processing", " ").otherwise(F.col("order_status"))
    tables = {"order_payments": sources.payments, "orders": sources.orders.withColumn("order_status", blank), "customers": sources.customers}
    rows = []
    for name, table in tables.items():
        contract = CONTRACTS[name]
        # a blank is a missing value here, not a status of its own
        report = quality.validate(table, contract).where("check NOT LIKE 'allowed_values%'")
        try:
            quality.assert_valid(report, name)
            rows.append((name, "ok"))
        except ValueError as error:
            rows.append((name, str(error)))
    return spark.createDataFrame(rows, "dataset string, message string")


@register("write_read_reconcile", f"""WITH {CLEAN}
SELECT 'raw' AS stage, (SELECT count(*) FROM item_src) AS n, false AS reconciled
UNION ALL SELECT 'clean', (SELECT count(*) FROM item), false
UNION ALL SELECT 'keyed', (SELECT count(*) FROM (SELECT DISTINCT order_id, order_item_id FROM item_src)), false""")
def write_read_reconcile(spark, sf_dir):
    """Row counts of the raw items, the cleaned ones and their distinct keys."""
    items = adapters.order_items(spark, sf_dir)
    return quality.reconcile_counts({
        "raw": items, "clean": cleaning.clean_order_items(items),
        "keyed": items.select("order_id", "order_item_id").distinct(),
    })

