"""Queries that run a whole pipeline through files: landing, stream, persisted features and segments."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from buyerlens.operators import cleaning
from buyerlens.oracle_base import AS_OF, SOURCES, features_cte, r6
from buyerlens.plans import pipelines
from buyerlens.registry import register
from buyerlens.registry.data import _MONTHS
from buyerlens.registry.features import _FEATURES, rounded
from buyerlens.registry.given import given_model
from buyerlens.registry.models import ONE_PERIOD
from buyerlens.session import file_names, move_path, scratch_path
from buyerlens.sources import adapters, ledger, partitions
from buyerlens.sources.adapters import Sources
from buyerlens.streaming.deliveries import ingest_deliveries


def _landed(spark, sf_dir, clean: bool = False) -> str:
    root = scratch_path(spark)
    sources = adapters.retail(spark, sf_dir)
    if clean:
        sources = Sources(
            cleaning.clean_orders(sources.orders), cleaning.clean_customers(sources.customers),
            cleaning.clean_order_items(sources.items), cleaning.clean_order_payments(sources.payments))
    partitions.land_sources(sources.orders, sources.customers, sources.items, sources.payments, f"{root}/landing")
    return root


@register("incremental_ingest", f"""WITH {SOURCES}, {_MONTHS}
SELECT dataset, year, month, count(*) AS n_rows FROM observed GROUP BY ALL""")
def incremental_ingest(spark, sf_dir):
    """Every landing file through the file stream, then the rows per stored month."""
    root = _landed(spark, sf_dir)
    counts = None
    for dataset in ("orders", "order_items", "order_payments"):
        ingest_deliveries(spark, f"{root}/landing", f"{root}/processed", dataset, f"{root}/stream")
        stored = ledger.dataset_store(spark, f"{root}/processed", dataset).all()
        own = partitions.partition_row_counts(stored, dataset)
        counts = own if counts is None else counts.unionByName(own)
    return counts


# the month that gets further deliveries, and what is in its second one
_MONTH_AGAIN = (2000, 12)


@register("delivery_ledger", f"""WITH {SOURCES}, {_MONTHS},
paid AS (SELECT p.*, m.year, m.month FROM pay_src p JOIN months m USING (order_id)),
every AS (
  SELECT 'order_payments' AS dataset, year, month, payment_value FROM paid
  WHERE NOT (year = {_MONTH_AGAIN[0]} AND month = {_MONTH_AGAIN[1]}) OR payment_type = 'boleto'
  UNION ALL SELECT 'customers', NULL, NULL, CAST(customer_zip_code_prefix AS DOUBLE) FROM cust_src WHERE customer_city <> 'BUILDING')
SELECT dataset, CAST(year AS INTEGER) AS year, CAST(month AS INTEGER) AS month, count(*) AS n_rows, {r6('sum(payment_value)')} AS total,
  CASE WHEN dataset = 'customers' OR (year = {_MONTH_AGAIN[0]} AND month = {_MONTH_AGAIN[1]}) THEN '2' END AS delivery
FROM every GROUP BY ALL""")
def delivery_ledger(spark, sf_dir):
    """Payments and the snapshot after a run of deliveries: one in two parts, its columns in another order, an older
    one that is late, and a copy of the first files; the months in between are taken by the stream and by the batch."""
    root, sources = scratch_path(spark), adapters.retail(spark, sf_dir)
    landing, processed = f"{root}/landing", f"{root}/processed"
    partitions.land_sources(sources.orders, sources.customers, sources.items, sources.payments, landing)
    year, month = _MONTH_AGAIN
    folder = f"{landing}/order_payments/year={year:04d}/month={month:02d}"

    def stream() -> None:
        for dataset in ("order_payments", "customers"):
            ingest_deliveries(spark, landing, processed, dataset, f"{root}/stream")

    def deliver(rows, path: str) -> None:
        made = f"{root}/made-{uuid.uuid4().hex}"
        rows.coalesce(1).write.option("header", True).csv(made)
        (file,) = [name for name in file_names(spark, made) if name.startswith("part-")]
        move_path(spark, f"{made}/{file}", path)

    def payments_of_month():
        months = partitions.order_months(sources.orders).where(f"year = {year} AND month = {month}")
        return partitions.inherit_month(sources.payments, months).drop("year", "month")

    stream()
    boletos = payments_of_month().where("payment_type = 'boleto'").select(
        "payment_value", "payment_type", "payment_sequential", "payment_installments", "order_id")
    early = boletos["payment_installments"] <= 5
    deliver(boletos.where(early), f"{folder}/payments-d2-p1of2.csv")
    stream()
    deliver(boletos.where(~early), f"{folder}/payments-d2-p2of2.csv")
    deliver(sources.customers.where("customer_city <> 'BUILDING'"), f"{landing}/customers/snapshot=full/customers-d2.csv")
    partitions.ingest_months(spark, landing, processed, "order_payments", [_MONTH_AGAIN])
    deliver(payments_of_month().where("payment_type = 'voucher'"), f"{folder}/payments-d1-p1of1.csv")
    deliver(payments_of_month(), f"{folder}/copied.csv")
    stream()
    found = None
    for dataset in ("order_payments", "customers"):
        store = ledger.dataset_store(spark, processed, dataset)
        live = store.snapshot().live
        numbers = spark.createDataFrame([(name, c["facts"]["number"]) for name, c in live.items()], "part string, delivery string")
        monthly, value = dataset != "customers", "payment_value" if dataset != "customers" else "customer_zip_code_prefix"
        rows = store.read(*live.values()).withColumn(
            "part", F.format_string("%04d-%02d", "year", "month") if monthly else F.lit(ledger.SNAPSHOT))
        keys = [F.col(c) if monthly else F.lit(None).cast("int").alias(c) for c in ("year", "month")]
        own = rows.select("part", *keys, F.col(value).cast("double").alias("v")).groupBy("part", "year", "month").agg(
            F.count("*").alias("n_rows"), F.sum("v").alias("total")).join(numbers, "part").select(
            F.lit(dataset).alias("dataset"), "year", "month", "n_rows", "total", "delivery")
        found = own if found is None else found.unionByName(own)
    return rounded(found)


@register("feature_table_persisted", f"WITH {features_cte()} SELECT {_FEATURES} FROM feat")
def feature_table_persisted(spark, sf_dir):
    """Landing files to the stored feature table, read back. The raw tables hold
    duplicate keys, which the strict mode would refuse."""
    root = _landed(spark, sf_dir)
    pipelines.run_feature_table(spark, root, AS_OF, strict=False)
    return rounded(partitions.load_features(spark, f"{root}/features", AS_OF, "1.0.0"))


@register("feature_table_strict", f"WITH {features_cte()} SELECT {_FEATURES} FROM feat")
def feature_table_strict(spark, sf_dir):
    """The same from landing files that keep their contracts, with all checks on."""
    root = _landed(spark, sf_dir, clean=True)
    pipelines.run_feature_table(spark, root, AS_OF)
    return rounded(partitions.load_features(spark, f"{root}/features", AS_OF, "1.0.0"))


@register("batch_scoring_persisted", f"""WITH {ONE_PERIOD}
SELECT customer_unique_id, as_of_date, segment_id, segment_label, 'purchase_segments' AS model_name,
  '7' AS model_version FROM scored""")
def batch_scoring_persisted(spark, sf_dir):
    """Features stored, scored, published and read through the current pointer."""
    from buyerlens.plans.feature_table import feature_table

    root = scratch_path(spark)
    features = feature_table(adapters.retail(spark, sf_dir), AS_OF)
    pipelines.persist_features(features, f"{root}/features", f"{root}/log")
    pipelines.run_batch_scoring(spark, root, AS_OF, given_model(features))
    return pipelines.current_segments(spark, root).select(
        "customer_unique_id", F.col("as_of_date"), "segment_id", "segment_label", "model_name", "model_version"
    )
