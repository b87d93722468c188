"""Landing files to stored features, with and without the strict checks."""

from __future__ import annotations

import pytest
from test_features import make_sources

from buyerlens.contracts import ORDERS
from buyerlens.plans import feature_table as plan
from buyerlens.plans import pipelines
from buyerlens.sources import partitions
from buyerlens.sources.adapters import Sources


@pytest.fixture(scope="module")
def sources(spark):
    made = make_sources(spark, 40)
    missing = [f"cast(null as timestamp) {c}" for c in ORDERS.columns if c not in made.orders.columns]
    return Sources(made.orders.selectExpr("*", *missing), made.customers, made.items.dropDuplicates(), made.payments)


def land(sources, root, items=None):
    partitions.land_sources(sources.orders, sources.customers, items or sources.items, sources.payments, f"{root}/landing")


def test_strict_run(spark, sources, tmp_path):
    root = str(tmp_path)
    land(sources, root)
    for _ in range(2):
        result = pipelines.run_feature_table(spark, root, "2018-08-31")
    assert result["rows"]["orders"] == 30 and result["enriched_rows"] == sources.items.count()
    assert "orders/2017-12" in result["missing_partitions"] and "orders/2018-03" not in result["missing_partitions"]
    stored = partitions.load_features(spark, f"{root}/features", "2018-08-31", "1.0.0").drop("built_at")
    direct = plan.feature_table(sources, "2018-08-31").drop("built_at")
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, direct.collect()))
    log = spark.read.parquet(f"{root}/log")
    assert [r.row_count for r in log.collect()] == [result["feature_rows"]] * 2
    with pytest.raises(FileNotFoundError):
        partitions.load_features(spark, f"{root}/features", "2018-08-31", "2.0.0")


def test_strict_run_refuses_duplicates(spark, sources, tmp_path):
    root = str(tmp_path)
    land(sources, root, sources.items.unionByName(sources.items.limit(3)))
    with pytest.raises(ValueError, match="primary_key_unique: 3 duplicatas"):
        pipelines.run_feature_table(spark, root, "2018-08-31")
    assert pipelines.run_feature_table(spark, root, "2018-08-31", strict=False)["feature_rows"] > 0


def test_strict_run_refuses_orphans(spark, sources, tmp_path):
    """A customer absent from the snapshot breaks the first key of the chain."""
    root = str(tmp_path)
    fewer = Sources(sources.orders, sources.customers.where("customer_id <> 'c4'"), sources.items, sources.payments)
    land(fewer, root)
    with pytest.raises(ValueError, match="fk_orders_customers: 1 órfãos"):
        pipelines.run_feature_table(spark, root, "2018-08-31")


def test_nothing_in_the_window(spark, sources, tmp_path):
    root = str(tmp_path)
    land(sources, root)
    with pytest.raises(ValueError):
        pipelines.run_feature_table(spark, root, "2018-08-31", statuses=("canceled",))
